"""Texts that differ by a few edits, found without comparing all with all.

Texts up to SHORT characters, as names and descriptions of goods are, are found by what is left of them when
up to k characters are taken out: texts within k edits have such a rest in common, and texts with a rest in
common are within 2 * k edits, so what is compared grows with what is near, however alike all texts are.

A longer text has too many rests.  Two texts within k edits share all but k * q of their q-grams (copies
numbered).  So among the k * q + 1 rarest grams of either there is one that both have, and it is enough to
compare texts that share such a gram.

A rest or gram that many texts share is cut into parts, and each text is compared part by part,
so no task gets all texts of a gram.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solstrand.sinks.scratch import written

#: Texts of a gram that one task compares with others.
PART = 2000
#: Grams in more than this part of all texts are looked up by broadcast; texts have few, so these are few.
COMMON = 0.001
#: The longest texts found by their rests: at two edits 1 + 48 * 49 / 2 of these.
SHORT = 48


def _grams(text: Column, q: int) -> Column:
    """The q-grams of a text, each with the number of its earlier copies."""
    plain = F.transform(
        F.sequence(F.lit(1), F.greatest(F.char_length(text) - q + 1, F.lit(1))), lambda i: F.substring(text, i, F.lit(q))
    )
    return F.transform(
        plain, lambda g, i: F.concat_ws("\u0001", g, F.size(F.filter(F.slice(plain, F.lit(1), i), lambda h: h == g)).cast("string"))
    )


def _rarest(texts: DataFrame, k: int, q: int, above: int) -> DataFrame:
    """(text, in_left, in_right, block, gone): the k * q + 1 rarest grams of each text longer than `above`.

    The order is by count among common grams, before which all others come: any order finds every pair.
    """
    mine = texts.filter(F.char_length("text") > above)
    grams = mine.select("text", "in_left", "in_right", F.explode(_grams(F.col("text"), q)).alias("block"))
    counts = grams.groupBy("block").agg(F.count("*").alias("n"))
    common = counts.filter(F.col("n") >= F.lit(COMMON * texts.count()))
    ranked = grams.join(F.broadcast(common), "block", "left").groupBy("text", "in_left", "in_right").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "block"))).alias("grams")
    )
    chosen = ranked.withColumn("gram", F.explode(F.slice("grams", 1, k * q + 1)))
    return chosen.select("text", "in_left", "in_right", F.xxhash64(F.lit("gram"), "gram.block").alias("block"), F.lit(0).alias("gone"))


def _rests(texts: DataFrame, k: int, upto: int) -> DataFrame:
    """(text, in_left, in_right, block, gone): what is left of texts of up to `upto` characters without `gone` of them, up to k."""
    own = ["text", "in_left", "in_right"]
    mine = texts.filter(F.char_length("text") <= upto)
    rests = mine.select(*own, F.col("text").alias("rest"), F.lit(1).alias("at"), F.lit(0).alias("gone"))
    every = rests
    for gone in range(1, k + 1):
        # The next one taken is not before the last; of equal neighbours the first.
        places = F.explode(F.sequence("at", F.char_length("rest")))
        taken = rests.filter(F.char_length("rest") >= F.col("at")).select(*own, "rest", F.col("at").alias("from"), places.alias("at"))
        letter = lambda i: F.substring(F.col("rest"), i, F.lit(1))
        taken = taken.filter((F.col("at") == F.col("from")) | (letter(F.col("at")) != letter(F.col("at") - 1)))
        without = F.concat(F.substring(F.col("rest"), F.lit(1), F.col("at") - 1), F.substring(F.col("rest"), F.col("at") + 1, F.char_length("rest")))
        rests = taken.select(*own, without.alias("rest"), "at", F.lit(gone).alias("gone"))
        every = every.unionByName(rests)
    return every.select(*own, F.xxhash64(F.lit("rest"), "rest").alias("block"), "gone")


def near_texts(left: DataFrame, right: DataFrame, edits: int = 2, q: int = 2) -> DataFrame:
    """(left_text, right_text, distance): all pairs of distinct texts within `edits` edits of each other.

    `left` and `right` have a column `text`; NULL matches nothing, an empty text is a text.  Copies are
    one text each.  Every pair is verified by its edit distance, case and blanks as they are.
    """
    sides = left.select("text", F.lit(True).alias("is_left")).unionByName(right.select("text", F.lit(False).alias("is_left")))
    texts = written(
        sides.filter("text IS NOT NULL").groupBy("text").agg(F.max("is_left").alias("in_left"), F.max(~F.col("is_left")).alias("in_right")),
        "texts",
    )
    # A text makes a thousand rows: even a small table of texts is dealt out to all tasks.
    texts = texts.repartition(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), "text")
    # Texts from `short` on have enough grams; of two within `edits` edits both are in the one or both in the other.
    short = max(SHORT if edits <= 2 else 0, edits * (q + 1) - 1, edits * q + q - 1)
    blocks = _rests(texts, edits, short + edits).unionByName(_rarest(texts, edits, q, short))
    # Only blocks of more than a part are placed: few, as a text has a bounded number of blocks.
    sizes = blocks.filter("in_right").groupBy("block").agg(F.count("*").alias("n"))
    parts = written(sizes.filter(F.col("n") > PART).select("block", F.ceil(F.col("n") / PART).alias("parts")), "parts")
    placed = blocks.join(F.broadcast(parts), "block", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("bigint")))
    lefts = placed.filter("in_left").select(
        F.col("text").alias("left_text"), "block", F.col("gone").alias("left_gone"), F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("parts"))).alias("part")
    )
    rights = placed.filter("in_right").select(
        F.col("text").alias("right_text"), "block", F.col("gone").alias("right_gone"), (F.pmod(F.xxhash64("text"), F.col("parts")) + 1).alias("part")
    )
    # Without more taken out than they have edits between them, all pairs are found, and most of them once.
    apart = F.abs(F.char_length("left_text") - F.char_length("right_text")) <= edits
    distance = F.levenshtein("left_text", "right_text", edits)
    # Sorted, as a table of rests is far larger than that of the texts it is made of.
    pairs = lefts.join(rights.hint("merge"), ["block", "part"]).filter(apart)
    pairs = pairs.withColumn("distance", distance).filter(F.col("distance") >= F.greatest("left_gone", "right_gone"))
    # By the left text, so that what is counted for each need not travel again.
    return pairs.select("left_text", "right_text", "distance").repartition("left_text").distinct()
