"""Sets of items that are often bought together, level by level.

Only items that are frequent by themselves go on.  Sets of a level are made out of two frequent
sets of the level before that differ in the last item, all of whose other subsets are frequent, too; the
baskets that hold such a set are found by adding one item to the sets they are known to hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solstrand.sinks.scratch import written


def frequent_sets(baskets: DataFrame, basket: str, item: str, least: int, largest: int = 3) -> DataFrame:
    """(items, n): sorted arrays of up to `largest` items that `least` baskets or more hold whole.

    An item counts once for each basket; rows without basket or item count nothing.
    """
    rows = baskets.select(F.col(basket).alias("basket"), F.col(item).alias("item")).filter("basket IS NOT NULL AND item IS NOT NULL").distinct()
    counts = rows.groupBy("item").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    single = written(counts, "frequent")
    held = written(rows.join(single.select("item"), "item", "left_semi").select("basket", "item"), "held")
    level = single.select(F.array("item").alias("items"), "n")
    sets = held.select("basket", F.array("item").alias("items"))
    found = level
    for size in range(2, largest + 1):
        head = lambda: F.slice("items", 1, size - 2)  # noqa: E731, B023
        one = level.select(head().alias("head"), F.element_at("items", -1).alias("last"))
        other = level.select(head().alias("head"), F.element_at("items", -1).alias("next"))
        made = one.join(other, "head").filter("last < next").select(F.concat("head", F.array("last", "next")).alias("items"))
        if size > 2:  # every subset without one of the items must be frequent
            subsets = made.select("items", F.explode(F.transform(F.sequence(F.lit(1), F.lit(size)), lambda i: F.filter("items", lambda x, j: j + 1 != i))).alias("subset"))  # noqa: B023
            whole = subsets.join(level.select(F.col("items").alias("subset")), "subset", "left_semi").groupBy("items").agg(F.count("*").alias("k"))
            made = whole.filter(F.col("k") == size).select("items")
        wanted = written(made, "candidates")
        longer = sets.join(held, "basket").filter(F.col("item") > F.element_at("items", -1))
        sets = longer.select("basket", F.concat("items", F.array("item")).alias("items")).join(wanted, "items", "left_semi")
        sets = written(sets, "held-sets")
        level = written(sets.groupBy("items").agg(F.count("*").alias("n")).filter(F.col("n") >= least), "frequent")
        if level.limit(1).count() == 0:
            break
        found = found.unionByName(level)
    return found


def rules(sets: DataFrame, baskets: int) -> DataFrame:
    """(items, then, n, confidence, lift) of each frequent set and each of its items as the consequence.

    `sets` must be stored rows with all frequent sets; `baskets` is the number of all baskets.
    """
    many = sets.filter(F.size("items") > 1).select("items", "n", F.explode("items").alias("then"))
    given = many.select(F.array_except("items", F.array("then")).alias("given"), "then", "n")
    known = sets.select(F.col("items").alias("given"), F.col("n").alias("n_given"))
    alone = sets.filter(F.size("items") == 1).select(F.col("items")[0].alias("then"), F.col("n").alias("n_then"))
    both = given.join(known, "given").join(alone, "then")
    return both.select(
        F.col("given").alias("items"),
        "then",
        "n",
        (F.col("n") / F.col("n_given")).alias("confidence"),
        ((F.col("n") * F.lit(baskets)).cast("double") / (F.col("n_given") * F.col("n_then"))).alias("lift"),
    )
