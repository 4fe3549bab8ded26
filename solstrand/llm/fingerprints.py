"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range, so its size follows the
document's, the sketch of a union comes from the sketches, and containment can be estimated between
a short and a very long document.  The least LEAST hashes are kept beside those, so a document of
fewer shingles is held whole, and only one without words has an empty sketch.  Two sketches are
compared up to the hash to which both are complete.  All columns are built-in expressions.

Documents are compared with their successor in descending order of `doc_id`.  One exchange by id
range brings them together: the first document of a range is also sent to the range before it, so
every row finds its successor in its own range and no range depends on another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from solstrand.llm.common import SEPARATORS, col, fresh
from solstrand.sinks.scratch import written

SHINGLE = 5
#: One hash in SCALE is kept.
SCALE = 8
#: The least hashes are kept whatever their size.
LEAST = 32
RANGE_ROWS = 512


def _bound(scale: int) -> int:
    """Hashes below are always kept."""
    return (1 << 63) // scale * 2 - (1 << 63)


def _kept(hashes: Column, scale: int, least: int) -> Column:
    """Of ascending distinct hashes, those below the bound and the first `least`."""
    return F.filter(hashes, lambda h, i: (h < F.lit(_bound(scale))) | (i < F.lit(least)))


def sketch(text: Column, k: int = SHINGLE, scale: int = SCALE, least: int = LEAST) -> Column:
    """Ascending distinct hashes of the k-word shingles below 1 / scale of the range, or the least.

    Fewer words than k are one shingle; no words, NULL or empty text give an empty sketch.
    """
    parts = F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")

    def shingle(words: Column) -> Column:
        at = lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)])
        n = F.greatest(F.size(words) - k, F.lit(0))
        return F.when(F.size(words) > 0, F.transform(F.sequence(F.lit(0), n), at)).otherwise(
            F.array().cast("array<bigint>")
        )

    # A one-element array holds the words, so that the text is split once for each row.
    hashes = F.flatten(F.transform(F.array(parts), shingle))
    return _kept(F.sort_array(F.array_distinct(hashes)), scale, least)


def printed(hashes: Column) -> Column:
    """A sketch as text: 16 hex digits for each hash."""
    return F.concat_ws("", F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")))


def _complete_to(hashes: Column, scale: int, least: int) -> Column:
    """The last hash up to which a sketch misses none of its document's."""
    top = F.greatest(F.try_element_at(hashes, F.lit(-1)), F.lit(_bound(scale) - 1))
    return F.when(F.size(hashes) < least, F.lit((1 << 63) - 1)).otherwise(top)


def _shared(a: Column, b: Column, scale: int, least: int) -> tuple[Column, Column, Column]:
    """Sizes of a, of b and of what they share, up to where both are complete."""
    to = F.least(_complete_to(a, scale, least), _complete_to(b, scale, least))
    # One-element arrays hold the limit, so that it is found once for each row.
    within = lambda x: F.flatten(F.transform(F.array(to), lambda t: F.filter(x, lambda h: h <= t)))
    return F.size(within(a)), F.size(within(b)), F.size(within(F.array_intersect(a, b)))


def jaccard(a: Column, b: Column, scale: int = SCALE, least: int = LEAST) -> Column:
    """Estimated Jaccard similarity, exact where both have fewer shingles than `least`.

    Two empty sketches (no words in either) are alike, an empty and another are not.
    """
    of_a, of_b, both = _shared(a, b, scale, least)
    either = of_a + of_b - both
    empty = (F.size(a) == 0) & (F.size(b) == 0)
    return F.when(empty, F.lit(1.0)).otherwise(both / F.greatest(either, F.lit(1)))


def containment(a: Column, b: Column, scale: int = SCALE, least: int = LEAST) -> Column:
    """Estimated share of a's shingles that b has; NULL where a has none up to where b is complete."""
    of_a, _, both = _shared(a, b, scale, least)
    return F.when(of_a > 0, both / F.greatest(of_a, F.lit(1)))


def merged(a: Column, b: Column, scale: int = SCALE, least: int = LEAST) -> Column:
    """The sketch of both documents together."""
    return _kept(F.sort_array(F.array_union(a, b)), scale, least)


def with_successors(docs: DataFrame, derived: dict[str, Column], range_rows: int = RANGE_ROWS) -> DataFrame:
    """`docs` with `next_text` and, for each of `derived`, the column and its `next_`.

    The next row is that of the next lower doc_id.  After the last row comes the first; a single row is its own successor.  Rows without id come
    last; rows with equal ids are ordered by a hash of the text, and equal rows are interchangeable.
    Ids decide the ranges, about `range_rows` rows each where ids are spread evenly.
    """
    key_, tie_, range_, lent_, to_, wraps_ = fresh(docs, "key_", "tie_", "range_", "lent_", "to_", "wraps_")
    key = F.coalesce(col("doc_id").cast("long"), F.lit(-(1 << 62)))
    keyed = docs.withColumns({key_: key, tie_: F.xxhash64(col("text"))})
    known = docs.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("doc_id").alias("n")).first()
    if known["n"]:
        width = max(1, (known["b"] - known["a"] + 1) * range_rows // known["n"])
        bucket = F.expr(f"(`{key_}` - {known['a']}L) div {width}L")
    else:
        bucket = F.lit(0)
    # Ids missing: ranges of their own below all others, by their hash from high to low.
    no_id = (-1 - F.shiftright(F.lit((1 << 62) - 1) - F.shiftright(tie_, 1), 55)).cast("long")
    keyed = keyed.withColumn(range_, F.when(col(key_) == -(1 << 62), no_id).otherwise(bucket))
    # The first row of each range, and the range before it that needs it; one row a range.
    first = keyed.groupBy(range_).agg(F.max(F.struct(col(key_).alias("key"), col(tie_).alias("tie"))).alias("head"))
    first = written(first, "heads")
    order = Window.orderBy(F.desc(range_))
    ends = first.agg(F.max(range_).alias("top"), F.min(range_).alias("low")).first()
    if ends["top"] is None:
        empty = docs.withColumns(derived).withColumn("next_text", col("text"))
        return empty.withColumns({f"next_{c}": col(c) for c in derived})
    heads = first.select(
        F.col("head.key").alias(key_),
        F.col("head.tie").alias(tie_),
        F.coalesce(F.lag(range_).over(order), F.lit(ends["low"])).alias(to_),
        F.lag(range_).over(order).isNull().alias(wraps_),
    )
    lent = keyed.join(heads, [key_, tie_]).select(
        *[col(c) for c in docs.columns],
        key_,
        tie_,
        col(to_).alias(range_),
        F.when(col(wraps_), 2).otherwise(1).alias(lent_),
    )
    own = keyed.select(*[col(c) for c in docs.columns], key_, tie_, range_, F.lit(0).alias(lent_))
    following = Window.partitionBy(range_).orderBy(lent_, F.desc(key_), F.desc(tie_))
    return (
        own.unionByName(lent)
        .withColumns(derived)
        .withColumns({f"next_{c}": F.lead(col(c)).over(following) for c in ["text", *derived]})
        .filter(col(lent_) == 0)
        .drop(key_, tie_, range_, lent_)
    )


def edited_text(text: Column, following: Column) -> Column:
    """The last half of `text` (rounded down) replaced by the first as many characters of another."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def fingerprint_digest(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, and its likeness to its edited text and to the next document.

    NULL texts are empty.  An empty table gives no rows; a single document is its own successor.
    """
    slim = docs.select(
        col("doc_id").cast("long").alias("doc_id"), F.coalesce(col("text"), F.lit("")).alias("text")
    )
    paired = with_successors(slim, {"sketch": sketch(F.col("text"))})
    edited = paired.withColumn("edited", edited_text(F.col("text"), F.col("next_text"))).select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "sketch",
        "next_sketch",
        sketch(F.col("edited")).alias("edited_sketch"),
    )
    return edited.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        printed(F.col("sketch")).alias("fingerprint"),
        printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        jaccard(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        jaccard(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
