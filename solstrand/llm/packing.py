"""Packing: optimal length buckets and token-budget batches.

Documents longer than the context are cut into pieces of its length first, so every length lies in
1..context and the global histogram has at most `context` rows, whatever the input.  Dynamic
programming over it finds the bucket boundaries with the least padding.  Inside a bucket rows are
put in a seeded order and filled into batches of at most `batch_tokens` padded tokens.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solstrand.llm.common import col, estimated_tokens, fresh
from solstrand.llm.sharding import row_numbers

#: Of `estimated_tokens`.
BYTES_A_TOKEN = 4


def optimal_boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """Ascending upper bounds, at most `buckets`, with the least padding; [] without lengths.

    cost(i, j) pads lengths i..j to length j.  best[b][j] = min over i of best[b-1][i] + cost, in
    O(buckets x lengths^2) on at most `context` distinct lengths; sums are exact integers.
    """
    lengths = np.array(sorted(histogram), np.int64)
    n = len(lengths)
    if not n:
        return []
    rows = np.concatenate([[0], np.cumsum([histogram[int(x)] for x in lengths])])
    best = lengths * rows[1:]  # one bucket: padded size of everything up to j
    cuts = []
    for _ in range(1, min(buckets, n)):
        # From i groups done to j: padded tokens of rows i..j at length j.
        padded = np.empty(n, np.int64)
        cut = np.zeros(n, np.int64)
        for j in range(n):
            options = best[:j] + lengths[j] * (rows[j + 1] - rows[1 : j + 1])
            one = lengths[j] * rows[j + 1]
            k = int(np.argmin(options)) if j else -1
            if j and options[k] < one:
                padded[j], cut[j] = options[k], k + 1
            else:
                padded[j], cut[j] = one, 0
        cuts.append(cut)
        best = padded
    bounds, j = [], n - 1
    for cut in reversed([np.zeros(n, np.int64), *cuts]):
        bounds.append(int(lengths[j]))
        if not cut[j]:
            break
        j = int(cut[j]) - 1
    return bounds[::-1]


def _code_point_start(data: Column, at: Column) -> Column:
    """The last place not behind `at` where no code point of UTF-8 is cut."""

    def inside(back: int) -> Column:
        byte = F.hex(F.substring(data, at + (1 - back), F.lit(1)))
        return (at >= back) & byte.between("80", "BF")

    steps = F.when(inside(2), 3).otherwise(2)
    return at - F.when(inside(0), F.when(inside(1), steps).otherwise(1)).otherwise(0)


def _has_text(docs: DataFrame) -> bool:
    return any(c.lower() == "text" for c in docs.columns)


def pieces(docs: DataFrame, tokens: Column, context: int, token_bytes: Column | None = None) -> DataFrame:
    """One row per piece with `piece`, `start` (token) and `n_tokens`; no tokens, no piece.

    `text`, where `docs` has it, becomes the piece's own: its tokens' bytes, with both borders moved
    back to the start of a code point, so the pieces of a document put together are its text.  A token
    has `token_bytes`; without it each has an equal share of the document's bytes.
    """
    docs = docs.drop("piece", "start", "n_tokens")
    names = docs.columns
    counted, found_in = fresh(docs, "all_tokens_", "found_")
    whole = col(counted)
    base = docs.withColumn(counted, tokens).filter(whole > 0)
    last = F.floor((whole - 1) / context).cast("int")
    wide = F.lit(context).cast("long")

    def cut(data: Column | None) -> Column:
        """The pieces as structs; `data` is taken from the row once."""

        def border(start: Column) -> Column:
            size = F.octet_length(data).cast("long")
            near = start * token_bytes if token_bytes is not None else F.floor(start * size / F.greatest(whole, F.lit(1)))
            return _code_point_start(data, F.least(near, size).cast("int"))

        def one(i: Column) -> Column:
            start = i * wide
            fields = [i.alias("piece"), start.alias("start"), F.least(wide, whole - start).alias("n_tokens")]
            if data is not None:
                a = border(start)
                b = F.when(i < last, border(start + wide)).otherwise(F.octet_length(data))
                fields.append(F.substring(data, a + 1, b - a).cast("string").alias("text"))
            return F.struct(*fields)

        return F.transform(F.sequence(F.lit(0), last), one)

    if _has_text(docs):
        # A one-element array holds the bytes, so that they are copied once for each row.
        found = F.flatten(F.transform(F.array(col("text").cast("string").cast("binary")), cut))
    else:
        found = cut(None)
    # The whole text goes before the rows are multiplied.  None is empty; the outer form spares the
    # optimizer's filter for empty ones, which would cut every text a second time.
    cuts = base.withColumn(found_in, found).drop("text", counted)
    out = cuts.withColumn(found_in, F.explode_outer(found_in))
    piece = lambda c: col(found_in).getField(c).alias(c)
    own = [piece("text").alias(c) if c.lower() == "text" else col(c) for c in names]
    return out.select(*own, *[piece(c) for c in ("piece", "start", "n_tokens")])


def packed(
    docs: DataFrame,
    tokens: Column | None = None,
    context: int = 2048,
    buckets: int = 16,
    batch_tokens: int = 65536,
    seed: int = 5,
) -> DataFrame:
    """Pieces of the documents with their text, `bucket`, `bucket_length`, `batch` and `slot`.

    `docs` needs `doc_id`, and `text` unless `tokens` is given (default: UTF-8 bytes / 4, rounded
    up).  `text` is that of the piece, see `pieces`: its four bytes a token, or with `tokens` an equal
    share of the bytes for each token, so that a piece may differ by 3 bytes for its borders.  A batch holds the same number of rows as its siblings except for the last of a bucket:
    batch_tokens div bucket_length, at least one.  Documents without tokens give no piece.
    Repeated rows are packed one by one; columns of these names are replaced.
    """
    token_bytes = F.lit(BYTES_A_TOKEN) if tokens is None else None
    tokens = estimated_tokens(col("text")) if tokens is None else tokens
    docs = docs.drop("bucket", "bucket_length", "batch", "slot")
    counted, number, rows_each, place = fresh(docs, "all_", "number_", "per_", "place_")
    slim = docs.withColumn(counted, tokens)
    cut = pieces(slim, col(counted), context, token_bytes).drop(counted)
    # Lengths need no text.  At most `context` rows reach the driver.
    lengths = pieces(slim.select(counted), col(counted), context).groupBy("n_tokens")
    histogram = {r["n_tokens"]: r["n"] for r in lengths.agg(F.count("*").alias("n")).collect()}
    bounds = optimal_boundaries(histogram, buckets)
    schema_only = {"bucket": "int", "bucket_length": "int", "batch": "long", "slot": "int"}
    if not bounds:
        return cut.withColumns({k: F.lit(None).cast(v) for k, v in schema_only.items()})
    rows_before, before = [], 0
    at = 0
    for bound in bounds:
        rows_before.append(before)
        before += sum(n for length, n in histogram.items() if at < length <= bound)
        at = bound
    bucket = F.lit(len(bounds) - 1)
    for i in reversed(range(len(bounds) - 1)):
        bucket = F.when(F.col("n_tokens") <= bounds[i], i).otherwise(bucket)
    keyed = cut.withColumn("bucket", bucket.cast("int"))
    order = F.xxhash64(F.lit(seed), col("doc_id"), "piece")
    keys = [F.col("bucket"), order, col("doc_id"), F.col("piece"), F.col("n_tokens")]
    if _has_text(keyed):
        keys.append(F.xxhash64(col("text")))
    numbered = row_numbers(keyed, keys, number)
    at_bucket = F.col("bucket") + 1
    long_array = lambda xs: F.array(*[F.lit(int(x)).cast("long") for x in xs])
    return (
        numbered.withColumn("bucket_length", F.element_at(long_array(bounds), at_bucket).cast("int"))
        .withColumn(rows_each, F.greatest(F.floor(F.lit(batch_tokens) / F.col("bucket_length")), F.lit(1)))
        .withColumn(place, col(number) - F.element_at(long_array(rows_before), at_bucket))
        .withColumn("batch", F.floor(col(place) / col(rows_each)).cast("long"))
        .withColumn("slot", (col(place) % col(rows_each)).cast("int"))
        .drop(number, rows_each, place)
    )


def packing_digest(docs: DataFrame, **options) -> DataFrame:
    """Where each piece lies; its text is left out only here."""
    return packed(docs.select("doc_id", "text"), **options).drop("text")
