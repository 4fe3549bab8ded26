"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Row r of n goes to place p(r), where p is a keyed permutation of 0..n-1; the place gives the
shard (p mod shards) and the slot in it (p div shards).  Both can be computed for any row without
looking at another one, and `row_at` computes the row that lies in a slot.  Shard sizes differ by
one row at most, and the slots of a shard have no gap.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solstrand.llm.common import col, fresh, utf8_bytes
from solstrand.llm.words import mixed
from solstrand.sinks.scratch import written

ROUNDS = 6


def _half_bits(n: int) -> int:
    """Half the width of the smallest even number of bits that holds 0..n-1."""
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _rounds(x: np.ndarray, n: int, key: int, back: bool) -> np.ndarray:
    half = np.uint64(_half_bits(n))
    low = np.uint64((1 << int(half)) - 1)
    left, right = x >> half, x & low
    for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
        salt = np.uint64((key * ROUNDS + r + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        if back:
            left, right = right ^ (mixed(left + salt) & low), left
        else:
            left, right = right, left ^ (mixed(right + salt) & low)
    return (left << half) | right


def permuted(x: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """The place of each row number below n, or with `back` the row number at each place.

    The Feistel network permutes a power of four, less than 4 n (4 for n below 4); a number that
    lands at n or above walks on along its cycle until it is below n, which keeps a permutation.
    """
    out = np.array(x, np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        out[todo] = _rounds(out[todo], n, key, back)
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def row_at(shard: int, slot: int, n: int, shards: int, key: int = 0) -> int:
    """The number of the row in a slot of a shard."""
    return int(permuted(np.array([slot * shards + shard]), n, key, back=True)[0])


def row_numbers(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Gapless numbers from 0 in `order`; rows equal in `order` must be interchangeable.

    One range exchange and one write; the counts per range are read from a single column.  Equal
    rows are spread over the ranges by their place in the input, so copies never fill one task.
    """
    spread, slot = fresh(df, "spread_", "slot_")
    keys = [*order, col(spread)]
    ranged = (
        df.withColumn(spread, F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop(spread)
        .withColumn(slot, F.monotonically_increasing_id())
    )
    fixed = written(ranged, "rows")
    # monotonically_increasing_id() holds the task number above 33 bits.
    task = F.shiftright(col(slot), 33)
    # One row for each task of the exchange: their number is that of the shuffle partitions.
    spans = {
        r["t"]: r["n"] for r in fixed.groupBy(task.alias("t")).agg(F.count("*").alias("n")).collect()
    }
    before, total = {}, 0
    for t in sorted(spans):
        before[t] = total
        total += spans[t]
    if not total:
        return fixed.withColumn(name, F.lit(0).cast("long")).drop(slot)
    size = max(spans) + 1
    starts = F.array(*[F.lit(before.get(t, 0)).cast("long") for t in range(size)])
    place = F.element_at(starts, (task + 1).cast("int")) + col(slot).bitwiseAND(F.lit((1 << 33) - 1))
    return fixed.withColumn(name, place).drop(slot)


def shuffled_shards(
    df: DataFrame, order: list[Column], shards: int, key: int = 0, rows: int | None = None
) -> DataFrame:
    """`df` with `row_number`, `shard` and `slot`.

    `order` fixes the row numbers and with them the shuffle: equal input gives equal shards,
    however it is partitioned.  NULLs come first; rows equal in `order` are interchangeable.  An
    empty frame stays empty.  Existing columns of these names are replaced.
    """
    if shards < 1:
        raise ValueError("there must be a shard")
    df = df.drop("row_number", "shard", "slot")
    counted = row_numbers(df, order, "row_number")
    n = counted.count() if rows is None else rows

    @F.pandas_udf("long")
    def place(number: pd.Series) -> pd.Series:
        return pd.Series(permuted(number.to_numpy(), n, key))

    (at,) = fresh(counted, "place")
    return (
        counted.withColumn(at, place("row_number"))
        .withColumns(
            {
                "shard": F.pmod(at, F.lit(shards)).cast("int"),
                "slot": F.floor(F.col(at) / shards).cast("long"),
            }
        )
        .drop(at)
    )


def write_shards(sharded: DataFrame, folder: str) -> None:
    """One folder per shard, rows in slot order; a shard's file can be written by one task again."""
    (
        sharded.repartition("shard")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .mode("errorifexists")
        .parquet(folder)
    )


def document_shards(docs: DataFrame, shards: int = 24, key: int = 0) -> DataFrame:
    """Digest of the sharding of all documents; law: row counts at most one apart.

    NULL texts have size 8 and the checksum of no bytes.  Repeated rows are rows of their own.
    """
    text = F.coalesce(col("text"), F.lit(""))
    slim = docs.select(
        col("doc_id").alias("doc_id"),
        (utf8_bytes(col("text")) + 8).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    out = shuffled_shards(slim, [F.col("doc_id"), F.col("text_crc32"), F.col("size")], shards, key)
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
