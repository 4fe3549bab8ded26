"""Ranks and running sums over a whole table, without a task that reads all of it.

Rows are numbered by `ids.numbered`, then summed in blocks of consecutive numbers.  There are at most
2^16 blocks, whatever the table's size; their sums are added up on the driver and joined back.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from solstrand.operators.ids import numbered
from solstrand.sinks.scratch import written

BLOCKS = 1 << 16
LEAST_BLOCK = 1 << 16


def tile(number: Column, rows: int, tiles: int) -> Column:
    """What `ntile(tiles)` gives row `number` (from 1) of `rows` rows: the first tiles take the rest."""
    size, rest = divmod(rows, tiles)
    large = rest * (size + 1)
    if not size:
        return number.cast("int")
    later = rest + F.ceil((number - large) / size)
    return F.when(number <= large, F.ceil(number / (size + 1))).otherwise(later).cast("int")


def tiled(df: DataFrame, order: list[Column], tiles: int, name: str) -> DataFrame:
    """`df` with column `name`: 1 to `tiles` in `order`, as even as can be, as ntile would.

    `df` must be stored rows.  Ties are broken by the whole row.
    """
    (number,) = [n for n in ("_number", "_number_") if n not in df.columns][:1]
    rows = df.count()
    return numbered(df, order, number).withColumn(name, tile(F.col(number), rows, tiles)).drop(number)


def running_total(df: DataFrame, order: list[Column], value: str, name: str, rank: str = "rank") -> DataFrame:
    """`df` with `rank` (from 1 in `order`) and the sum of `value` over all rows up to the own one.

    `df` must be stored rows, `value` a whole number; a NULL adds nothing.
    """
    rows = df.count()
    block = max(LEAST_BLOCK, -(-rows // BLOCKS))
    at = written(numbered(df, order, rank), "ranked").withColumn("_block", F.floor((F.col(rank) - 1) / block))
    sums = at.groupBy("_block").agg(F.sum(F.coalesce(value, F.lit(0))).alias("s")).orderBy("_block").collect()
    before = accumulate((int(r["s"]) for r in sums[:-1]), initial=0)
    offsets = df.sparkSession.createDataFrame(
        [(r["_block"], b) for r, b in zip(sums, before, strict=True)] if sums else [],
        "_block long, _before long",
    )
    up_to = Window.partitionBy("_block").orderBy(rank).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.col("_before") + F.sum(F.coalesce(value, F.lit(0))).over(up_to)
    return at.join(F.broadcast(offsets), "_block").withColumn(name, total).drop("_block", "_before")
