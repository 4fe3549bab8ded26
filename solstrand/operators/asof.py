"""As-of joins: to each row the latest earlier (or the next later) row of its key in another table.

A key's rows are cut by time, at quantiles of all times, so a key with a third of all rows is worked
off by many tasks.  Within a cut both tables are merged in order and the last row seen is kept; what a
cut inherits from the cuts before it is one row for each key and cut.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cuts of the time axis; a key's rows of one cut, about 1 / SPLITS of all rows, meet in a task.
SPLITS = 64


def time_cuts(times: DataFrame, splits: int = SPLITS) -> list:
    """Rising values that cut the single column of `times` into about equal parts; empty if it has none."""
    shares = [i / splits for i in range(1, splits)]
    (column,) = times.columns
    found = times.agg(F.percentile_approx(column, shares, 20 * splits)).first()[0]
    return sorted(set(found or []))


def _cut_of(time: Column, cuts: list) -> Column:
    """How many of the cuts lie before `time`; -1 without a time.

    Found by halves: a row is compared with about log2 of the cuts.
    """

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        half = (low + high) // 2
        return F.when(time > F.lit(cuts[half]), between(half + 1, high)).otherwise(between(low, half))

    return F.when(time.isNull(), -1).otherwise(between(0, len(cuts)))


class Known(NamedTuple):
    """A table to look up in: its rows, their time, {column: new name} of what is wanted, and what
    decides between rows that agree in keys and time: the greatest `tie` columns, then values."""

    rows: DataFrame
    time: str
    values: dict[str, str]
    tie: Sequence[str] = ()


def asof_joins(
    left: DataFrame,
    known: Sequence[Known],
    keys: Sequence[str],
    time: str,
    exact: bool = True,
    later: bool = False,
    within: str | None = None,
    cuts: list | None = None,
) -> DataFrame:
    """All rows of `left`, with the wanted values of one row of each of the `known` tables.

    That row has the same `keys` and the greatest time up to the left row's `time`; with `later`, the
    least from it on.  Without `exact` equal times do not match.  `within` ("7 days") is the farthest a
    match may be away.  `cuts` are those of `time_cuts`, if there are any already; else they cost a scan
    of all times.  Where there is no match, or a key or time is NULL, the new columns are NULL.

    All tables are exchanged once, by key and cut, however many are looked up in.  Rows of `left` that
    agree in keys and time cannot be told apart and stay together.
    """
    new = [n for k in known for n in k.values.values()]
    clash = (set(new) & set(left.columns)) | {n for n in new if new.count(n) > 1}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are there already")
    if cuts is None:
        times = left.select(F.col(time).alias("t"))
        for k in known:
            times = times.union(k.rows.select(k.time))
        cuts = time_cuts(times)

    # At equal times what is known comes first if it may match.
    side = {True: (1, 0), False: (0, 1)}[exact]
    rows = left.select(
        *keys,
        F.col(time).alias("_time"),
        _cut_of(F.col(time), cuts).alias("_cut"),
        F.lit(side[0]).alias("_side"),
        F.struct("*").alias("_row"),
    )
    names = [f"_known{i}" for i in range(len(known))]
    for name, k in zip(names, known, strict=True):
        there = F.col(k.time).isNotNull()
        for key in keys:
            there &= F.col(key).isNotNull()
        ordered = F.struct(*dict.fromkeys([*k.tie, *k.values]))
        latest = k.rows.filter(there).groupBy(*keys, F.col(k.time).alias("_time")).agg(F.max(ordered).alias("_best"))
        one = latest.select(
            *keys,
            "_time",
            _cut_of(F.col("_time"), cuts).alias("_cut"),
            F.lit(side[1]).alias("_side"),
            F.struct("_time", "_best").alias(name),
        )
        rows = rows.unionByName(one, allowMissingColumns=True)

    def in_order(name: str) -> Column:
        return F.col(name).desc() if later else F.col(name).asc()

    seen = (
        Window.partitionBy(*keys, "_cut")
        .orderBy(in_order("_time"), "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = (
        Window.partitionBy(*keys).orderBy(in_order("_cut")).rowsBetween(Window.unboundedPreceding, -1)
    )
    best = F.min if later else F.max
    inherited = (
        rows.groupBy(*keys, "_cut")
        .agg(*[best(n).alias(n) for n in names])
        .select(*keys, "_cut", *[F.last(n, ignorenulls=True).over(before).alias(f"{n}_before") for n in names])
    )
    own = rows.select(*keys, "_cut", "_time", "_row", *[F.last(n, ignorenulls=True).over(seen).alias(n) for n in names])
    matched = own.filter("_row IS NOT NULL").join(inherited, [*keys, "_cut"], "left")

    def match(name: str) -> Column:
        found = F.when(F.col("_time").isNotNull(), F.coalesce(name, f"{name}_before"))
        if not within:
            return found
        apart = F.expr(f"INTERVAL {within}")
        near = F.col("_time") + apart >= found["_time"] if later else found["_time"] + apart >= F.col("_time")
        return F.when(near, found)

    values = [
        match(name)["_best"][column].alias(new_name)
        for name, k in zip(names, known, strict=True)
        for column, new_name in k.values.items()
    ]
    return matched.select("_row.*", *values)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    values: dict[str, str],
    tie: Sequence[str] = (),
    **how,
) -> DataFrame:
    """`asof_joins` with one table."""
    return asof_joins(left, [Known(right, right_time, values, tie)], keys, left_time, **how)
