"""Exact consecutive row numbers over a whole table.

`row_number() OVER (ORDER BY url)` moves the table into one task.  Here the rows are range-split
over all tasks, written once, and numbered by adding to each row's place in its range the number
of rows in the ranges before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from solstrand.functions.rows import row_fingerprint
from solstrand.sinks.scratch import written

# monotonically_increasing_id(): task number above these bits, place in the task below.
_PLACE_BITS = 33


def numbered(
    df: DataFrame, order: list[Column], name: str = "id", group: str | None = None
) -> DataFrame:
    """Row numbers from 1 as BIGINT `name`: over the whole frame, or restarting per `group` value.

    Ties in `order` are broken by the row fingerprint, so the numbers repeat from run to run.
    Rows that agree in everything are told apart by their place in the input, which also splits
    a long run of copies over several tasks.  For that place to be the same when a lost task is
    run again, `df` must come from stored rows by filters, projections and unions only; write the
    result of a join or aggregation out first (`written`).  Meant for few groups, each of any
    size; a window function is the better choice for many small ones.

    One scan feeds one range exchange and one write; the count per range reads a single column.
    """
    if name in df.columns:
        raise ValueError(f"there is a column {name} already")
    hashable = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    keys = [F.col(f"`{group}`")] if group else []
    tie = df.withColumns({"_tie": row_fingerprint(hashable), "_in": F.monotonically_increasing_id()})
    ordering = [*keys, *order, F.col("_tie"), F.col("_in")]
    ranged = (
        tie.repartitionByRange(*ordering)
        .sortWithinPartitions(*ordering)
        .drop("_tie", "_in")
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    fixed = written(ranged, "numbered")

    task = F.shiftright("_slot", _PLACE_BITS).alias("_task")
    # A sorted range split gives at most (tasks + groups) spans of one row each.  Written out, their
    # size is known to the planner, which broadcasts them below spark.sql.autoBroadcastJoinThreshold
    # and joins by hash or merge above it.
    spans = written(
        fixed.groupBy(task, *keys).agg(F.count("*").alias("_rows"), F.min("_slot").alias("_first")),
        "spans",
    )
    earlier = Window.partitionBy(*keys).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = spans.select(
        "_task", *keys, "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    number = F.col("_before") + F.col("_slot") - F.col("_first") + 1
    on = F.col("rows._task") == F.col("starts._task")
    if group:
        on &= F.col(f"rows.`{group}`").eqNullSafe(F.col(f"starts.`{group}`"))
    return (
        fixed.withColumn("_task", task)
        .alias("rows")
        .join(starts.alias("starts"), on)
        .select(number.alias(name), *[F.col(f"rows.`{c}`") for c in df.columns])
    )
