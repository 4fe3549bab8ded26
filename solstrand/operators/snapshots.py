"""Changes between two snapshots of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from solstrand.functions.rows import row_fingerprint


def snapshot_changes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows that differ, with `change_type` insert, update_preimage, update_postimage or delete.

    `copies` says how many equal rows came or went; it is 1 where the key is unique, and keeps the
    result exact where it is not.  Both snapshots are scanned and exchanged once.  Equal rows are
    summed up within each task before, so what did not change leaves one row per task at most, and a
    pile of copies is one row per task.  Only changed rows are gathered by key.
    """
    columns = [c for c in old.columns if c != key]
    if set(old.columns) != set(new.columns):
        raise ValueError("the snapshots have different columns")

    def marked(df: DataFrame, step: int) -> DataFrame:
        return df.select(
            F.col(key),
            row_fingerprint(sorted(columns)).alias("_mark"),
            F.lit(step).alias("_step"),
            F.struct(*columns).alias("_row"),
        )

    versions = (
        marked(old, -1)
        .unionByName(marked(new, 1))
        .groupBy(key, "_mark")
        .agg(F.sum("_step").alias("_net"), F.first("_row").alias("_row"))
        .filter(F.col("_net") != 0)
    )
    of_key = Window.partitionBy(key)
    gone = F.col("_net") < 0
    both = F.max(gone).over(of_key) & F.max(~gone).over(of_key)
    kind = (
        F.when(both & gone, "update_preimage")
        .when(both, "update_postimage")
        .when(gone, "delete")
        .otherwise("insert")
    )
    return versions.withColumn("change_type", kind).select(
        "change_type",
        F.abs("_net").alias("copies"),
        *[F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in old.columns],
    )
