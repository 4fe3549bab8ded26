"""Batch tables and job parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stored table: `<folder>/<name>.parquet`, one file or a folder of part files."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def preview(spark: SparkSession, name: str, columns: str = "*") -> DataFrame:
    """Ad-hoc SQL over a catalog table or view."""
    return spark.sql(f"SELECT {columns} FROM {name}")


def job_parameter(spark: SparkSession, key: str, default: str | None = None) -> str:
    """A parameter of the running job from the session configuration."""
    value = spark.conf.get(key, default)
    if value is None:
        raise KeyError(f"set the session configuration {key}")
    return value


def relational_table(
    spark: SparkSession,
    url: str,
    name: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 32,
    fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    """A table of a relational database over JDBC.

    With `partition_column` and its `bounds` the scan is split into range queries, one per task;
    without them one task reads the whole table, which only suits the small dimension levels.
    """
    return (
        spark.read.format("jdbc")
        .options(**relational_options(url, name, partition_column, bounds, partitions, fetch_size))
        .options(**options)
        .load()
    )


def relational_options(
    url: str,
    name: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 32,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    options = {"url": url, "dbtable": name, "fetchsize": str(fetch_size)}
    if partition_column:
        if bounds is None:
            raise ValueError("a partitioned scan needs the bounds of its partition column")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options
