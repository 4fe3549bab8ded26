"""Tables, views and file layouts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from solstrand.functions.rows import row_fingerprint


def replace_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Create the table or replace its rows and its schema."""
    df.write.mode("overwrite").format(fmt).option("overwriteSchema", "true").saveAsTable(name)


def use_schema(spark: SparkSession, schema: str, catalog: str | None = None) -> None:
    """Make `schema` the one unqualified names refer to."""
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    spark.catalog.setCurrentDatabase(schema)


def declare_table(spark: SparkSession, name: str, columns: str, fmt: str = "parquet") -> None:
    """An empty table with declared columns, in place of any table of that name."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt}")


def store_declared(df: DataFrame, name: str, columns: str, fmt: str = "parquet") -> None:
    """A table of declared columns with the rows of `df`, in place of any table of that name.

    The rows are inserted by position into a table beside it, which takes the name only then: a job
    that fails leaves the old table as it was.  `df` must not read the table that is replaced.
    """
    spark, beside = df.sparkSession, f"{name}__new"
    declare_table(spark, beside, columns, fmt)
    insert_by_position(df, beside)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")


def store_view(spark: SparkSession, name: str, query: str) -> None:
    """A view kept in the catalog, or replaced there; `query` reads stored tables."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def annotate_table(
    spark: SparkSession, name: str, comment: str, properties: Mapping[str, str] | None = None
) -> None:
    """Comment and properties of a table."""
    given = {"comment": comment, **(properties or {})}
    pairs = ", ".join(f"'{k}' = '{v}'" for k, v in given.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def insert_by_position(df: DataFrame, name: str) -> None:
    """Append to a table: columns are matched by position and cast to the table's types.

    ANSI store assignment applies: a BIGINT that does not fit the INT column fails the job.
    """
    df.write.insertInto(name)


def replace_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def write_partitioned(df: DataFrame, path: str, column: str, mode: str = "overwrite") -> None:
    """One folder per value of `column`, for partition pruning.

    The rebalance hint gathers each value's rows into few files, and lets the adaptive planner cut
    a value that holds a large part of the rows into several tasks.
    """
    df.hint("rebalance", column).write.mode(mode).partitionBy(column).parquet(path)


def write_clustered(df: DataFrame, path: str, key: str, mode: str = "overwrite") -> None:
    """Files sorted and range-split by `key`, so min/max statistics prune lookups on it.

    The row fingerprint behind the key lets the range split run through the rows of one hot key.
    """
    others = [c for c in df.columns if c != key and not _holds_map(df, c)]
    spread = row_fingerprint(others or [key])
    (
        df.withColumn("_spread", spread)
        .repartitionByRange(key, "_spread")
        .sortWithinPartitions(key)
        .drop("_spread")
        .write.mode(mode)
        .parquet(path)
    )


def _holds_map(df: DataFrame, column: str) -> bool:
    return "map<" in df.schema[column].dataType.simpleString()


def replace_files(df: DataFrame, path: str) -> None:
    """Overwrite a folder of parquet files; the new schema replaces the old one."""
    df.write.mode("overwrite").parquet(path)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))
