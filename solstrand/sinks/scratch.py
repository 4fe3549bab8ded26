"""Intermediate tables that cut a plan in two.

They live in the shared folder the cluster names in `spark.checkpoint.dir`, so they outlive the
executors that wrote them.  Only a local session without that setting falls back to a temporary
folder of this machine.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.conf.get("spark.app.id", "app")
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="solstrand-")
        folder = _local_folders[app]
    return f"{folder.rstrip('/')}/solstrand/{spark.conf.get('spark.app.id', 'app')}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name, used by nobody else."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` written out once and read back: later steps see one fixed set of rows."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def bucketed(df: DataFrame, label: str, key: str, buckets: int) -> Iterator[DataFrame]:
    """The distinct rows of `df`, written out once in buckets of `key`: joins on `key` do not exchange them again.

    Each bucket is written by one task; equal rows meet there.  The catalog forgets the table at the end of the `with` block; the
    files stay with the others of the scratch folder.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    name = f"spark_catalog.default.{path.rsplit('/', 1)[-1].replace('-', '_')}"
    df.repartition(buckets, key).distinct().write.bucketBy(buckets, key).option("path", path).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")
