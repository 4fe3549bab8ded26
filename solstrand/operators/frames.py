"""Steps driven by the schema of a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame


def drop_void_columns(df: DataFrame) -> DataFrame:
    """Without the columns of type `void`, which no file format can store."""
    return df.drop(*[f.name for f in df.schema if f.dataType.typeName() == "void"])
