"""How results are shown.

Timestamps, and integers and booleans that may be NULL, come out of different client libraries as
floats, objects or types of their own; as text they are the same everywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def as_text_sql(sql: str, *columns: str) -> str:
    casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({casts}) FROM ({sql}) AS shown"
