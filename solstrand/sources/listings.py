"""Marketplace listings handed over as Python dictionaries."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from solstrand.sources.schemas import LISTING


def typed_listings(spark: SparkSession, listings: Iterable[Mapping[str, Any]]) -> DataFrame:
    """Listings with nested `detail` and `summary` under the fixed schema; other keys are left out."""
    rows = [{k: x.get(k) for k in ("id", "detail", "summary")} for x in listings]
    return spark.createDataFrame(rows, LISTING)


def inferred_listings(spark: SparkSession, listings: Iterable[Mapping[str, Any]]) -> DataFrame:
    """Listings under an inferred schema, `detail` and `summary` as JSON text."""
    rows = [
        {**x, **{k: json.dumps(x.get(k), ensure_ascii=False) for k in ("detail", "summary")}}
        for x in listings
    ]
    return spark.createDataFrame(rows)


def from_pandas(spark: SparkSession, frame: pd.DataFrame) -> DataFrame:
    """A small pandas frame as a DataFrame, columns without any value included as `void`."""
    return spark.createDataFrame(frame)


def named_like(listings: DataFrame, part: str) -> DataFrame:
    """Listings whose summary name contains `part`."""
    return listings.filter(F.col("summary.name").contains(part))


def share_of(listings: DataFrame, part: str) -> DataFrame:
    """`id` and share name of one listing whose name contains `part`: one row, or none.

    The smallest id is taken, so the answer repeats; it is found by a partial minimum per task.
    """
    return (
        named_like(listings, part)
        .select("id", F.col("summary.share.name").alias("name"))
        .orderBy("id", "name")
        .limit(1)
    )
