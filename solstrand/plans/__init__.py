"""The registered queries and, next to each, its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from solstrand.plans import (
    articles,
    behaviour,
    calendar,
    customers,
    feeds,
    geo,
    live,
    stored,
    stores,
    streams,
    supply,
)

AREAS = (calendar, feeds, geo, articles, streams, stores, stored, behaviour, supply, live, customers)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for area in AREAS for name, query in area.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for area in AREAS for name, sql in area.ORACLES.items()}
