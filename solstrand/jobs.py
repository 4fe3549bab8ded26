"""Whole jobs: read the sources, run the operators, store the tables."""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from solstrand.operators.calendar import (
    calendar,
    month_start_indicators,
    special_dates,
    with_calendar,
)
from solstrand.operators.feeds import CountryGuess, feeds_union
from solstrand.operators.frames import drop_void_columns
from solstrand.operators.geo import world
from solstrand.sinks.tables import replace_table, store_declared
from solstrand.sources.api_pages import articles_of, read_pages
from solstrand.sources.tables import relational_table

# The declared columns of the calendar tables.
CALENDAR_COLUMNS = (
    "era STRING, dt DATE, iso_date STRING, millennium INT, century INT, century_name STRING, "
    "decade INT, year_num INT, quarter INT, quarter_name STRING, season_num INT, "
    "season_name STRING, month_num INT, month_name STRING, week_num INT, week_name STRING, "
    "day_num INT, day_name STRING, year_month INT, year_month_day INT, flg_leap_year BOOLEAN, "
    "flg_weekend BOOLEAN, description STRING"
)
INDICATOR_COLUMNS = (
    "dt DATE, quarter_num INT, cum_quarter_in_year INT, month_num INT, cum_month_in_year INT, "
    "month_in_quarter INT, cum_month_in_quarter INT, week_num INT, cum_week_in_year INT, "
    "week_in_quarter INT, cum_week_in_quarter INT, week_in_month INT, cum_week_in_month INT, "
    "day_of_year INT, cum_day_of_year INT, day_in_quarter INT, cum_day_in_quarter INT, "
    "day_in_month INT, cum_day_in_month INT, day_in_week INT, cum_day_in_week INT"
)


def store_calendar(
    spark: SparkSession, schema: str, as_of: datetime.date | str | None = None, **period: str
) -> None:
    """The tables `special_dates`, `dates` and `dates_kpi` in `schema`.

    The indicators are read from the stored dates, so the first-of-month filter is pushed down.
    """
    labelled = with_calendar(special_dates(spark, as_of))
    names = [c.split()[0] for c in CALENDAR_COLUMNS.split(", ")]
    tables = {
        "special_dates": (CALENDAR_COLUMNS, labelled.select(*names)),
        "dates": (CALENDAR_COLUMNS, calendar(spark, as_of=as_of, **period)),
    }
    for table, (columns, rows) in tables.items():
        store_declared(rows, f"{schema}.{table}", columns)
    indicators = month_start_indicators(spark.table(f"{schema}.dates"))
    store_declared(indicators, f"{schema}.dates_kpi", INDICATOR_COLUMNS)


def store_news(
    feeds: Mapping[str, DataFrame],
    country_guess: CountryGuess,
    table: str,
    id_offsets: Mapping[str, int] | None = None,
) -> None:
    """All feeds in one table; `id_offsets` as in `feeds_union`."""
    replace_table(feeds_union(feeds, country_guess, id_offsets), table)


def store_api_articles(spark: SparkSession, path: str, table: str, lines: bool = False) -> None:
    """The articles of all landed pages, replacing table and schema; `lines` as in `read_pages`."""
    replace_table(drop_void_columns(articles_of(read_pages(spark, path, lines))), table)


def world_from_database(
    spark: SparkSession, url: str, city_ids: tuple[int, int], schema: str = "public", **options: str
) -> DataFrame:
    """The geographic hierarchy out of five relational tables.

    The cities are read in ranges of their id; the levels above are small.
    """
    cities = relational_table(spark, url, f"{schema}.cities", "id", city_ids, **options)
    upper = [
        relational_table(spark, url, f"{schema}.{name}", **options)
        for name in ("states", "countries", "subregions", "regions")
    ]
    return world(cities, *upper)
