"""Calendar dimension, labelled dates and running calendar indicators."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from solstrand.functions.dates import calendar_columns, indicator_columns, iso_week_year

# The calendar range and the labels of the special dates.
FIRST_DATE = "-3999-01-01"
LAST_DATE = "2100-12-31"
SPECIAL_DATES = [
    ("-3999-01-01", "Minimum supported date"),
    ("0000-12-31", "Last day before the birth of Christ"),
    ("0001-01-01", "Birth of Christ (day 1 CE)"),
    ("0001-01-02", "First day after the birth of Christ"),
    ("2100-12-31", "Maximum supported date"),
]
TODAY_LABEL = "Today"

# Running indicator -> the indicator it sums and the period it restarts in.
RUNNING = {
    "cum_quarter_in_year": ("quarter_num", "year"),
    "cum_month_in_year": ("month_num", "year"),
    "cum_month_in_quarter": ("month_in_quarter", "quarter"),
    "cum_week_in_year": ("week_num", "year"),
    "cum_week_in_quarter": ("week_in_quarter", "quarter"),
    "cum_week_in_month": ("week_in_month", "month"),
    "cum_day_of_year": ("day_of_year", "year"),
    "cum_day_in_quarter": ("day_in_quarter", "quarter"),
    "cum_day_in_month": ("day_in_month", "month"),
    "cum_day_in_week": ("day_in_week", "week"),
}


def date_spine(spark: SparkSession, first: str = FIRST_DATE, last: str = LAST_DATE) -> DataFrame:
    """One row per day, `dt`, both ends included.

    `spark.range` spreads the days over tasks; `explode(sequence(...))` of two constants would be
    folded into one literal array in one task.
    """
    start, end = (F.to_date(F.lit(d)) for d in (first, last))
    days = spark.range(1).select((F.datediff(end, start) + 1).alias("n")).first()["n"]
    return spark.range(max(days, 0)).select(F.date_add(start, F.col("id").cast("int")).alias("dt"))


def special_dates(spark: SparkSession, as_of: datetime.date | str | None = None) -> DataFrame:
    """The six labelled dates (`dt`, `description`); `as_of` is "today" and defaults to the clock.

    A literal relation: the planner knows its size.
    """
    today = f"DATE'{as_of}'" if as_of else "current_date()"
    rows = [f"(DATE'{day}', '{label}')" for day, label in SPECIAL_DATES]
    rows.append(f"({today}, '{TODAY_LABEL}')")
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(dt, description)")


def with_calendar(df: DataFrame, dt: Column | str = "dt") -> DataFrame:
    """Calendar attributes of every row's date, without a join; other columns are kept in front."""
    dt = F.col(dt) if isinstance(dt, str) else dt
    columns = calendar_columns(dt)
    kept = [F.col(c) for c in df.columns if c not in columns]
    return df.select(*kept, *[c.alias(name) for name, c in columns.items()])


def describe_dates(dates: DataFrame, as_of: datetime.date | str | None = None) -> DataFrame:
    """Left join with the special dates: a date with two labels gives two rows, as in SQL.

    The six literal rows are broadcast by the planner.
    """
    return dates.join(special_dates(dates.sparkSession, as_of), "dt", "left")


def calendar(
    spark: SparkSession,
    first: str = FIRST_DATE,
    last: str = LAST_DATE,
    as_of: datetime.date | str | None = None,
) -> DataFrame:
    """The calendar table: 22 attributes and the description."""
    dates = describe_dates(with_calendar(date_spine(spark, first, last)), as_of)
    return dates.select(*calendar_columns(F.col("dt")), "description")


def calendar_indicators(dates: DataFrame, week_year: str = "calendar") -> DataFrame:
    """Running sums of the calendar indicators over `dt` (one row per date in `dates`).

    All four window specifications nest in the year, so one exchange by year serves them all; a
    year holds at most 366 dates, which bounds every group.  `week_year="iso"` restarts the weekly
    sum with the ISO week instead of letting 29-31 December share week 1 with early January.
    """
    if week_year not in ("calendar", "iso"):
        raise ValueError("week_year must be 'calendar' or 'iso'")
    dt = F.col("dt")
    week_of = F.year(dt) if week_year == "calendar" else iso_week_year(dt)
    base = dates.select(
        "dt",
        F.year(dt).alias("_year"),
        week_of.alias("_week_year"),
        *[c.alias(name) for name, c in indicator_columns(dt).items()],
    )
    # An ISO year crosses the calendar year, so it needs an exchange of its own.
    week_keys = ["_year", "week_num"] if week_year == "calendar" else ["_week_year", "week_num"]
    periods = {
        "year": ["_year"],
        "quarter": ["_year", "quarter_num"],
        "month": ["_year", "month_num"],
        "week": week_keys,
    }

    def running(indicator: str, period: str) -> Column:
        upto_here = (
            Window.partitionBy(*periods[period])
            .orderBy("dt")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return F.sum(indicator).over(upto_here).cast("int")

    summed = base.repartition("_year").select(
        "*", *[running(ind, per).alias(name) for name, (ind, per) in RUNNING.items()]
    )
    order = ["dt"]
    for indicator in indicator_columns(dt):
        order += [indicator, *[n for n, (i, _) in RUNNING.items() if i == indicator]]
    return summed.select(*order)


def month_start_indicators(dates: DataFrame) -> DataFrame:
    """The indicators over the first day of each month only; `day_num` is a stored, pushable column."""
    return calendar_indicators(dates.filter(F.col("day_num") == 1))


def calendar_with_indicators(dates: DataFrame, indicators: DataFrame) -> DataFrame:
    """Left join on the date; columns of the indicator table get the prefix `k_`."""
    renamed = indicators.select(*[F.col(c).alias(f"k_{c}") for c in indicators.columns])
    return dates.join(renamed, dates["dt"] == renamed["k_dt"], "left")


def year_of(dates: DataFrame, year: int | Column) -> DataFrame:
    """The dates of one year, newest first."""
    return dates.filter(F.col("year_num") == year).orderBy(F.desc("dt"))
