from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from solstrand.operators import calendar as ops

TODAY = datetime.date(2024, 12, 1)


def test_whole_range(spark):
    dates = ops.with_calendar(ops.date_spine(spark))
    row = dates.agg(
        F.count("*"),
        F.count_if(F.col("era") == "BCE"),
        F.count_if(F.col("era") == "CE"),
        F.count_if(F.col("flg_leap_year") & (F.dayofyear("dt") == 1)),
        F.count_if(F.col("day_num") == 1),
        F.count_distinct("dt"),
    ).first()
    assert tuple(row) == (2_227_979, 1_460_970, 767_009, 1_479, 73_200, 2_227_979)


def test_spine_is_spread_over_tasks(spark):
    assert ops.date_spine(spark).rdd.getNumPartitions() > 1


def test_spine_ends(spark):
    assert ops.date_spine(spark, "2024-02-28", "2024-03-01").count() == 3
    assert ops.date_spine(spark, "2024-03-01", "2024-02-28").count() == 0


def attributes(spark, iso: str):
    df = spark.range(1).select(F.to_date(F.lit(iso)).alias("dt"))
    return ops.with_calendar(df).drop("dt").first()


@pytest.mark.parametrize(
    ("iso", "era", "millennium", "century", "decade", "year_month", "year_month_day", "leap"),
    [
        ("-3999-01-01", "BCE", -3, -39, -4000, -399899, -39989899, False),
        ("-0400-02-29", "BCE", 0, -4, -400, -39998, -3999771, True),
        ("0000-12-31", "BCE", 0, 0, 0, 12, 1231, True),
        ("0001-01-01", "CE", 1, 1, 0, 101, 10101, False),
        ("0100-06-15", "CE", 1, 1, 100, 10006, 1000615, False),
        ("0101-06-15", "CE", 1, 2, 100, 10106, 1010615, False),
        ("1900-03-01", "CE", 2, 19, 1900, 190003, 19000301, False),
        ("2000-12-31", "CE", 2, 20, 2000, 200012, 20001231, True),
        ("2001-01-01", "CE", 3, 21, 2000, 200101, 20010101, False),
    ],
)
def test_attributes(spark, iso, era, millennium, century, decade, year_month, year_month_day, leap):
    row = attributes(spark, iso)
    assert row["iso_date"] == iso
    assert (row["era"], row["millennium"], row["century"]) == (era, millennium, century)
    assert row["century_name"] == f"{century} Century"
    assert (row["decade"], row["year_month"], row["year_month_day"]) == (
        decade,
        year_month,
        year_month_day,
    )
    assert row["flg_leap_year"] is leap


@pytest.mark.parametrize(
    ("day", "season"),
    [
        ("12-20", "Autumn"), ("12-21", "Winter"), ("03-19", "Winter"), ("03-20", "Spring"),
        ("06-20", "Spring"), ("06-21", "Summer"), ("09-21", "Summer"), ("09-22", "Autumn"),
    ],
)
def test_seasons(spark, day, season):
    assert attributes(spark, f"2023-{day}")["season_name"] == season


def test_names(spark):
    row = attributes(spark, "2024-12-01")
    assert (row["month_name"], row["day_name"], row["flg_weekend"]) == ("December", "Sunday", True)
    assert (row["quarter_name"], row["week_name"], row["day_num"]) == ("Q4", "Week 48", 1)


def test_calendar_table_has_the_23_columns(spark):
    df = ops.calendar(spark, "2024-01-01", "2024-12-31", TODAY)
    assert len(df.columns) == 23 and df.columns[0] == "era" and df.columns[-1] == "description"
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    assert {k for k, v in kinds.items() if v == "bigint"} == set()
    assert [r["iso_date"] for r in df.filter("description = 'Today'").collect()] == ["2024-12-01"]


def test_today_on_a_labelled_date_gives_two_rows(spark):
    df = ops.calendar(spark, "0001-01-01", "0001-01-03", datetime.date(1, 1, 1))
    assert df.filter("iso_date = '0001-01-01'").count() == 2


def test_golden_month_start_row(spark):
    dates = ops.calendar(spark, "2024-01-01", "2024-12-31", TODAY)
    row = ops.month_start_indicators(dates).filter("dt = DATE'2024-12-01'").first()
    assert (row["cum_quarter_in_year"], row["cum_month_in_year"]) == (30, 78)
    assert (row["cum_week_in_year"], row["cum_day_of_year"], row["cum_day_in_month"]) == (294, 2020, 1)


def test_daily_running_sums_are_prefix_sums(spark):
    dates = ops.with_calendar(ops.date_spine(spark, "2019-12-01", "2021-02-10"))
    rows = ops.calendar_indicators(dates).orderBy("dt").collect()
    periods = {
        "year": lambda d: d.year,
        "quarter": lambda d: (d.year, (d.month - 1) // 3),
        "month": lambda d: (d.year, d.month),
        "week": lambda d: (d.year, d.isocalendar()[1]),
    }
    for name, (indicator, period) in ops.RUNNING.items():
        total, sums = {}, []
        for r in rows:
            key = periods[period](r["dt"])
            total[key] = total.get(key, 0) + r[indicator]
            sums.append(total[key])
        assert [r[name] for r in rows] == sums, name


def test_weeks_that_cross_new_year(spark):
    """By calendar year, 29-31 December and early January of one year share week 1."""
    dates = ops.with_calendar(ops.date_spine(spark, "1990-01-01", "2030-12-31"))
    kpi = ops.calendar_indicators(dates)
    longest = kpi.groupBy(F.year("dt"), "week_num").count().filter("count > 7")
    assert longest.count() == 28 and longest.agg(F.max("count")).first()[0] == 9
    iso = ops.calendar_indicators(dates, week_year="iso")
    # A whole ISO week runs 2, 5, 9, 14, 20, 27, 28 (Sunday counts 1).
    assert iso.agg(F.max("cum_day_in_week")).first()[0] == 28
    assert iso.filter("dt = DATE'2025-01-01'").first()["cum_day_in_week"] == 2 + 3 + 4


def test_indicators_share_one_exchange(spark):
    dates = ops.with_calendar(ops.date_spine(spark, "1990-01-01", "2030-12-31"))
    plan = ops.calendar_indicators(dates)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_newest_first(spark):
    dates = ops.calendar(spark, "2023-01-01", "2024-12-31", TODAY)
    joined = ops.calendar_with_indicators(dates, ops.month_start_indicators(dates))
    rows = ops.year_of(joined, 2024).select("dt", "k_dt").collect()
    assert len(rows) == 366 and rows[0]["dt"] == datetime.date(2024, 12, 31)
    assert sum(r["k_dt"] is not None for r in rows) == 12
