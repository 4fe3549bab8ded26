"""Queries on the calendar.

Dates before year 1 cannot be collected into Python, so every result carries `iso_date` text.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from solstrand.operators import calendar as ops
from solstrand.plans.shown import as_text, as_text_sql
from solstrand.sources.tables import table

ATTRIBUTES = (
    "era iso_date millennium century century_name decade year_num quarter quarter_name season_num "
    "season_name month_num month_name week_num week_name day_num day_name year_month "
    "year_month_day flg_leap_year flg_weekend"
).split()
INDICATORS = (
    "quarter_num cum_quarter_in_year month_num cum_month_in_year month_in_quarter "
    "cum_month_in_quarter week_num cum_week_in_year week_in_quarter cum_week_in_quarter "
    "week_in_month cum_week_in_month day_of_year cum_day_of_year day_in_quarter "
    "cum_day_in_quarter day_in_month cum_day_in_month day_in_week cum_day_in_week"
).split()


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("dt", F.col("o_orderdate").cast("date"))


def order_period(spark: SparkSession, sf_dir: str) -> tuple[datetime.date, datetime.date]:
    """First and last order date, answered from a one-column scan."""
    row = order_days(spark, sf_dir).agg(F.min("dt").alias("a"), F.max("dt").alias("b")).first()
    return row["a"], row["b"]


def order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of all years touched by orders, as a dimension table."""
    first, last = order_period(spark, sf_dir)
    return ops.calendar(spark, f"{first.year}-01-01", f"{last.year}-12-31", as_of=last)


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per day; map-side partial sums collapse a hot day before the exchange."""
    return (
        order_days(spark, sf_dir)
        .groupBy("dt")
        .agg(
            F.count("*").alias("n_orders"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("revenue"),
        )
    )


def iso(column: str = "dt") -> Column:
    return F.col(column).cast("string")


def order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar attributes of every order, computed in the scan stage."""
    return ops.with_calendar(order_days(spark, sf_dir)).select("o_orderkey", *ATTRIBUTES)


def _moved_orders(spark: SparkSession, sf_dir: str, first: str, days: int) -> DataFrame:
    """Every order moved to one of `days` days from `first` on, spread by its key."""
    day = (F.col("o_orderkey") * 149 % days).cast("int")
    moved = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_add(F.to_date(F.lit(first)), day).alias("dt")
    )
    return ops.with_calendar(moved).select("o_orderkey", *ATTRIBUTES)


def deep_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders spread over the whole range -3999..2100."""
    return _moved_orders(spark, sf_dir, ops.FIRST_DATE, 2_227_979)


def bce_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders spread over the years -10..10."""
    return _moved_orders(spark, sf_dir, "-0010-01-01", 7670)


def century_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole 2.2 million day calendar left joined with the orders per day, by century."""
    dates = ops.with_calendar(ops.date_spine(spark))
    return (
        dates.join(daily_orders(spark, sf_dir), "dt", "left")
        .groupBy("era", "millennium", "century", "century_name")
        .agg(
            F.count("*").alias("n_days"),
            F.sum(F.col("flg_leap_year").cast("int")).alias("leap_days"),
            F.sum(F.col("flg_weekend").cast("int")).alias("weekend_days"),
            F.sum("season_num").alias("season_sum"),
            F.sum("week_num").alias("week_sum"),
            F.sum("year_month_day").alias("ymd_sum"),
            F.sum(F.coalesce("n_orders", F.lit(0))).alias("n_orders"),
        )
    )


def special_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six labelled dates, today being the last order date, with the orders of that day."""
    _, today = order_period(spark, sf_dir)
    dates = ops.with_calendar(ops.special_dates(spark, today))
    return (
        dates.join(daily_orders(spark, sf_dir), "dt", "left")
        .orderBy("dt")
        .select(*ATTRIBUTES, "description", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))
    )


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_calendar(spark, sf_dir).select(*ATTRIBUTES, "description")


def indicators_month_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running indicators over first days of month, as the source job computes them."""
    kpi = ops.month_start_indicators(order_calendar(spark, sf_dir))
    return kpi.select(iso().alias("iso_date"), *INDICATORS)


def indicators_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running indicators over every date, as the source job was asked for."""
    kpi = ops.calendar_indicators(order_calendar(spark, sf_dir))
    return kpi.select(iso().alias("iso_date"), *INDICATORS)


def indicators_iso_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly running sum that restarts with the ISO week."""
    kpi = ops.calendar_indicators(order_calendar(spark, sf_dir), week_year="iso")
    return kpi.select(iso().alias("iso_date"), "day_in_week", "cum_day_in_week")


def with_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The year of the last order: dates left joined with their indicators, newest first."""
    _, today = order_period(spark, sf_dir)
    calendar = order_calendar(spark, sf_dir)
    joined = ops.calendar_with_indicators(calendar, ops.month_start_indicators(calendar))
    kpi = [F.col(f"k_{c}") for c in INDICATORS]
    rows = ops.year_of(joined, today.year).select(
        "description", *ATTRIBUTES, iso("k_dt").alias("k_iso_date"), *kpi
    )
    return as_text(rows, *[f"k_{c}" for c in INDICATORS])


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly sales on the calendar: orders per day, then per month, next to the indicators."""
    calendar = order_calendar(spark, sf_dir)
    by_month = (
        ops.with_calendar(daily_orders(spark, sf_dir))
        .groupBy("year_num", "month_num")
        .agg(F.sum("n_orders").alias("n_orders"), F.sum("revenue").alias("revenue"))
    )
    return (
        calendar.filter("day_num = 1")
        .join(ops.month_start_indicators(calendar).drop("month_num"), "dt")
        .join(by_month, ["year_num", "month_num"], "left")
        .select(
            "iso_date",
            "year_num",
            "month_name",
            "quarter_name",
            "cum_quarter_in_year",
            "cum_month_in_year",
            "cum_week_in_year",
            "cum_day_of_year",
            F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
            F.coalesce(F.col("revenue").cast("double"), F.lit(0.0)).alias("revenue"),
        )
    )


QUERIES = {
    "calendar_dates": dates,
    "calendar_order_dates": order_dates,
    "calendar_deep_history": deep_history,
    "calendar_bce_edge": bce_edge,
    "calendar_century_profile": century_profile,
    "special_dates": special_dates,
    "calendar_kpi_month_start": indicators_month_start,
    "calendar_kpi_daily": indicators_daily,
    "calendar_kpi_iso_week": indicators_iso_week,
    "calendar_with_kpi": with_indicators,
    "sales_by_calendar": sales,
}


# --- SQL twins ----------------------------------------------------------------------------------

def _attributes(source: str) -> str:
    """SQL for the attributes of `dt` (a DATE) in the relation `source`, other columns kept."""
    return f"""
    SELECT *, CASE WHEN y < 1 THEN 'BCE' ELSE 'CE' END AS era,
      CASE WHEN y < 0 THEN '-' ELSE '' END || lpad(CAST(abs(y) AS VARCHAR), 4, '0') || '-'
        || lpad(CAST(m AS VARCHAR), 2, '0') || '-' || lpad(CAST(d AS VARCHAR), 2, '0') AS iso_date,
      CASE WHEN y > 0 THEN (y + 999) // 1000 ELSE -((-y) // 1000) END AS millennium,
      c AS century, CAST(c AS VARCHAR) || ' Century' AS century_name,
      y - (y % 10 + 10) % 10 AS decade,
      y AS year_num, q AS quarter, 'Q' || CAST(q AS VARCHAR) AS quarter_name,
      s AS season_num, ['Winter', 'Spring', 'Summer', 'Autumn'][s] AS season_name,
      m AS month_num, strftime(dt, '%B') AS month_name,
      w AS week_num, 'Week ' || CAST(w AS VARCHAR) AS week_name,
      d AS day_num, strftime(dt, '%A') AS day_name,
      y * 100 + m AS year_month, y * 10000 + m * 100 + d AS year_month_day,
      day(last_day(make_date(y, 2, 1))) = 29 AS flg_leap_year,
      isodow(dt) > 5 AS flg_weekend
    FROM (
      SELECT *, CASE WHEN y > 0 THEN (y + 99) // 100 ELSE -((-y) // 100) END AS c,
        CASE WHEN dt < make_date(y, 3, 20) THEN 1 WHEN dt < make_date(y, 6, 21) THEN 2
          WHEN dt < make_date(y, 9, 22) THEN 3 WHEN dt < make_date(y, 12, 21) THEN 4 ELSE 1 END AS s
      FROM (
        SELECT *, CAST(year(dt) AS INTEGER) AS y, CAST(month(dt) AS INTEGER) AS m,
          CAST(day(dt) AS INTEGER) AS d, CAST(quarter(dt) AS INTEGER) AS q,
          CAST(weekofyear(dt) AS INTEGER) AS w
        FROM {source}) AS parts) AS named"""


_PERIOD = """(SELECT unnest(generate_series(
        make_date(CAST((SELECT year(min(o_orderdate)) FROM orders) AS INTEGER), 1, 1),
        make_date(CAST((SELECT year(max(o_orderdate)) FROM orders) AS INTEGER), 12, 31),
        INTERVAL 1 DAY))::DATE AS dt)"""
_LABELS = """(SELECT DATE '4000-01-01 (BC)' AS dt, 'Minimum supported date' AS description
    UNION ALL SELECT DATE '0001-12-31 (BC)', 'Last day before the birth of Christ'
    UNION ALL SELECT DATE '0001-01-01', 'Birth of Christ (day 1 CE)'
    UNION ALL SELECT DATE '0001-01-02', 'First day after the birth of Christ'
    UNION ALL SELECT CAST(max(o_orderdate) AS DATE), 'Today' FROM orders
    UNION ALL SELECT DATE '2100-12-31', 'Maximum supported date')"""
_DAILY = """(SELECT CAST(o_orderdate AS DATE) AS dt, count(*) AS n_orders,
    sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue FROM orders GROUP BY 1)"""
_A = ", ".join(ATTRIBUTES)


def _running(value: str, keys: str) -> str:
    return (
        f"CAST(sum({value}) OVER (PARTITION BY {keys} ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING "
        "AND CURRENT ROW) AS INTEGER)"
    )


def _indicators(source: str) -> str:
    base = f"""SELECT dt, y, q AS quarter_num, m AS month_num, (m - 1) % 3 + 1 AS month_in_quarter,
        w AS week_num,
        CAST(date_diff('day', CAST(date_trunc('quarter', dt) AS DATE), dt) // 7 + 1 AS INTEGER)
          AS week_in_quarter,
        (d + 6) // 7 AS week_in_month, CAST(dayofyear(dt) AS INTEGER) AS day_of_year,
        CAST(date_diff('day', CAST(date_trunc('quarter', dt) AS DATE), dt) + 1 AS INTEGER)
          AS day_in_quarter,
        d AS day_in_month, CAST(dayofweek(dt) + 1 AS INTEGER) AS day_in_week,
        CAST(isoyear(dt) AS INTEGER) AS iso_year
      FROM ({_attributes(source)}) AS a"""
    return f"""SELECT strftime(dt, '%Y-%m-%d') AS iso_date, *,
      {_running('quarter_num', 'y')} AS cum_quarter_in_year,
      {_running('month_num', 'y')} AS cum_month_in_year,
      {_running('month_in_quarter', 'y, quarter_num')} AS cum_month_in_quarter,
      {_running('week_num', 'y')} AS cum_week_in_year,
      {_running('week_in_quarter', 'y, quarter_num')} AS cum_week_in_quarter,
      {_running('week_in_month', 'y, month_num')} AS cum_week_in_month,
      {_running('day_of_year', 'y')} AS cum_day_of_year,
      {_running('day_in_quarter', 'y, quarter_num')} AS cum_day_in_quarter,
      {_running('day_in_month', 'y, month_num')} AS cum_day_in_month,
      {_running('day_in_week', 'y, week_num')} AS cum_day_in_week,
      {_running('day_in_week', 'iso_year, week_num')} AS cum_day_in_iso_week
      FROM ({base}) AS b"""


_I = ", ".join(INDICATORS)
_MONTH_STARTS = f"(SELECT dt FROM {_PERIOD} WHERE day(dt) = 1)"
_FULL = """(SELECT CAST(unnest(generate_series(DATE '4000-01-01 (BC)', DATE '2100-12-31',
    INTERVAL 1 DAY)) AS DATE) AS dt)"""



def _moved(first: str, days: int) -> str:
    orders = f"""(SELECT o_orderkey,
        DATE '{first}' + CAST(o_orderkey * 149 % {days} AS INTEGER) AS dt FROM orders)"""
    return f"SELECT o_orderkey, {_A} FROM ({_attributes(orders)}) AS a"


ORACLES = {
    "calendar_dates": f"""SELECT {_A}, description
        FROM ({_attributes(_PERIOD)}) AS a LEFT JOIN {_LABELS} AS l USING (dt)""",
    "calendar_order_dates": f"""SELECT o_orderkey, {_A} FROM ({_attributes(
        "(SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dt FROM orders)")}) AS a""",
    "calendar_deep_history": _moved("4000-01-01 (BC)", 2_227_979),
    "calendar_bce_edge": _moved("0011-01-01 (BC)", 7670),
    "calendar_century_profile": f"""SELECT era, millennium, century, century_name,
          count(*) AS n_days, CAST(sum(CAST(flg_leap_year AS INTEGER)) AS BIGINT) AS leap_days,
          CAST(sum(CAST(flg_weekend AS INTEGER)) AS BIGINT) AS weekend_days,
          CAST(sum(season_num) AS BIGINT) AS season_sum, CAST(sum(week_num) AS BIGINT) AS week_sum,
          CAST(sum(year_month_day) AS BIGINT) AS ymd_sum,
          CAST(sum(coalesce(n_orders, 0)) AS BIGINT) AS n_orders
        FROM ({_attributes(_FULL)}) AS a LEFT JOIN {_DAILY} AS o USING (dt)
        GROUP BY era, millennium, century, century_name""",
    "special_dates": f"""SELECT {_A}, description, coalesce(n_orders, 0) AS n_orders
        FROM ({_attributes(_LABELS)}) AS a LEFT JOIN {_DAILY} AS o USING (dt) ORDER BY dt""",
    "calendar_kpi_month_start": f"SELECT iso_date, {_I} FROM ({_indicators(_MONTH_STARTS)}) AS k",
    "calendar_kpi_daily": f"SELECT iso_date, {_I} FROM ({_indicators(_PERIOD)}) AS k",
    "calendar_kpi_iso_week": f"""SELECT iso_date, day_in_week,
        cum_day_in_iso_week AS cum_day_in_week FROM ({_indicators(_PERIOD)}) AS k""",
    "calendar_with_kpi": as_text_sql(
        f"""SELECT description, {', '.join(f'a.{c}' for c in ATTRIBUTES)},
          k.iso_date AS k_iso_date, {', '.join(f'k.{c} AS k_{c}' for c in INDICATORS)}
        FROM ({_attributes(_PERIOD)}) AS a LEFT JOIN {_LABELS} AS l ON a.dt = l.dt
        LEFT JOIN ({_indicators(_MONTH_STARTS)}) AS k ON a.dt = k.dt
        WHERE a.year_num = (SELECT year(max(o_orderdate)) FROM orders) ORDER BY a.dt DESC""",
        *[f"k_{c}" for c in INDICATORS],
    ),
    "sales_by_calendar": f"""SELECT a.iso_date, a.year_num, a.month_name, a.quarter_name,
          k.cum_quarter_in_year, k.cum_month_in_year, k.cum_week_in_year, k.cum_day_of_year,
          coalesce(s.n_orders, 0) AS n_orders,
          coalesce(CAST(s.revenue AS DOUBLE), 0.0) AS revenue
        FROM ({_attributes(_MONTH_STARTS)}) AS a
        JOIN ({_indicators(_MONTH_STARTS)}) AS k ON a.dt = k.dt
        LEFT JOIN (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, count(*) AS n_orders,
            sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue FROM orders GROUP BY 1, 2) AS s
          ON s.y = a.year_num AND s.m = a.month_num""",
}
