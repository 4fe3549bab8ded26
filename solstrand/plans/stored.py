"""Whole jobs run into a schema of their own; the stored tables are read back and joined."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from solstrand import jobs
from solstrand.plans import calendar as dates_plans
from solstrand.plans import feeds as feeds_plans
from solstrand.plans import stores as stores_plans
from solstrand.plans.shown import as_text
from solstrand.sinks import tables as sinks
from solstrand.sinks.scratch import scratch_path
from solstrand.sources.tables import table


def own_schema(spark: SparkSession) -> str:
    """A new schema whose tables lie in the scratch folder."""
    name = f"solstrand_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'schema')}'")
    return name


def calendar_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole stored calendar with its labels, its month starts and the orders of its days, by year."""
    schema = own_schema(spark)
    _, today = dates_plans.order_period(spark, sf_dir)
    jobs.store_calendar(spark, schema, today)
    starts = spark.table(f"{schema}.dates_kpi").select(
        "dt", F.lit(1).alias("starts"), "cum_day_of_year"
    )
    return (
        spark.table(f"{schema}.dates")
        .join(starts, "dt", "left")
        .join(dates_plans.daily_orders(spark, sf_dir), "dt", "left")
        .groupBy("era", "year_num")
        .agg(
            F.count("*").alias("n_days"),
            F.count("description").alias("n_labels"),
            F.count("starts").alias("n_month_starts"),
            F.max("cum_day_of_year").cast("bigint").alias("month_start_days"),
            F.sum(F.coalesce("n_orders", F.lit(0))).alias("n_orders"),
        )
    )


def news_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All feeds stored in one table of the current schema, found there by its short name."""
    schema, before = own_schema(spark), spark.catalog.currentDatabase()
    sinks.use_schema(spark, schema)
    try:
        jobs.store_news(
            feeds_plans.feeds(spark, sf_dir), feeds_plans.country_by_page_language, "all_news"
        )
    finally:
        sinks.use_schema(spark, before)
    return as_text(spark.table(f"{schema}.all_news"), *feeds_plans.UNION_TEXT)


def api_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages landed as files, a page on each line, and the stored articles out of them."""
    landed, schema = scratch_path(spark, "landed"), own_schema(spark)
    stores_plans.api_pages(spark, sf_dir).write.text(landed)
    jobs.store_api_articles(spark, landed, f"{schema}.api_news", lines=True)
    return stores_plans.articles_shown(spark.table(f"{schema}.api_news"))


def view_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view kept in the catalog over three stored tables, with the orders of its customers."""
    schema = own_schema(spark)
    for name in ("customer", "nation", "region"):
        sinks.replace_table(table(spark, sf_dir, name), f"{schema}.{name}")
    sinks.store_view(
        spark,
        f"{schema}.places",
        f"""SELECT c_custkey, n_name, r_name FROM {schema}.customer
        JOIN {schema}.nation ON c_nationkey = n_nationkey
        JOIN {schema}.region ON n_regionkey = r_regionkey""",
    )
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return (
        spark.table(f"{schema}.places")
        .join(orders, "c_custkey")
        .groupBy("r_name", "n_name")
        .agg(F.count("*").alias("n_orders"))
    )


QUERIES = {
    "job_calendar": calendar_job,
    "job_news": news_job,
    "job_api_articles": api_job,
    "job_stored_view": view_job,
}

ORACLES = {
    "job_calendar": f"""SELECT era, year_num, count(*) AS n_days, count(description) AS n_labels,
          count(*) FILTER (WHERE day_num = 1) AS n_month_starts,
          CAST(sum(CASE WHEN day_num = 1 THEN dayofyear(a.dt) END) AS BIGINT) AS month_start_days,
          CAST(sum(coalesce(n_orders, 0)) AS BIGINT) AS n_orders
        FROM ({dates_plans._attributes(dates_plans._FULL)}) AS a
        LEFT JOIN {dates_plans._LABELS} AS l ON a.dt = l.dt
        LEFT JOIN {dates_plans._DAILY} AS o ON a.dt = o.dt
        GROUP BY era, year_num""",
    "job_news": feeds_plans.ORACLES["feeds_union"],
    "job_api_articles": stores_plans.ORACLES["results_array_explode"],
    "job_stored_view": """SELECT r_name, n_name, count(*) AS n_orders FROM orders
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, n_name""",
}
