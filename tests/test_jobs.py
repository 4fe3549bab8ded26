from __future__ import annotations

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from solstrand import jobs
from solstrand.operators.enrich import python_scorer
from solstrand.operators.feeds import FEED_COLUMNS, FEED_READS, ID_OFFSETS
from solstrand.sinks.tables import annotate_table, store_declared, use_schema
from solstrand.sources.api_pages import read_pages
from solstrand.streaming.hops import append_to_table


def test_calendar_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS time_job")
    jobs.store_calendar(spark, "time_job", "2024-12-01", first="-0002-01-01", last="2024-12-31")
    assert spark.table("time_job.special_dates").count() == 6
    dates = spark.table("time_job.dates")
    assert dates.filter("era = 'BCE'").count() == 3 * 365 + 1
    assert dates.filter("description IS NOT NULL").count() == 4
    kpi = spark.table("time_job.dates_kpi")
    assert kpi.count() == 2027 * 12
    assert kpi.filter("dt = DATE'2024-12-01'").first()["cum_day_of_year"] == 2020
    plan = dates.filter("day_num = 1")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(day_num,1)" in plan
    use_schema(spark, "time_job")
    annotate_table(spark, "dates", "All dates", {"quality": "gold"})
    assert spark.sql("SHOW TBLPROPERTIES dates").filter("key = 'quality'").first()["value"] == "gold"
    use_schema(spark, "default")
    # A second run replaces the tables.
    jobs.store_calendar(spark, "time_job", "2024-12-01", first="2024-01-01", last="2024-12-31")
    assert spark.table("time_job.dates_kpi").count() == 12
    spark.sql("DROP DATABASE time_job CASCADE")


def test_a_failing_job_leaves_the_old_table(spark):
    store_declared(spark.range(3), "kept", "n INT")
    with pytest.raises(Exception, match="OVERFLOW|out of range"):
        store_declared(spark.range(1).selectExpr("id + 5000000000L"), "kept", "n INT")
    assert spark.table("kept").count() == 3
    store_declared(spark.sql("SELECT 7, 'x'"), "kept", "n INT, word STRING")
    assert spark.table("kept").collect() == [(7, "x")]
    spark.sql("DROP TABLE kept")


def test_pages_on_lines_give_the_same_articles(spark, tmp_path):
    pages = [json.dumps({"results": [{"id": i, "title": f"a\nb {i}"}]}) for i in range(3)]
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "p.json").write_text("\n".join(pages))
    (tmp_path / "files").mkdir()
    for i, page in enumerate(pages):
        (tmp_path / "files" / f"{i}.json").write_text(page)
    by_line = read_pages(spark, str(tmp_path / "lines"), lines=True)
    by_file = read_pages(spark, str(tmp_path / "files"))
    assert sorted(map(str, by_line.collect())) == sorted(map(str, by_file.collect()))


def feeds(spark, n: int):
    def rows(name):
        return spark.range(n).select(
            *[
                (F.col("id") if c == "id" else F.concat(F.lit(f"{name} {c} "), "id")).alias(c)
                for c in FEED_READS[name]
            ]
        )

    return {name: rows(name) for name in FEED_READS}


def test_news_table_with_fixed_offsets(spark):
    jobs.store_news(feeds(spark, 3), F.upper, "all_news", ID_OFFSETS)
    rows = spark.table("all_news").orderBy("id").collect()
    assert [r["id"] for r in rows] == [b + i for b in (0, 1500, 3000, 4500) for i in (1, 2, 3)]
    assert spark.table("all_news").columns == FEED_COLUMNS
    google = [r for r in rows if r["source"] == "google"]
    assert google[0]["local_id"] is None and google[0]["content"] is None
    assert google[0]["author"].startswith("google publisher")
    assert google[0]["try_parse_country"] == google[0]["country"] == "google country 0"
    bbc = rows[0]
    assert (bbc["local_id"], bbc["country"], bbc["try_parse_country"]) == (0, None, "BBC CONTENT 0")
    assert bbc["updated_last"] is None and bbc["description"] is None
    spark.sql("DROP TABLE all_news")


def test_a_model_is_asked_once_per_story(spark):
    asked = spark.sparkContext.accumulator(0)

    def answer(prompts: pd.Series) -> pd.Series:
        asked.add(len(prompts))
        return prompts.str.len().astype(str)

    jobs.store_news(feeds(spark, 20), python_scorer(answer), "asked_news")
    assert asked.value == 60  # the google feed has no content to ask about
    assert spark.table("asked_news").filter("try_parse_country IS NULL").count() == 0
    spark.sql("DROP TABLE asked_news")


def test_ids_are_unique_and_outgrown_offsets_refused(spark):
    from solstrand.operators.feeds import feeds_union

    many = feeds(spark, 1600)
    with pytest.raises(Exception, match="outgrow"):
        feeds_union(many, F.upper, ID_OFFSETS).agg(F.max("id")).collect()
    with pytest.raises(ValueError):
        feeds_union(many, F.upper, {"bbc": 0})
    running = feeds_union(many, F.upper)
    assert running.agg(F.count_distinct("id"), F.max("id")).first()[:] == (6400, 6400)


def test_api_table(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"results": [{"id": 1}, {"id": 2}]}))
    jobs.store_api_articles(spark, str(tmp_path), "api_news")
    jobs.store_api_articles(spark, str(tmp_path), "api_news")
    assert spark.table("api_news").count() == 2
    spark.sql("DROP TABLE api_news")


def test_a_stream_into_a_table(spark, tmp_path):
    spark.range(7).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    for _ in range(2):
        append_to_table(stream, "streamed", str(tmp_path / "c")).awaitTermination()
    assert spark.table("streamed").count() == 7
    spark.sql("DROP TABLE streamed")
