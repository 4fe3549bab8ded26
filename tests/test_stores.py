from __future__ import annotations

import json

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from solstrand.operators.frames import drop_void_columns
from solstrand.sinks import scratch, tables
from solstrand.sources import api_pages, listings, messages
from solstrand.sources.schemas import LISTING_DETAIL_FIELDS, LISTING_SUMMARY_FIELDS
from solstrand.sources.tables import job_parameter, preview, relational_options


def test_replace_table_replaces_rows_and_schema(spark):
    tables.replace_table(spark.range(3), "replaced")
    tables.replace_table(spark.range(2).select(F.col("id").cast("string").alias("name")), "replaced")
    assert preview(spark, "replaced").columns == ["name"]
    assert preview(spark, "replaced", "count(*) AS n").first()["n"] == 2
    spark.sql("DROP TABLE replaced")


def test_insert_by_position_casts_and_refuses_what_does_not_fit(spark):
    spark.sql("CREATE TABLE positional (n INT, s STRING) USING parquet")
    tables.insert_by_position(spark.range(1).select(F.col("id").alias("x"), F.lit("a").alias("y")), "positional")
    assert tuple(spark.table("positional").first()) == (0, "a")
    big = spark.range(1).select(F.lit(1 << 40).alias("x"), F.lit("b").alias("y"))
    with pytest.raises(PySparkException, match="(?i)overflow"):
        tables.insert_by_position(big, "positional")
    spark.sql("DROP TABLE positional")


def test_views(spark):
    tables.replace_view(spark.range(4), "some_view")
    assert preview(spark, "some_view").count() == 4


def test_clustered_files(spark, tmp_path):
    """Files do not overlap in the key, and a key with a third of the rows fills several."""
    path = str(tmp_path / "c")
    df = spark.range(0, 6000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 50).otherwise(F.col("id") % 100).alias("k"), "id"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_clustered(df, path, "k")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spans = (
        spark.read.parquet(path)
        .groupBy(F.input_file_name().alias("f"))
        .agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("*").alias("n"))
        .orderBy("lo", "hi")
        .collect()
    )
    assert sum(s["n"] for s in spans) == 6000
    assert all(a["hi"] <= b["lo"] for a, b in zip(spans, spans[1:]))
    assert sum(s["lo"] <= 50 <= s["hi"] for s in spans) > 1


def test_partitioned_files(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(100).select("id", (F.col("id") % 4).alias("day"))
    tables.write_partitioned(df, path, "day")
    assert spark.read.parquet(path).filter("day = 2").count() == 25
    assert sorted(p.name for p in (tmp_path / "p").glob("day=*")) == [f"day={i}" for i in range(4)]


def test_a_hot_day_is_cut_into_several_files(spark, tmp_path):
    path = str(tmp_path / "hot")
    df = spark.range(0, 60_000, 1, 8).select(
        F.md5(F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5).alias("day"),
    )
    key, before = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m"
    spark.conf.set(key, "256k")
    try:
        tables.write_partitioned(df, path, "day")
    finally:
        spark.conf.set(key, before)
    assert spark.read.parquet(path).count() == 60_000
    files = {d: len(list((tmp_path / "hot" / f"day={d}").glob("*.parquet"))) for d in range(5)}
    assert files[0] > 1


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch.scratch_root(spark).startswith(shared or "/")
    given = FakeSession(spark_checkpoint_dir="s3://b/c/", spark_master="yarn", spark_app_id="a1")
    assert scratch.scratch_root(given) == "s3://b/c/solstrand/a1"


class FakeConf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class FakeSession:
    def __init__(self, **conf):
        self.conf = FakeConf({k.replace("_", "."): v for k, v in conf.items()})


def test_scratch_needs_a_shared_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        scratch.scratch_root(FakeSession(spark_master="yarn"))
    assert "solstrand-" in scratch.scratch_root(FakeSession(spark_master="local[2]"))


def test_job_parameters_and_kafka_options(spark):
    given = {
        "ingestion.kafka.servers": "broker:9093",
        "ingestion.kafka.topic": "news",
        "ingestion.kafka.requestTimeout": "60000",
        "ingestion.kafka.sessionTimeout": "30000",
        "ingestion.spark.maxOffsetsPerTrigger": "500",
        "ingestion.spark.failOnDataLoss": "false",
        "ingestion.spark.startingOffsets": "earliest",
    }
    for key, value in given.items():
        spark.conf.set(key, value)
    options = messages.kafka_options(spark, jaas_config="login")
    assert options["subscribe"] == "news" and options["maxOffsetsPerTrigger"] == "500"
    assert options["kafka.security.protocol"] == "SASL_SSL" and len(options) == 10
    assert len(messages.kafka_options(spark)) == 7
    assert job_parameter(spark, "ingestion.none", "x") == "x"
    with pytest.raises(KeyError):
        job_parameter(spark, "ingestion.none")


def test_relational_options():
    split = relational_options("jdbc:x", "public.cities", "id", (1, 150_000), 8)
    assert (split["numPartitions"], split["lowerBound"], split["upperBound"]) == ("8", "1", "150000")
    assert "partitionColumn" not in relational_options("jdbc:x", "public.regions")
    with pytest.raises(ValueError):
        relational_options("jdbc:x", "t", "id")


def test_api_pages_from_files(spark, tmp_path):
    full = {
        "id": 1, "title": "a", "author": {"id": 5, "name": "Ann"},
        "source": {"id": 2, "name": "s", "location": {"country": "it"}}, "keywords": ["k"],
        "sentiment": {"overall": {"score": 0.5, "polarity": "positive"}},
    }
    (tmp_path / "1.json").write_text(json.dumps({"results": [full, {"id": 2}]}, indent=2))
    (tmp_path / "2.json").write_text(json.dumps({"results": []}))
    (tmp_path / "3.json").write_text(json.dumps({"status": "error"}))
    df = api_pages.articles_of(api_pages.read_pages(spark, str(tmp_path)))
    assert len(df.columns) == 35
    rows = {r["id"]: r for r in df.collect()}
    assert set(rows) == {1, 2}
    assert rows[1]["author_name"] == "Ann" and rows[1]["author_href"] is None
    assert json.loads(rows[1]["source_location"]) == {"country": "it"}
    assert rows[1]["sentiment"]["overall"]["score"] == 0.5
    assert rows[2]["author_id"] is None and rows[2]["source_name"] is None


def test_void_columns(spark):
    frame = listings.from_pandas(spark, pd.DataFrame({"a": [1, 2], "b": [None, None]}))
    kept = drop_void_columns(frame.withColumn("c", F.lit(None)))
    assert "c" not in kept.columns and "a" in kept.columns


LISTINGS = [
    {"id": "2", "summary": {"name": "BBC and CNN news", "share": {"name": "s2"}}, "detail": None},
    {"id": "1", "summary": {"name": "All BBC news", "share": {"name": "s1"}}, "detail": {"size": 3.5}},
    {"id": "3", "summary": {"name": "Weather"}, "detail": {"tags": [{"tag_name": "x"}]}},
    {"id": "4", "summary": None, "extra": 1},
]


def test_listings(spark):
    assert len(LISTING_DETAIL_FIELDS) == len(LISTING_SUMMARY_FIELDS) == 19
    df = listings.typed_listings(spark, LISTINGS)
    assert df.columns == ["id", "detail", "summary"]
    assert sorted(r["id"] for r in listings.named_like(df, "BBC").collect()) == ["1", "2"]
    assert [tuple(r) for r in listings.share_of(df, "BBC").collect()] == [("1", "s1")]
    assert listings.share_of(df, "nothing like it").collect() == []


def test_inferred_listings(spark):
    df = listings.inferred_listings(spark, LISTINGS[:3])
    row = df.filter("id = '1'").first()
    assert json.loads(row["detail"]) == {"size": 3.5}
