"""Queries that run streams to their end and return what they wrote.

Each run takes a new folder for its tables and checkpoints, so it starts from nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from solstrand.plans import articles
from solstrand.plans.messages import article_messages, article_scorer, survey_scorer
from solstrand.plans.shown import as_text, as_text_sql
from solstrand.sinks.scratch import scratch_path
from solstrand.sources.messages import stored_table_stream
from solstrand.sources.tables import table
from solstrand.streaming.dedup import first_seen
from solstrand.streaming.hops import ArticleStream, append

#: Stored bytes of one batch of a hop: it shuffles about twice as much, whatever the tables' size.
BATCH_BYTES = 1 << 28


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream; watermarks need a TIMESTAMP with zone."""
    return stored_table_stream(spark, sf_dir, "events").withColumn(
        "ts", F.col("ts").cast("timestamp")
    )


def _kept(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    """The stream run to its end into a new folder, read back."""
    root = scratch_path(spark, label)
    append(stream, f"{root}/rows", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/rows")


def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users seen in the events: one row each, whichever event came first."""
    stream = first_seen(events(spark, sf_dir), key="user_id", event_time="ts", spread=["event_id"])
    return _kept(spark, stream.select("user_id"), "stream-dedup")


def dedup_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with users forgotten a month after their first event; all events lie within one."""
    stream = first_seen(
        events(spark, sf_dir),
        key="user_id",
        event_time="ts",
        delay="31 days",
        bounded=True,
        spread=["event_id"],
    )
    return _kept(spark, stream.select("user_id"), "stream-dedup-bounded")


def _article_stream(spark: SparkSession, sf_dir: str, upto: str) -> DataFrame:
    messages = article_messages(
        stored_table_stream(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )
    # Copies are a day apart and messages come in no order of time: the delay spans them all.
    hops = ArticleStream(
        scratch_path(spark, "articles"),
        article_scorer(),
        survey_scorer,
        bytes_per_trigger=BATCH_BYTES,
        delay="3650 days",
    )
    hops.run(messages, upto)
    return hops.read(spark, upto)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze table of the stream, counted by day and outcome."""
    rows = _article_stream(spark, sf_dir, "bronze")
    return rows.groupBy(
        F.col("eh_enqueued_date").cast("string").alias("enqueued_on"),
        F.col("topic"),
        F.col("parsed_records").isNotNull().alias("parsed"),
        F.col("parsed_records.id").isNotNull().alias("identified"),
    ).agg(F.count("*").alias("n"), F.count_distinct("etl_rec_uuid").alias("n_uuids"))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table of the stream: which of two equal copies stays is left open."""
    rows = _article_stream(spark, sf_dir, "silver")
    shown = rows.select("id", "title", "language", "ai_language", "ai_city", "ai_cell_res_15")
    return as_text(shown, "ai_cell_res_15")


def options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four hops, down to the survey options."""
    return _article_stream(spark, sf_dir, "options").drop("created_at")


QUERIES = {
    "stream_dedup": dedup,
    "stream_dedup_bounded": dedup_bounded,
    "stream_bronze": bronze,
    "stream_silver": silver,
    "stream_survey_options": options,
}

ORACLES = {
    "stream_dedup": "SELECT DISTINCT user_id FROM events",
    "stream_dedup_bounded": "SELECT DISTINCT user_id FROM events",
    "stream_bronze": f"""SELECT strftime(sent, '%Y-%m-%d') AS enqueued_on, topic,
        kind <> 'empty' AS parsed, kind = 'article' AS identified, count(*) AS n,
        count(*) AS n_uuids FROM {articles.SENT} AS s GROUP BY 1, 2, 3, 4""",
    "stream_silver": as_text_sql(
        f"""SELECT doc_id AS id, title, lang AS language, ai_language, ai_city,
        {articles.AI_CELL} AS ai_cell_res_15 FROM {articles.ANALYSED} AS a""",
        "ai_cell_res_15",
    ),
    "stream_survey_options": articles.ORACLES["survey_options"],
}
