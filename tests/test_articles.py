from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F

from solstrand.operators import articles as ops
from solstrand.operators.quality import expect, expectation_counts

T0 = datetime.datetime(2024, 5, 1, 12, 0)
TOPIC = {"id": "t1", "name": "Economy", "score": 0.5, "taxonomy": "iptc", "links": {"self": "/t1"}}


def message(offset: int, value: str | None, topic: str | None = "news", minutes: int | None = None):
    at = T0 + datetime.timedelta(minutes=offset if minutes is None else minutes)
    raw = None if value is None else bytearray(value.encode())
    return (None, raw, topic, 0, offset, at, 0)


@pytest.fixture
def make(spark):
    schema = (
        "key binary, value binary, topic string, partition int, offset bigint, "
        "timestamp timestamp, timestampType int"
    )
    return lambda rows: spark.createDataFrame(rows, schema)


def test_malformed_values(make):
    rows = make(
        [
            message(0, json.dumps({"id": 1, "title": "t"})),
            message(1, "bad"),
            message(2, ""),
            message(3, None),
            message(4, json.dumps({"id": 2}), topic=None),
        ]
    )
    bronze = ops.parse_messages(rows)
    got = {r["offset"]: r["parsed_records"] for r in bronze.collect()}
    assert got[0]["id"] == 1 and got[1] is not None and got[1]["id"] is None
    assert got[2] is None and got[3] is None
    counts = {
        r["rule"]: r["failed"]
        for r in expectation_counts(bronze, [*ops.bronze_rules(), ops.identified()]).collect()
    }
    # Text that is no JSON passes the rule on the struct; only the rule on the id sees it.
    assert counts == {"valid_topic": 1, "valid records": 2, "identified article": 3}
    assert expect(bronze, [ops.identified()]).count() == 2


def test_bronze_columns(make):
    row = ops.parse_messages(make([message(0, "{}")])).first().asDict()
    assert set(row) == {*ops.MESSAGE_COLUMNS, "parsed_records", *ops.AUDIT_COLUMNS}
    assert row["eh_enqueued_timestamp"] == row["timestamp"] == T0
    assert row["eh_enqueued_date"] == T0.date() and len(row["etl_rec_uuid"]) == 36


@pytest.mark.parametrize("form", ["objects", "names"])
def test_both_forms_of_topics(make, form):
    sent = [TOPIC] if form == "objects" else ["Economy"]
    rows = make([message(0, json.dumps({"id": 1, "topics": sent, "language": "it"}))])
    old = ops.parse_messages(rows, "objects").first()["parsed_records"]
    assert old["language"] == "it"
    assert (old["topics"][0]["name"] == "Economy") if form == "objects" else old["topics"] is None
    new = ops.parse_messages(rows, "names").select(
        ops.topic_names(F.col("parsed_records.topics")).alias("t")
    )
    assert new.first()["t"] == ["Economy"]


def test_nested_article(make):
    article = {
        "id": 9,
        "author": {"id": 4, "name": "Ann"},
        "entities": [{"id": 1, "title": {"pos": [{"start": 2, "end": 5}]}}],
        "source": {"location": {"country_code": "IT"}},
        "loaddata_timestamp": "2024-05-01T10:00:00Z",
    }
    flat = ops.flatten_articles(ops.parse_messages(make([message(0, json.dumps(article))])))
    row = flat.first()
    assert (row["author_id"], row["name"]) == (4, "Ann")
    assert row["entities"][0]["title"]["pos"][0]["end"] == 5
    assert row["source"]["location"]["country_code"] == "IT"
    assert row["loaddata_timestamp"] == datetime.datetime(2024, 5, 1, 10)
    assert len(flat.columns) == 5 + 32 + 1 + 4


def test_first_per_id(make):
    values = [(0, 7, 50), (1, 7, 20), (2, 8, 30), (3, None, 1), (4, None, 2), (5, 7, 20)]
    rows = make([message(o, json.dumps({"id": i, "title": str(o)}), minutes=m) for o, i, m in values])
    kept = ops.first_per_id(ops.flatten_articles(ops.parse_messages(rows))).collect()
    # The earliest message of each id, the lower offset among equals; rows without id are one id.
    assert {r["id"]: r["offset"] for r in kept} == {7: 1, 8: 2, None: 3} and len(kept) == 3


def test_copies_are_cut_before_the_exchange(spark):
    df = spark.range(0, 3000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"),
        F.current_timestamp().alias("timestamp"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
    )
    kept = ops.first_per_id(df)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("Partial")
    assert kept.count() == 2001
