from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from solstrand.operators import surveys
from solstrand.operators.quality import expectation_counts


def answer(title="Q?", options=("a", "b", "c"), **survey):
    base = {
        "title": title, "description": "d", "question_type": "rating", "closure_type": "manual",
        "is_active": True, "show_results_on_close": True, "allow_multiple_responses": True,
        "allow_custom_options": True, "require_comment": True, "rating_icon": None,
        "is_anonymous": False, "resource_type": "news", "resource_url": "made-up",
    }
    return json.dumps(
        {
            "survey": {**base, **survey},
            "options": [
                {"option_text": t, "option_order": i + 1} for i, t in enumerate(options)
            ],
            "metadata": {"geographic_context": {"city": "Rome"}, "language": "it"},
            "reasoning": {"options_rationale": "r"},
        }
    )


@pytest.fixture
def build(spark):
    """Surveys of articles whose summary already is the model's answer."""

    def make(answers: list[str | None], first_id: int = 1):
        rows = [(first_id + i, f"h{i}", a) for i, a in enumerate(answers)]
        df = spark.createDataFrame(rows, "id long, href string, ai_summary string").withColumns(
            {
                c: F.lit(None).cast("double" if c in ("ai_latitude", "ai_longitude") else "string")
                for c in surveys.NEWS_INPUT.values()
                if c != "ai_summary"
            }
        )
        return surveys.survey_rows(df, lambda news: F.get_json_object(news, "$.summary"))

    return make


def test_columns_and_overrides(build):
    df = build([answer()])
    assert df.columns == surveys.SURVEY_COLUMNS and len(df.columns) == 28
    row = df.first()
    assert (row["allow_multiple_responses"], row["require_comment"], row["user_id"]) == (False, False, 1)
    assert (row["resource_url"], row["resource_news_id"]) == ("h0", 1)
    assert row["survey_generation_json"]["survey"]["resource_url"] == "made-up"
    assert row["metadata"]["geographic_context"]["city"] == "Rome"
    assert json.loads(row["news_input_json"])["summary"]


def test_options(build):
    df = build([answer(), answer(options=()), None, answer(options=("x",))], first_id=12)
    rows = surveys.survey_options(df).orderBy("id").collect()
    assert [(r["id"], r["survey_id"], r["option_text"]) for r in rows] == [
        (121, 12, "a"), (122, 12, "b"), (123, 12, "c"), (151, 15, "x"),
    ]
    assert {r["user_id"] for r in rows} == {1} and rows[0]["created_at"] is not None


def test_keys(spark):
    df = spark.createDataFrame(
        [(12, 31), (123, 1), (None, 1), (9223372036854775807, 1)], "a long, b int"
    )
    key = surveys.joined_key(F.col("a"), F.col("b"))
    fitting = df.filter("a IS NULL OR a < 1000")
    assert [r[0] for r in fitting.select(key).collect()] == [1231, 1231, None]
    with pytest.raises(Exception, match="no BIGINT key"):
        df.select(key).collect()
    hashed = {r[0] for r in df.select(F.xxhash64("a", "b")).collect()}
    assert len(hashed) == 4


def test_hashed_keys_differ(build):
    df = build([answer()] * 30)
    ids = [r["id"] for r in surveys.survey_options(df, hashed_keys=True).collect()]
    assert len(set(ids)) == len(ids) == 90


def test_contract(build):
    df = build(
        [
            answer(),
            answer(title="x" * 61),
            answer(options=("a", "b")),
            answer(options=("a", "b", "c", "d", "e", "f")),
            answer(options=("a", "b", "y" * 61)),
            answer(question_type="quiz"),
            answer(closure_type="never", rating_icon="moon"),
            answer(resource_type="blog", is_anonymous=None),
            answer(rating_icon="star"),
            None,
        ]
    )
    failed = {r["rule"]: r["failed"] for r in expectation_counts(df, surveys.survey_rules()).collect()}
    assert failed == {
        "required fields are present": 2,
        "title is short": 2,
        "question type is known": 2,
        "closure type is known": 2,
        "rating icon is known or missing": 1,
        "resource type is known": 2,
        "number of options is right": 3,
        "options are complete": 1,
        "options are short": 2,
    }
