"""Surveys from analysed articles, and their options as a child table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solstrand.operators.enrich import Scorer, answered
from solstrand.operators.quality import Rule
from solstrand.sources.schemas import (
    CLOSURE_TYPES,
    LONGEST_TEXT,
    OPTIONS_MAX,
    OPTIONS_MIN,
    QUESTION_TYPES,
    RATING_ICONS,
    RESOURCE_TYPES,
    SURVEY_ANSWER,
    SURVEY_REQUIRED,
)

# Field of the model's input -> column of the analysed article.
NEWS_INPUT = {
    "language": "ai_language",
    "summary": "ai_summary",
    "country": "ai_country",
    "city": "ai_city",
    "ai_state": "ai_state",
    "latitude": "ai_latitude",
    "longitude": "ai_longitude",
    "wikidataID": "ai_wikidataID",
}
# Columns of the survey table in order.
SURVEY_COLUMNS = [
    "id", "title", "description", "question_type", "min_value", "max_value", "scale_min_label",
    "scale_max_label", "created_at", "closure_type", "expires_at", "is_active",
    "show_results_on_close", "allow_multiple_responses", "allow_custom_options", "require_comment",
    "rating_icon", "is_anonymous", "resource_type", "resource_url", "resource_news_id", "user_id",
    "options", "metadata", "reasoning", "generated_at", "survey_generation_json",
    "news_input_json",
]


def news_input(articles: DataFrame) -> Column:
    """The analysis of an article as JSON text, the scorer's input."""
    return F.to_json(F.struct(*[F.col(c).alias(f) for f, c in NEWS_INPUT.items()]))


def survey_rows(articles: DataFrame, scorer: Scorer) -> DataFrame:
    """One survey per article: the model's answer, with constants in place of some of its fields."""
    asked = articles.select("id", "href", news_input(articles).alias("news_input_json"))
    rows = answered(asked, F.col("news_input_json"), scorer, SURVEY_ANSWER, "survey_generation")
    survey = "survey_generation.survey"
    # These replace what the model answers.
    overrides = {
        "allow_multiple_responses": F.lit(False),
        "require_comment": F.lit(False),
        "user_id": F.lit(1),
        "resource_url": F.col("href"),
        "resource_news_id": F.col("id"),
    }
    made = {
        "id": F.col("id"),
        "created_at": F.current_timestamp(),
        "generated_at": F.current_timestamp(),
        "options": F.col("survey_generation.options"),
        "metadata": F.col("survey_generation.metadata"),
        "reasoning": F.col("survey_generation.reasoning"),
        "survey_generation_json": F.col("survey_generation"),
        "news_input_json": F.col("news_input_json"),
        **overrides,
    }
    return rows.select(
        *[made.get(c, F.col(f"{survey}.{c}")).alias(c) for c in SURVEY_COLUMNS]
    )


def joined_key(*parts: Column) -> Column:
    """BIGINT from the digits of the parts in a row.

    Ambiguous: 12 and 31 give the same as 123 and 1.  The job fails where the digits do not fit;
    a missing part gives NULL.
    """
    digits = F.concat(*[p.cast("string") for p in parts])
    key = digits.try_cast("bigint")
    wrong = F.raise_error(F.concat(F.lit("no BIGINT key from "), digits))
    return F.when(digits.isNotNull() & key.isNull(), wrong).otherwise(key)


def survey_options(surveys: DataFrame, hashed_keys: bool = False) -> DataFrame:
    """One row per option; surveys without options give none.

    The key is made of the digits of survey id and option order; `hashed_keys` takes a 64-bit hash
    of both, which never runs over.
    """
    option = surveys.select(
        F.col("id").alias("survey_id"), "created_at", F.explode("options").alias("option")
    )
    order = F.col("option.option_order")
    key = F.xxhash64("survey_id", order) if hashed_keys else joined_key(F.col("survey_id"), order)
    return option.select(
        key.alias("id"),
        "survey_id",
        F.col("option.option_text").alias("option_text"),
        order.alias("option_order"),
        "created_at",
        F.lit(1).alias("user_id"),
    )


def survey_rules() -> list[Rule]:
    """The contract of a survey answer, on the rows of `survey_rows`."""
    answer = F.col("survey_generation_json.survey")
    n_options = F.size("options")
    present = F.lit(True)
    for field in SURVEY_REQUIRED:
        present &= answer.getField(field).isNotNull()
    return [
        Rule("required fields are present", present),
        Rule("title is short", F.length("title") <= LONGEST_TEXT),
        Rule("question type is known", F.col("question_type").isin(QUESTION_TYPES)),
        Rule("closure type is known", F.col("closure_type").isin(CLOSURE_TYPES)),
        Rule(
            "rating icon is known or missing",
            F.col("rating_icon").isNull() | F.col("rating_icon").isin(RATING_ICONS),
        ),
        Rule("resource type is known", F.col("resource_type").isin(RESOURCE_TYPES)),
        Rule("number of options is right", n_options.between(OPTIONS_MIN, OPTIONS_MAX)),
        Rule(
            "options are complete",
            F.forall(
                "options",
                lambda o: o["option_text"].isNotNull() & o["option_order"].isNotNull(),
            ),
        ),
        Rule(
            "options are short",
            F.forall("options", lambda o: F.length(o["option_text"]) <= LONGEST_TEXT),
        ),
    ]
