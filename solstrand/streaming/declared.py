"""The hops of the article stream as datasets of a declarative pipeline (`pyspark.pipelines`).

Call `declare` from a definition file of a pipeline project; the pipeline runner then finds the
order of the datasets, their checkpoints and their tables by itself.  Outside of a pipeline use
`hops.ArticleStream`, which runs the same functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import pipelines as dp
from pyspark.sql import DataFrame, SparkSession

from solstrand.operators.enrich import Scorer
from solstrand.operators.surveys import survey_options, survey_rows
from solstrand.streaming.hops import bronze, silver


def declare(
    session: Callable[[], SparkSession],
    messages: Callable[[], DataFrame],
    article_scorer: Scorer,
    survey_scorer: Scorer,
    prefix: str = "",
    **dedup,
) -> None:
    """Declare `bronze_news`, `clean_news`, `survey_news` and `survey_options_news`.

    `messages` returns the stream of a Kafka source.  A dataset reads the one before by its plain
    name.  The raw history is marked as not to be reset, the clean one is laid out by id.
    """

    def read(name: str) -> DataFrame:
        return session().readStream.table(prefix + name)

    @dp.table(
        name=prefix + "bronze_news",
        comment="Article messages as received",
        table_properties={"quality": "bronze"},
        partition_cols=["eh_enqueued_date"],
        format="parquet",
    )
    def bronze_news() -> DataFrame:
        return bronze(messages())

    @dp.table(
        name=prefix + "clean_news",
        comment="Articles, the first per id, with the model's analysis",
        table_properties={"quality": "silver"},
        cluster_by=["id"],
    )
    def clean_news() -> DataFrame:
        return silver(read("bronze_news"), article_scorer, **dedup)

    @dp.table(name=prefix + "survey_news", comment="One survey per article")
    def survey_news() -> DataFrame:
        return survey_rows(read("clean_news"), survey_scorer)

    @dp.table(name=prefix + "survey_options_news", comment="The options of the surveys")
    def survey_options_news() -> DataFrame:
        return survey_options(read("survey_news"))
