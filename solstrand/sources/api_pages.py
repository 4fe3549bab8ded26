"""Pages of the news interface, landed as JSON files: `{"results": [article, ...]}`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from solstrand.sources.schemas import API_ARTICLE_FIELDS, API_PAGE


def read_pages(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row per page.

    A file is one page that may span lines, read whole by one task.  With `lines`, each line is a
    page, and large files are split between tasks.
    """
    return spark.read.schema(API_PAGE).option("multiLine", not lines).json(path)


def parse_pages(df: DataFrame, text: Column | str) -> DataFrame:
    """The same from a column of page text."""
    return df.select(F.from_json(text, API_PAGE).alias("page")).select("page.*")


def articles_of(pages: DataFrame) -> DataFrame:
    """One row per article with 35 flat columns; a missing author or source gives NULLs."""
    columns: list[Column] = []
    for name in API_ARTICLE_FIELDS:
        if name == "author":
            columns += _flat(name, ["id", "name", "href"])
        elif name == "source":
            columns += _flat(name, ["id", "name", "href", "rank", "categories", "location"])
        else:
            columns.append(F.col(f"article.{name}"))
    return pages.select(F.explode("results").alias("article")).select(*columns)


def _flat(parent: str, children: list[str]) -> list[Column]:
    return [F.col(f"article.{parent}.{c}").alias(f"{parent}_{c}") for c in children]
