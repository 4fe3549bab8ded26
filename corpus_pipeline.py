"""The corpus pipeline: quality rules, near duplicates, personal data, mixing, packing.

Each stage takes what the one before kept, stored as Parquet, and its decisions take effect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from solstrand.llm.common import table
from solstrand.llm.jaccard import one_of_each
from solstrand.llm.mixing import mixed_copies
from solstrand.llm.packing import packed
from solstrand.llm.pii import redacted
from solstrand.llm.quality import kept_documents
from solstrand.sinks.scratch import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are far from every language's habits go."""
    return kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by similar shingle sets, one stays."""
    return one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind."""
    return redacted(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, a row for each epoch that reads them."""
    return mixed_copies(docs)


def length_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mix with their buckets, batches and slots."""
    return packed(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("personal data", personal_data),
    ("source mix", source_mix),
    ("length packing", length_packing),
]

#: Shingle hashes and boosted trees have no SQL form; tests look at single stages and odd rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = written(docs, f"stage{n}")
    return docs
