"""The registered queries of this package, and their SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from solstrand.llm.alignment import alignment_digest
from solstrand.llm.common import table
from solstrand.llm.fingerprints import fingerprint_digest
from solstrand.llm.jaccard import document_components
from solstrand.llm.mixing import mix_digest
from solstrand.llm.packing import packing_digest
from solstrand.llm.pii import personal_data_digest
from solstrand.llm.quality import quality_digest
from solstrand.llm.sharding import document_shards
from solstrand.llm.simhash import simhash_components
from solstrand.llm.suffixes import document_repeats
from solstrand.llm.tokens import document_ids
from solstrand.llm.urls import judged_pages, label_outcomes
from solstrand.llm.whitening import whitening_digest

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def _documents(work: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return work(table(spark, sf_dir, "documents"))

    return query


def _urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = judged_pages(pages, label_outcomes(table(spark, sf_dir, "labels")))
    return judged.drop("url")


def _token_ids(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return document_ids(docs, public_tokenizers.path(TOKENIZER))


def _alignment(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return alignment_digest(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES))


def _whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening_digest(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_personal_data": _documents(personal_data_digest),
        "op2_feistel_shards": _documents(document_shards),
        "op3_hierarchical_mix": _documents(mix_digest),
        "op4_length_buckets": _documents(packing_digest),
        "op5_repeated_passages": _documents(document_repeats),
        "op6_jaccard_components": _documents(document_components),
        "op7_host_reputation": _urls,
        "op8_token_ids": _documents(_token_ids),
        "op9_quality_rules": _documents(quality_digest),
        "op10_scaled_sketches": _documents(fingerprint_digest),
        "op11_shifted_cholesky_whitening": _whitening,
        "op12_token_alignment": _documents(_alignment),
        "op13_simhash_components": _documents(simhash_components),
    }


def oracle_sql() -> dict[str, str]:
    return {}
