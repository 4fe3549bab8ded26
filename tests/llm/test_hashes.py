"""Words and chunks that sums of powers modulo 2^64 take for equal; rows whose numbers must not move."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from solstrand.llm import jaccard, pii, tokens
from solstrand.llm.words import buffers, span_hashes, words
from tests.llm import brute


def mirrored(n):
    """A Thue-Morse text of n letters and the same with its letters swapped."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_spans_of_all_lengths():
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 99, 4000).astype(np.uint8)
    spans = [(a, a + n) for n in range(0, 600, 7) for a in range(0, 3000, 97)]
    start, end = np.array(spans).T
    got = span_hashes(raw, start, end)
    by_bytes = {}
    for (a, b), h in zip(spans, got.tolist(), strict=True):
        assert by_bytes.setdefault(raw[a:b].tobytes(), h) == h
    assert len(set(by_bytes.values())) == len(by_bytes)


@pytest.mark.parametrize("n", [64, 256, 1024, 2048, 1 << 14])
def test_swapped_letters_are_another_word(n):
    import pyarrow as pa

    found = words(*buffers(pa.array(list(mirrored(n)))))
    assert len(set(found.code.tolist())) == 2


def test_swapped_letters_are_not_linked(spark):
    rows = list(enumerate(mirrored(2048)))
    got = jaccard.document_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(0, 0), (1, 1)}


def test_swapped_letters_have_their_own_ids(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = list(enumerate(mirrored(2048)))
    got = tokens.document_ids(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), path).collect()
    tokenizer = Tokenizer.from_file(path)
    for r in got:
        ids = [*tokenizer.encode(rows[r.doc_id][1], add_special_tokens=False).ids, 2]
        assert (r.n_tokens, r.ids_crc32) == (len(ids), brute.crc_ids(ids))


def test_rows_are_the_same_however_files_are_split(spark, tmp_path):
    rows = [(i, f"text number {i} of a.b{i}@c.de" if i % 3 else "plain words without anything", "en") for i in range(60)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6).write.parquet(path)
    results = set()
    for parts in ("1", "16"):
        spark.conf.set("spark.sql.files.minPartitionNum", parts)
        try:
            docs = spark.read.parquet(path)
            out = pii.redacted(docs)
            # The layout changes between the scans of one result.
            spark.conf.set("spark.sql.files.minPartitionNum", "4")
            found = sorted((r.doc_id, r.text) for r in out.collect())
        finally:
            spark.conf.unset("spark.sql.files.minPartitionNum")
        results.add(hashlib.sha256(repr(found).encode()).hexdigest())
        assert found == [(i, f"text number {i} of [EMAIL]" if i % 3 else t) for i, t, _ in rows]
    assert len(results) == 1
