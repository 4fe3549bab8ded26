"""Every operator over whole tables, against plain versions."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from pyspark.sql import functions as F

from solstrand.llm import jaccard, queries, suffixes
from solstrand.llm.packing import packed
from solstrand.llm.urls import (
    LONG_SUFFIXES,
    MOST_PSEUDO,
    RULES,
    TAIL,
    WORTH,
    beta_quantile,
    judged_pages,
    label_outcomes,
    url_host,
    url_path,
)
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def result(spark, name):
    return queries.queries()[name](spark, SF)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_personal_data(spark, docs):
    got = by_id(result(spark, "op1_personal_data"))
    assert len(got) == len(docs)
    for d, text in docs:
        spans = brute.base_spans(text)
        row = got[d]
        assert [row[f"n_{k}"] for k in brute.KINDS] == [sum(s[0] == k for s in spans) for k in brute.KINDS]
        assert row.base_sha256 == brute.sha(brute.joined(spans))
        assert set(filter(None, brute.joined(spans).split(","))) <= set(row.spans.split(","))


def test_shards(spark, docs):
    got = by_id(result(spark, "op2_feistel_shards"))
    assert len(got) == len(docs)
    rows = Counter(r.shard for r in got.values())
    assert set(rows) == set(range(24)) and max(rows.values()) - min(rows.values()) <= 1
    for shard in rows:
        assert sorted(r.slot for r in got.values() if r.shard == shard) == list(range(rows[shard]))
    for d, text in docs:
        data = (text or "").encode()
        assert got[d].size == len(data) + 8 and got[d].text_crc32 == brute.zlib.crc32(data)


def test_jaccard(spark, docs):
    got = by_id(result(spark, "op6_jaccard_components"))
    want = brute.components(docs)
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == want
    assert any(c != d for d, (_, c) in want.items())


def test_jaccard_in_many_parts(spark, monkeypatch):
    """Near copies in chains, far more of them than a part takes, over a range of sizes."""
    monkeypatch.setattr(jaccard, "PART", 8)
    rows = []
    for family in range(3):
        words = [f"f{family}w{i}" for i in range(90)]
        for i in range(70):
            words = words[1:] + [f"f{family}n{i}"] if i % 3 else [*words, f"f{family}n{i}"]
            rows.append((len(rows), " ".join(words)))
            rows.append((len(rows), " ".join([*words[: 40 + i // 2], f"only{family}x{i}"])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = by_id(jaccard.document_components(df))
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == brute.components(rows)


def test_odd_urls(spark):
    urls = [
        None, "", "://", "a://", "http://A.B/c?d#e", "x" * 100000, "http://" + "h\U0001f600" * 20000 + "/p",
        "//a://b://c/d://e", "http://u#://x/y", "HTTP://É.Com\n/a\nb?c", "a:/b://c",
    ]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    for r in df.select("url", url_host(F.col("url")).alias("h"), url_path(F.col("url")).alias("p")).collect():
        assert (r.h, r.p) == brute.host_path(r.url)


def test_urls(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r for r in result(spark, "op7_host_reputation").collect()}
    assert set(got) == set(pages)
    for page, url in pages.items():
        host, path = brute.host_path(url)
        rule, verdict = brute.rule(host, path, RULES)
        assert (got[page].host, got[page].path, got[page].rule) == (host, path, rule)
        assert got[page].verdict in ("allow", "block") and verdict in (None, got[page].verdict)


def assert_reputations(pages, outcomes):
    """Whole rows of judged_pages against the plain version; gives the hosts without labels."""
    urls, bad = [(r.page_id, r.url) for r in pages.collect()], {r.page_id: r.bad for r in outcomes.collect()}
    rows = [(p, brute.host_path(u)[0], bad.get(p)) for p, u in urls]
    want = brute.reputation(rows, WORTH, TAIL, LONG_SUFFIXES, MOST_PSEUDO)
    got = judged_pages(pages, outcomes).collect()
    assert sorted(r.page_id for r in got) == sorted(p for p, _ in urls)
    for r in got:
        n, b, lower, verdict = want[r.host]
        _, says = brute.rule(r.host, r.path, RULES)
        assert (r.labelled, r.labelled_bad, r.verdict) == (n, b, says or verdict), r
        assert abs(r.bad_bound - lower) < 2e-6, r
    return {h: v for h, v in want.items() if not v[0]}


def test_beta_quantile(spark):
    pairs = [(a, b) for a in (0.02, 0.5, 1.0, 3.7, 60.0, 2e4) for b in (0.3, 1.0, 9.0, 800.0, 1e6)]
    df = spark.createDataFrame([*pairs, (0.0, 2.0), (2.0, 0.0)], "a double, b double")
    for p in (0.05, 0.5):
        for r in df.withColumn("q", beta_quantile(F.col("a"), F.col("b"), p)).collect():
            want = brute.beta_quantile(r.a, r.b, p)
            assert abs(r.q - want) <= (2e-2 if r.a < 0.1 else 2e-5) * want * (1 - want) + 1e-9, (r, want)


def test_hosts_without_labels(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    assert assert_reputations(pages, label_outcomes(labels))
    rows = [(f"{'abcdef'[i % 6]}.bad.net", 1) for i in range(120)]
    rows += [(f"{'abcdef'[i % 6]}.good.net", 0) for i in range(120)] + [("9.9.9.9", 0), ("x.poor.co.uk", 1)]
    new = ["new.bad.net", "new.good.net", "other.net", "www.poor.co.uk", "u.v", "8.8.8.8"]
    hosts = [*rows, *[(h, None) for h in new], (None, None)]
    pages = [(i, h and f"http://{h}/p") for i, (h, _) in enumerate(hosts)]
    unlabelled = assert_reputations(
        spark.createDataFrame(pages, "page_id long, url string"),
        spark.createDataFrame([(i, b) for i, (_, b) in enumerate(hosts)], "page_id long, bad int"),
    )
    assert set(unlabelled) == {*new, ""}
    assert unlabelled["new.bad.net"][-1] == "block" and unlabelled["new.good.net"][-1] == "allow"
    none = spark.createDataFrame([], "page_id long, bad int")
    assert_reputations(spark.createDataFrame(pages, "page_id long, url string"), none)


def test_token_ids(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = by_id(result(spark, "op8_token_ids"))
    assert len(got) == len(docs)
    start = 0
    for d, text in sorted(docs):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (start, len(ids), brute.crc_ids(ids))
        start += len(ids)


def test_quality(spark, docs):
    got = by_id(result(spark, "op9_quality_rules"))
    assert len(got) == len(docs)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for d, text in docs:
        want = brute.base_quality(text)
        assert tuple(got[d][n] for n in names) == want
        assert not (got[d].kept and want[-1])


def test_fingerprints(spark, docs):
    got = by_id(result(spark, "op10_scaled_sketches"))
    want = brute.edited(docs)
    assert len(got) == len(docs)
    same = {}
    for d, text in docs:
        assert got[d].n_chars == len(text or "") and got[d].edited_sha256 == brute.sha(want[d])
        assert same.setdefault(text, got[d].fingerprint) == got[d].fingerprint
        assert 0 <= got[d].near_edited <= 1 and 0 <= got[d].near_next <= 1


def test_repeats(spark, docs):
    got = result(spark, "op5_repeated_passages").collect()
    words = {(r.doc_id, i) for r in got for i in range(r.start_word, r.end_word)}
    assert words == brute.repeats(docs, 50)
    assert all(r.n_words >= 50 for r in got) and got
    assert sorted((r.doc_id, r.start_word, r.end_word) for r in got) == brute.stretches(docs, 50)


def test_passages_made_of_two_documents(spark):
    """Words 0 to 48 of a text in one document and 31 to 79 in another are no passage of 50 words."""
    rows, want = [], []
    for case in range(12):
        word = lambda i, c=case: f"c{c}w{i * 7919 % 1009}"
        whole = [word(i) for i in range(80)]
        shared = 49 if case < 9 else 50 + case
        parts = [whole, [*whole[:shared], *map(word, range(200, 230))], [*map(word, range(300, 340)), *whole[-shared:]]]
        rows += [(case * 3 + i, " ".join(p)) for i, p in enumerate(parts)]
    rows += [(100, " ".join(["again"] * 300)), (101, " ".join(["again"] * 120)), (102, None), (103, "")]
    want = brute.stretches(rows, 50)
    got = suffixes.document_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.start_word, r.end_word) for r in got.collect()) == want
    assert {d for d, _, _ in want} == {*range(27, 36), 100, 101}


def test_passages_under_other_layouts(spark):
    """Copies, overlaps and edits of the same passages, in one task or in many."""
    rng = random.Random(3)
    base = [[f"w{rng.randrange(4000)}" for _ in range(160)] for _ in range(6)]
    rows = []
    for i in range(90):
        text = []
        for _ in range(rng.randrange(1, 5)):
            passage = rng.choice(base)
            a = rng.randrange(0, 110)
            piece = passage[a : a + rng.randrange(30, 120)]
            if rng.random() < 0.4:
                piece[rng.randrange(len(piece))] = f"edit{i}"
            text += piece + [f"own{i}x{j}" for j in range(rng.randrange(0, 4))]
        rows.append((i, " ".join(text)))
    want = brute.stretches(rows, 50)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for layout in (df.coalesce(1), df.repartition(7)):
        got = suffixes.document_repeats(layout).collect()
        assert sorted((r.doc_id, r.start_word, r.end_word) for r in got) == want


def test_packing(spark, docs):
    got = result(spark, "op4_length_buckets").collect()
    tokens = Counter()
    for r in got:
        tokens[r.doc_id] += r.n_tokens
    assert tokens == {d: -(-len(t.encode()) // 4) for d, t in docs if t}
    batches: dict = {}
    for r in got:
        assert r.n_tokens <= r.bucket_length
        batches.setdefault((r.bucket, r.batch), []).append(r)
    for rows in batches.values():
        assert len(rows) * rows[0].bucket_length <= max(65536, rows[0].bucket_length)
        assert sorted(r.slot for r in rows) == list(range(len(rows)))


def test_packed_pieces_hold_the_text(spark, docs):
    odd = ["é" * 30, "a\U0001f600" * 40, "x", "\U0001f600é€b" * 25, "", None, "\u20ac" * 64, "z" * 32]
    rows = [*docs, *[(10**6 + i, t) for i, t in enumerate(odd)], (10**6, "another of the same id, long enough")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    counted = F.ceil(F.char_length(F.col("text")) / 3).cast("long")
    for context, tokens in ((8, None), (2048, None), (7, counted)):
        texts: dict = {}
        for r in packed(df, tokens, context=context).collect():
            size = len(r.text.encode())
            assert tokens is not None or abs(size - 4 * r.n_tokens) <= 3 + 3 * (r.n_tokens < context), r
            texts.setdefault(r.doc_id, []).append((r.piece, r.text))
        whole = {d: [t for e, t in rows if e == d] for d, _ in rows if d != 10**6}
        got = {d: "".join(t for _, t in sorted(p)) for d, p in texts.items()}
        assert {d: got.get(d, "") for d in whole} == {d: t[0] or "" for d, t in whole.items()}
    assert "text" not in result(spark, "op4_length_buckets").columns


def test_pipeline_packs_redacted_text(spark):
    import corpus_pipeline

    prose = " ".join(f"w{i * 7919 % 997}" for i in range(40))
    df = spark.createDataFrame([(1, f"{prose} mail a.b@c.de", "en", "src0")], "doc_id long, text string, lang string, source string")
    for _, stage in corpus_pipeline.STAGES[2:]:
        df = stage(spark, df, "")
    texts = {r.text for r in df.collect()}
    assert texts == {f"{prose} mail [EMAIL]"}
