"""NULLs, empty and odd rows, clashing columns, empty tables; the parts of the operators."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from solstrand.llm import (
    fingerprints,
    jaccard,
    mixing,
    packing,
    pii,
    quality,
    sharding,
    signatures,
    suffixes,
    tokens,
    urls,
)
from tests.llm import brute

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row int, shard string, kept int,"
    " place int, domain string, batch int, key_ int"
)
PROSE = " ".join(f"w{i * 7919 % 997}" for i in range(120))
ROWS = [
    (1, PROSE, "en", "src0"),
    (1, PROSE, "en", "src0"),
    (2, PROSE + " tail", None, "src1"),
    (3, "", "de", None),
    (4, None, None, None),
    (None, "mail a.b@c.de or +1 (743) 555-3824", "en", "src0"),
    (6, "x" * 50000 + "@" + "1 " * 20000 + "a@b" + ".c" * 5000, "fr", "src2"),
    (7, "é \U0001f600 4785380592391139, 8.8.8.8 1.2.3.999", "es", "src5"),
    (8, "   \n\t", "en", "src0"),
]


@pytest.fixture(scope="module", params=["rows", "empty"])
def docs(spark, request, tmp_path_factory):
    rows = [(*r, 0, 1, "s", 2, 3, "d", 4, 5) for r in ROWS] if request.param == "rows" else []
    path = str(tmp_path_factory.mktemp("docs") / "t")
    spark.createDataFrame(rows, SCHEMA).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


def test_all_digests_take_odd_rows(docs):
    n = docs.count()
    for work in (
        pii.personal_data_digest,
        sharding.document_shards,
        jaccard.document_components,
        quality.quality_digest,
        fingerprints.fingerprint_digest,
    ):
        assert len(work(docs).collect()) == n, work
    mixing.mix_digest(docs).collect()
    packing.packing_digest(docs).collect()
    found = suffixes.document_repeats(docs).collect()
    assert {r.doc_id for r in found} == ({1, 2} if n else set())


def test_token_ids_take_odd_rows(docs):
    import public_tokenizers

    rows = tokens.document_ids(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert len(rows) == docs.count()
    assert all(r.n_tokens == 1 for r in rows if r.doc_id in (3, 4))


def test_all_stages_take_odd_rows(docs, spark):
    out = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, "")
        assert out.columns == docs.columns
    corpus_pipeline.STAGES[-1][1](spark, out, "").collect()


def test_spans_of_odd_rows(docs):
    if not docs.count():
        return
    for r in pii.personal_data_digest(docs).collect():
        text = next(t for d, t, *_ in ROWS if d == r.doc_id)
        assert r.base_sha256 == brute.sha(brute.joined(brute.base_spans(text)))


def test_redaction(docs):
    texts = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    if texts:
        assert texts[None] == "mail [EMAIL] or [PHONE]"
        assert texts[7] == "é \U0001f600 [CARD], [IP] 1.2.3.999" and texts[4] is None


def test_feistel_is_a_permutation():
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        p = sharding.permuted(np.arange(n), n, 3)
        assert sorted(p.tolist()) == list(range(n))
        assert (sharding.permuted(p, n, 3, back=True) == np.arange(n)).all()


def test_boundaries_are_optimal():
    rng = random.Random(1)
    for _ in range(30):
        hist = {rng.randint(1, 40): rng.randint(1, 9) for _ in range(8)}
        lengths = sorted(hist)
        got = packing.optimal_boundaries(hist, 3)

        def cost(bounds):
            return sum(n * min(b for b in bounds if b >= x) for x, n in hist.items())

        from itertools import combinations

        best = min(
            cost([*c, lengths[-1]]) for k in range(3) for c in combinations(lengths[:-1], k)
        )
        assert cost(got) == best and len(got) <= 3


def test_directly_addressable_codes():
    rng = np.random.default_rng(2)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = rng.integers(0, 1 << rng.integers(1, 32), n).astype(np.uint32)
        levels = tokens.encode_levels(ids)
        assert (tokens.decode_levels(levels, 0, n) == ids).all()
        if n > 20:
            assert (tokens.lookup(levels, np.arange(n)) == ids).all()
            assert (tokens.decode_levels(levels, 7, n - 3) == ids[7 : n - 3]).all()


def test_signature_tree_loses_no_pair():
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(60):
        base = rng.integers(0, 1 << 62, int(rng.integers(1, 80))).astype(np.uint64)
        for _ in range(3):
            sets.append(np.unique(base[rng.random(len(base)) < 0.93]))
    sets = sorted((s for s in sets if 0 < len(s) < 200), key=len)
    bits = np.stack([signatures.folded(signatures.signature(s), 512) for s in sets])
    tree = signatures.build(bits, np.array([len(s) for s in sets]))
    got = {p for a, b in signatures.linked_leaves(tree, 75, 100) for p in zip(a.tolist(), b.tolist())}
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                assert (i, j) in got


def test_shares_fill_siblings_first(spark):
    leaves = [
        ("a", "x", "p", 10, 1, 1, 1, 1),
        ("a", "x", "q", 1000, 1, 1, 1, 1),
        ("b", "y", "r", 1000, 1, 1, 1, 1),
    ]
    df = spark.createDataFrame(
        leaves,
        "domain string, language string, leaf string, tokens long, rows long, domain_weight long,"
        " lang_weight long, leaf_weight long",
    )
    got = {r.leaf: r.budget for r in mixing.leaf_budgets(df, 300, 1).collect()}
    # 603 tokens, half for each domain; what p cannot give goes to q, its sibling, not to r.
    assert got == {"p": 10, "q": 291, "r": 301}


def test_reputation_shrinks_towards_the_domain(spark):
    rows = [("a.x.com", 1)] * 50 + [("b.x.com", 1)] + [("y.org", 0)] * 50 + [("z.org", 1)]
    seen = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "page_id long, host string, bad int"
    )
    got = {r.host: r for r in urls.host_reputation(seen, long_suffixes=[], limit=0.25).collect()}
    assert got["b.x.com"].posterior > got["z.org"].posterior
    assert got["a.x.com"].reputation == "block" and got["y.org"].reputation == "allow"


def test_sketches_estimate_containment(spark):
    words = [f"v{i}" for i in range(4000)]
    df = spark.createDataFrame([(" ".join(words), " ".join(words[:1000]))], "a string, b string")
    a, b = fingerprints.sketch(F.col("a")), fingerprints.sketch(F.col("b"))
    row = df.select(fingerprints.containment(b, a), fingerprints.containment(a, b)).first()
    assert row[0] == 1.0 and abs(row[1] - 0.25) < 0.06


def test_sketches_of_short_texts(spark):
    rng = random.Random(4)
    texts = [" ".join(f"v{rng.randrange(30)}" for _ in range(n)) for n in range(1, 36)] * 2 + ["", " \n", None]
    texts += [f"{t} tail" for t in texts if t]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprints.fingerprint_digest(df).collect()}
    sets = {d: brute.shingles(t, lower=False) for d, t in rows}
    edited = {d: brute.shingles(t, lower=False) for d, t in brute.edited(rows).items()}

    def alike(a, b):
        return len(a & b) / len(a | b) if a | b else 1.0

    for d, _ in rows:
        assert bool(got[d].fingerprint) == bool(sets[d])
        after = sets[(d - 1) % len(rows)]
        if max(len(sets[d]), len(after)) < fingerprints.LEAST:
            assert abs(got[d].near_next - alike(sets[d], after)) < 1e-12
        if max(len(sets[d]), len(edited[d])) < fingerprints.LEAST:
            assert abs(got[d].near_edited - alike(sets[d], edited[d])) < 1e-12


def test_sketches_merge_at_all_sizes(spark):
    sizes = (0, 1, 3, 20, 35, 40, 300, 2000)
    texts = ["".join(f"a{i} b{i} c{n} d{i} e{i} ; ; ; ; ; " for i in range(n)) for n in sizes]
    pairs = [(a, b) for a in texts for b in texts]
    df = spark.createDataFrame(pairs, "a string, b string")
    one = lambda c: fingerprints.sketch(F.col(c), k=1)
    whole = fingerprints.sketch(F.concat("a", F.lit(" "), "b"), k=1)
    assert df.filter(fingerprints.merged(one("a"), one("b")) != whole).count() == 0


def test_languages_without_reference_are_not_judged(spark):
    prose = " ".join(f"word{i % 90}" if i % 3 else f"the{i % 7}" for i in range(400))
    russian = " ".join(f"\u0441\u043b\u043e\u0432\u043e{i}" for i in range(68))
    rows = [(i, "en", prose) for i in range(5)] + [(5, "ru", russian), (6, "en", russian), (7, None, russian)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = {r.doc_id: r for r in quality.quality_digest(df).collect()}
    for d in (5, 7):
        assert got[d].kept and got[d].class_distance is None and got[d].word_distance is None
    assert got[6].class_distance + got[6].word_distance > quality.MAX_DISTANCE and not got[6].kept
    assert got[0].kept and got[0].class_distance is not None
    assert {r.doc_id for r in quality.kept_documents(df).collect()} == {0, 1, 2, 3, 4, 5, 7}


def test_literals_of_added_tokens(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    end = "<|endoftext|>"
    texts = [
        end, f"{end}{end}", f"a{end}b", f"{end} a word", f"a word {end}", f"one  {end}  two", f"x\n{end}\ny",
        f"don{end}'t", f"<{end}>", "<|endoftext|", "|>", "<|endof text|>", f"caf\u00e9{end}\u00a0\U0001f600", "plain words",
        f"some words{end} and some words {end}{end} more", "<|endoftext", "|> tail", None, "",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    tokenizer = Tokenizer.from_file(path)
    start = 0
    for r in sorted(tokens.document_ids(df, path).collect(), key=lambda r: r.doc_id):
        ids = [*tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), brute.crc_ids(ids)), texts[r.doc_id]
        start += len(ids)


def test_own_columns_called_like_working_ones(spark):
    """Every working name as a column of the input: same results as without, own values kept."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source")

    def compared(work, plain, names, ids):
        crowded = plain.withColumns({n: F.lit(f"own {n}") for n in names})
        want, got = work(plain), work(crowded)
        shared = sorted(want.columns)
        assert sorted(map(str, got.select(shared).collect())) == sorted(map(str, want.select(shared).collect()))
        assert got.select(names).distinct().collect() == [tuple(f"own {n}" for n in names)], ids

    mix = ["lang_", "source_", "tokens_", "text_md5_", "mix_epochs_", "mix_rest_", "mix_order_", "mix_range_"]
    compared(mixing.mixed_documents, docs, [*mix, "edge_", "run_", "sum_", "rest_", "before_", "span"], "op3")
    pack = ["all_", "all_tokens_", "found_", "number_", "per_", "place_", "spread_", "slot_"]
    compared(packing.packed, docs, pack, "op4")
    near = ["key_", "tie_", "range_", "lent_", "to_", "wraps_", "head"]
    compared(lambda d: fingerprints.with_successors(d, {}), docs.drop("lang", "source"), near, "op10")
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url")
    outcomes = urls.label_outcomes(spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    facts = ["n", "bad", "lower", "reputation", "host_", "known_", "posterior", "prior", "domain", "suffix"]
    compared(lambda d: urls.judged_pages(d, outcomes), pages, facts, "op7")
