"""Alignment of two tokenizers against a plain version that encodes whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from solstrand.llm import alignment, queries, words

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = alignment.byte_letters()
    entries = {
        i: bytes(letters[c] for c in t) for t, i in tokenizer.get_vocab(with_added_tokens=False).items()
    }

    def piece(i):
        text = model.id_to_piece(i)
        return bytes([int(text[3:5], 16)]) if model.is_byte(i) else text.replace("▁", " ").encode()

    def align(text):
        a = tokenizer.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        want = (" " + (text or "")).encode()
        if b"".join(entries[i] for i in a) != want or b"".join(map(piece, b)) != want:
            return [], [], [], []
        ends = []
        for tokens in ([entries[i] for i in a], [piece(i) for i in b]):
            ends.append(np.cumsum([len(t) for t in tokens]).tolist())
        groups, links, i, j = [], [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            p, q = ends[0].index(cut, i) + 1, ends[1].index(cut, j) + 1
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            links.append((a[p - 1], b[q - 1]))
            i, j = p, q
        return a, b, groups, links

    def digest(docs):
        found = [align(t) for _, t in docs]
        counts = Counter(x for *_, links in found for x in links)
        best = Counter()
        for (_, b), n in counts.items():
            best[b] = max(best[b], n)
        out = []
        for (d, _), (a, b, groups, links) in zip(docs, found, strict=True):
            sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
            n_best = sum(counts[x] == best[x[1]] for x in links)
            out.append((d, len(a), len(b), len(groups), len(links), n_best, sum(counts[x] for x in links), sha))
        return sorted(out, key=str)

    return digest


def digest(df):
    return sorted((tuple(r) for r in alignment.alignment_digest(df, A, B).collect()), key=str)


def test_whole_table(spark, plain):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.queries()["op12_token_alignment"](spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain([(r.doc_id, r.text) for r in df.collect()])


def odd_texts(n):
    rng = random.Random(3)
    atoms = ["a", "word", "don't", " ", "  ", "\n", "\t", "é", "é", "“x”", "—", " ", " ", "　", "▁"]
    atoms += ["<|endoftext|>", "<s>", "</s>", "<0x41>", "\x00", "\x1c", "\x85", "᠎", "​", "﻿", "日本", "😀"]
    atoms += ["12,345", "ﬁ", "'s", "'LL", "\r\n", "Ω", "x" * 50, "   ", "=", "#"]
    texts = [
        "".join(rng.choice(atoms) + (" " if rng.random() < 0.4 else "") for _ in range(rng.randint(1, 25)))
        for _ in range(n)
    ]
    return [*enumerate(texts), (-1, None), (-2, ""), (-3, " "), (-4, "   "), (None, "a b"), (None, "a b"), (5, "a ")]


@pytest.mark.parametrize("common", [alignment.COMMON, 0.02, 2.0])
def test_odd_texts(spark, plain, monkeypatch, common):
    """However many pairs are looked up by broadcast: all, a few, none."""
    monkeypatch.setattr(alignment, "COMMON", common)
    rows = odd_texts(1500)
    want = plain(rows)
    assert digest(spark.createDataFrame(rows, SCHEMA).repartition(4)) == want
    assert 0 < sum(r[1] == 0 for r in want) < len(rows)


def test_long_texts_in_pieces_and_small_cache(spark, plain, monkeypatch):
    for module in (alignment, words):
        monkeypatch.setattr(module, "SLICE", 100)
    monkeypatch.setattr(alignment, "CACHE", 20)
    rows = [(i, " ".join(t for _, t in odd_texts(400)[i::9] if t and "▁" not in t)) for i in range(9)]
    want = plain(rows)
    assert digest(spark.createDataFrame(rows, SCHEMA)) == want
    assert any(r[1] for r in want)


def test_groups_and_ends(spark):
    rows = [(1, "unbelievable tokenizers"), (2, None), (3, "x▁y")]
    df = spark.createDataFrame([(*r, "mine") for r in rows], SCHEMA + ", pairs string")
    got = {r.doc_id: r for r in alignment.alignments(df, A, B).collect()}
    groups = got[1].groups.split(";")
    assert len(groups) == got[1].n_groups == len(got[1].ends) and got[1].ends[-1] == len(" unbelievable tokenizers")
    assert sum(len(g.split("|")[0].split(",")) for g in groups) == got[1].n_a
    assert sum(len(g.split("|")[1].split(",")) for g in groups) == got[1].n_b
    for d in (2, 3):
        assert (got[d].n_a, got[d].groups, got[d].groups_sha256, got[d].pairs) == (0, "", "", [])
    empty = spark.createDataFrame([], SCHEMA)
    assert alignment.alignment_digest(empty, A, B).collect() == []


def test_pointers_reach_the_last_token_of_a_group():
    rng = np.random.default_rng(1)
    for _ in range(200):
        total = int(rng.integers(1, 60))
        a, b = (
            np.append(np.sort(rng.choice(np.arange(1, total), rng.integers(0, total), False)), total)
            for _ in range(2)
        )
        last = alignment.last_of_group(a, b)
        cuts = np.intersect1d(a, b)
        want = np.searchsorted(cuts, np.concatenate([a, b]))
        assert (np.searchsorted(cuts, a[last[: len(a)]]) == want[: len(a)]).all()
        assert (last < len(a)).all() and len(set(last.tolist())) == len(cuts)
