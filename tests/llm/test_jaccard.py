"""Steps of the Jaccard join against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from solstrand.llm import jaccard, words


def batch(texts, hashes):
    return pa.RecordBatch.from_pydict(
        {"text": pa.array(texts, pa.string()), "h": pa.array(hashes, pa.int64())}
    )


def flags(values):
    out = np.zeros(1 << (jaccard.FILTER_BITS - 3), np.uint8)
    for x in values:
        at = x & ((1 << jaccard.FILTER_BITS) - 1)
        out[at >> 3] |= 1 << (at & 7)
    return out


def test_only_texts_that_are_asked_for_are_cut_again(monkeypatch):
    texts = [f"text number {i} of a few with words of its own {i * i}" for i in range(50)]
    texts += [texts[3], None, ""]
    hashes = [*range(50), 3, 42, 43]
    names = jaccard.set_names(*jaccard._sets(batch(texts, hashes), 5)).tolist()
    assert names[50] == names[3] and names[51:] == [0, 0] and len(set(names)) == 51
    cut, sets = [], jaccard._sets

    def counted(part, k):
        cut.extend(part.column("text").to_pylist())
        return sets(part, k)

    monkeypatch.setattr(jaccard, "_sets", counted)
    asked = [3, 7, 20]
    work = jaccard._wanted(5, flags(asked), flags(names[i] for i in asked))
    got = [r for b in work(iter([batch(texts, hashes)])) for r in b.to_pylist()]
    assert [r["set_id"] for r in got] == [names[i] for i in asked]
    assert [len(r["shingles"]) for r in got] == [8, 8, 8]
    assert cut == [texts[3], texts[7], texts[20], texts[50]]


def test_sets_of_rows_with_few_or_no_words():
    rng = random.Random(2)
    rows = [[rng.randrange(1, 5) for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 9, 30]))] for _ in range(200)]
    for some in (rows, rows[:1], [[]], [[1]], [[1, 2], [], [3, 1, 2, 1, 2, 1]], []):
        code = np.array([x for r in some for x in r], np.uint64)
        first = np.concatenate([[0], np.cumsum([len(r) for r in some])]).astype(np.int64)
        values, bounds = words.text_sets(code, first, 3)
        assert len(bounds) == len(some) + 1
        for r, a, b in zip(some, bounds[:-1], bounds[1:], strict=True):
            own = np.array(r, np.uint64)
            plain = words.grams(own, min(3, len(r))) if r else own
            assert values[a:b].tolist() == sorted(set(plain.tolist()))


def test_sharers_of_a_token_across_batches():
    rng = random.Random(1)
    for _ in range(300):
        rows = sorted((rng.randrange(-4, 5), rng.randrange(-3, 6)) for _ in range(rng.randrange(40)))
        want = set()
        for token in {t for t, _ in rows}:
            sets = {x for t, x in rows if t == token}
            want |= {(min(sets), x) for x in sets if len(sets) > 1}
        batches, at = [], 0
        while at < len(rows):
            to = at + rng.randrange(7)
            batches.append(
                pa.RecordBatch.from_pydict(
                    {
                        "token": pa.array([t for t, _ in rows[at:to]], pa.int64()),
                        "set_id": pa.array([x for _, x in rows[at:to]], pa.int64()),
                    }
                )
            )
            at = to
        got = {(r["run"], r["set_id"]) for b in jaccard._sharers(iter(batches)) for r in b.to_pylist()}
        assert got == want
