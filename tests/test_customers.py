"""Matching, entity resolution, baskets, survival, attribution and neighbours against plain versions."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from solstrand.operators import attribution, baskets, matching, nearest, resolution, survival
from solstrand.plans import customers

SF = "/root/testdata/sf0.001"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize(("k", "part"), [(2, 3), (1, 2000)])
def test_near_texts_equal_all_pairs(spark, monkeypatch, k, part):
    """Short and empty texts, repeated letters, one gram in all texts, blocks cut into parts."""
    monkeypatch.setattr(matching, "PART", part)
    rng = random.Random(7)
    texts = ["", "a", "ab", "ba", "é", None, "aaaaaaaaaa", "aaaaaaaa", "ababababab"]
    texts += ["".join(rng.choice("abc") for _ in range(rng.randint(0, 9))) for _ in range(60)]
    for _ in range(40):
        word = list("common part " + "".join(rng.choice("abcdefgh") for _ in range(4)))
        for _ in range(rng.randint(0, 2)):
            word[rng.randrange(len(word))] = rng.choice(["", "x", "yz"])
        texts.append("".join(word))
    left, right = texts[::2] + texts[:3], texts[1::2] + texts[4:9]
    frame = lambda rows: spark.createDataFrame([(t,) for t in rows], "text string").repartition(3)
    got = {tuple(r) for r in matching.near_texts(frame(left), frame(right), k).collect()}
    want = {(a, b, edits(a, b)) for a in left if a is not None for b in right if b is not None}
    assert got == {w for w in want if w[2] <= k}


def test_entities_find_the_planted_copies(spark):
    got = {r.id: r.entity for r in customers.person_entities(spark, "/root/testdata/sf0.01").collect()}
    linked = {(a, e) for a, e in got.items() if a != e}
    planted = {(i, i - 1) for i in got if i % 2}
    right = len(linked & planted)
    assert right / len(planted) >= 0.98 and right / len(linked) >= 0.98


def test_evidence_by_parts_of_a_hot_block(spark, monkeypatch):
    monkeypatch.setattr(resolution, "PART", 4)
    rows = [(i, "same", f"n{i // 2}", None if i == 7 else i % 2) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, town string, name string, flag int")
    fields = [resolution.Field("town", 0.9), resolution.Field("name", 0.9), resolution.Field("flag", 0.5)]
    pairs = {(r.a, r.b): r.weight for r in resolution.evidence(df, "id", fields, [("town",), ("name", "flag")]).collect()}
    assert set(pairs) == set(combinations(range(30), 2))
    assert max(pairs, key=pairs.get) in {(i, i + 1) for i in range(0, 30, 2)}
    found = resolution.resolved(df, "id", fields, [("town",)], pairs[6, 7] - 1e-9)
    assert {r.id: r.entity for r in found.collect()}[7] == 6


def test_frequent_sets_equal_counting_all(spark):
    rng = random.Random(8)
    rows = [(b, i) for b in range(60) for i in rng.sample("abcdefg", rng.randint(0, 5))]
    df = spark.createDataFrame([*rows, *rows[:9], (None, "a"), (1, None)], "b int, i string")
    held = {b: {i for c, i in rows if c == b} for b, _ in rows}
    for least, largest in ((6, 4), (1, 3), (100, 3)):
        got = {tuple(r["items"]): r.n for r in baskets.frequent_sets(df, "b", "i", least, largest).collect()}
        want = Counter(s for items in held.values() for k in range(1, largest + 1) for s in combinations(sorted(items), k))
        assert got == {s: n for s, n in want.items() if n >= least}


def test_survival_with_censoring(spark):
    rng = random.Random(9)
    lives = [(rng.choice("ab"), rng.choice([None, *range(6)]), rng.random() < 0.5) for _ in range(80)] + [("c", 1, True), ("c", 2, True)]
    df = spark.createDataFrame(lives, "g string, t int, gone boolean")
    got = {(r.g, r.t): r for r in survival.product_limit(df, "g", "t", F.col("gone")).collect()}
    for g in "abc":
        mine = [(t, e) for h, t, e in lives if h == g and t is not None]
        s, green = 1.0, 0.0
        for t in sorted({t for t, _ in mine}):
            n, d = sum(u >= t for u, _ in mine), sum(u == t and e for u, e in mine)
            s *= 1 - d / n
            green += d / (n * (n - d)) if n > d else 0
            row = got.pop((g, t))
            assert (row.at_risk, row.n_ended) == (n, d) and row.survival == pytest.approx(s, abs=1e-12)
            assert row.variance == (pytest.approx(s * s * green) if s > 0 else None)
    assert not got


def test_removal_effects(spark, tmp_path):
    """A path simulated step by step with a channel taken away sells as often as the matrix says."""
    rows = [(1, i, c) for i, c in enumerate("abSbaabSab")] + [(2, i, c) for i, c in enumerate("SaSbbSa")] + [(3, 0, "c")]
    spark.createDataFrame(rows, "u int, t int, c string").repartition(4).write.parquet(str(tmp_path / "t"))
    touches = spark.read.parquet(str(tmp_path / "t"))
    stepped = attribution.steps(touches, "u", [F.col("t")], "c", F.col("c") == "S").cache()
    counts = {(r.source, r.target): r.n for r in attribution.transitions(stepped).collect()}
    want: Counter = Counter()
    for u in (1, 2, 3):
        path = "".join(c for v, _, c in rows if v == u)
        for piece in path.replace("S", "S ").split():
            names = ["(start)", *("(sale)" if c == "S" else c for c in piece)]
            want.update(zip(names, [*names[1:], "(none)"], strict=True))
    want = Counter({k: n for k, n in want.items() if k[0] != "(sale)"})
    assert counts == want
    effects = attribution.removal_effects(attribution.transitions(stepped))

    def sells(without):
        chance, state = 0.0, {"(start)": 1.0}
        for _ in range(500):
            new: Counter = Counter()
            for s, p in state.items():
                out = sum(n for (a, _), n in counts.items() if a == s)
                for (a, b), n in counts.items():
                    if a == s and b == "(sale)":
                        chance += p * n / out
                    elif a == s and b not in ("(none)", without):
                        new[b] += p * n / out
            state = new
        return chance

    assert effects == {c: pytest.approx(1 - sells(c) / sells(None), abs=1e-9) for c in "abc"}
    credit = {r.channel: (r["first"], r["last"], r.linear) for r in attribution.position_credit(stepped).collect()}
    assert credit["a"] == (2, 1, pytest.approx(0.5 + 2 / 4 + 1.0))


def test_index_recall(spark):
    """The index finds nine in ten of the true neighbours or more; an exhaustive probe finds all."""
    sf = "/root/testdata/sf0.1"
    exact = {(r.query, r.id) for r in customers.vector_neighbours(spark, sf).collect()}
    found = {(r.query, r.id) for r in customers.vector_index_search(spark, sf).collect()}
    assert len(exact) == 5 * 40 and len(exact & found) >= 0.9 * len(exact)


def test_neighbours_of_copies_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 3)
    monkeypatch.setattr(nearest, "PART", 7)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(40, 4)).astype(np.float32)
    x[10:25] = x[10]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<float>").repartition(3)
    whole = np.round(x.astype(np.float64) * 1024).astype(np.int64)
    queries = df.filter("id % 4 = 0")
    want = set()
    for q in range(0, 40, 4):
        best = sorted((-int(whole[q] @ whole[i]), i) for i in range(40) if i != q)[:5]
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    assert {(r["query"], r["rank"], r.id, r.score) for r in nearest.exact_neighbours(df, queries, 5).collect()} == want
    centres = nearest.fit_centres(df, 4)
    everywhere = nearest.index_neighbours(nearest.index(df, centres), centres, queries, 5, len(centres))
    assert {(r["query"], r["rank"], r.id, r.score) for r in everywhere.collect()} == want


def test_neighbours_in_tiles(monkeypatch):
    """Tiles of any size give what sorting all scores gives, equal scores by id and large entries included."""
    rng = np.random.default_rng(6)
    for scores, high in ((1, 3), (50, 3), (1 << 20, 1 << 30)):
        monkeypatch.setattr(nearest, "SCORES", scores)
        x = rng.integers(-high, high, (9000, 3))
        ids = rng.permutation(9000)
        mine = rng.choice(9000, 12, replace=False)
        got_ids, got = nearest._best_of(ids, x, ids[mine], x[mine], 5)
        for row, q in enumerate(mine):
            want = sorted((-int(x[q] @ v), int(i)) for v, i in zip(x, ids, strict=True) if i != ids[q])[:5]
            assert [(-int(s), int(i)) for i, s in zip(got_ids[row], got[row], strict=True)] == want


def test_neighbours_hold_few_scores():
    """A block of queries against a part of a list: 40 million scores, of which few are held at once."""
    x = np.random.default_rng(7).integers(-300, 300, (20000, 8))
    ids = np.arange(20000)
    tracemalloc.start()
    nearest._best_of(ids, x, ids[:2000], x[:2000], 5)
    assert tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()


def test_near_texts_at_the_longest_found_by_rests(spark, monkeypatch):
    """Goods named alike, by rests, by grams, and with the border between the two among them."""
    rng = random.Random(11)
    names = [f"{a} ring Brand#{b} {c}" for a in ("hot", "old", "new") for b in range(8, 13) for c in (1, 7, 12)]
    offers = [n[:i] + rng.choice(["", "x", "yy"]) + n[i + rng.randint(0, 1) :] for n in names for i in [rng.randrange(len(n))]]
    frame = lambda rows: spark.createDataFrame([(t,) for t in rows], "text string")
    want = {(a, b, edits(a, b)) for a in offers for b in names if edits(a, b) <= 2}
    for short in (0, 19, 48):
        monkeypatch.setattr(matching, "SHORT", short)
        found = [tuple(r) for r in matching.near_texts(frame(offers), frame(names)).collect()]
        assert set(found) == want and len(found) == len(want)


def test_rests_compare_what_is_near(spark):
    """Texts of one pattern share their rarest grams with a tenth of all, and a rest only with near ones."""
    names = [f"{a} ring Brand#{b:02} {c:02}" for a in ("hot", "old", "new") for b in range(10, 30) for c in range(10, 30)]
    texts = spark.createDataFrame([(t, True, True) for t in names], "text string, in_left boolean, in_right boolean")
    blocks = matching._rests(texts, 2, 48).select("text", "block").distinct()
    met = blocks.join(blocks.withColumnRenamed("text", "other"), "block").select("text", "other").distinct().count()
    near = sum(sum(x != y for x, y in zip(a.split()[2:], b.split()[2:], strict=True)) < 2 or edits(a, b) <= 4 for a, b in combinations(names[:400], 2))
    assert met <= len(names) + 2 * 3 * near
