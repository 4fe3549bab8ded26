"""SimHash fingerprints and their components against plain versions."""

from __future__ import annotations

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from solstrand.llm import queries, simhash
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = brute.word_list(text, lower=True)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    if words and not shingles:
        shingles = [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    """The least index reachable over links of three bits or fewer, for each of a list of numbers."""
    numbers, to = np.array(fps, np.uint64), list(range(len(fps)))

    def root(x):
        while to[x] != x:
            to[x] = to[to[x]]
            x = to[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(numbers[i + 1 :] ^ numbers[i]) <= 3).tolist():
            a, b = root(i), root(i + 1 + j)
            to[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def assert_components(df, rows):
    """`rows` are (doc_id, text) with ids in order."""
    got = sorted(tuple(r) for r in simhash.simhash_components(df).collect())
    fps = [plain_fingerprint(t) for _, t in rows]
    of = plain_components(fps)
    assert got == [(d, f"{f:016x}", rows[c][0]) for (d, _), f, c in zip(rows, fps, of, strict=True)]
    return of


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in df.collect())
    of = assert_components(df, rows)
    assert len(set(of)) < len(rows)
    query = queries.queries()["op13_simhash_components"](spark, SF)
    assert query.dtypes == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")]


def test_texts_with_few_or_no_words(spark):
    texts = [None, "", "  \n", "one", "ONE", "one two", "one\ttwo", "one two three", "É one", "é one", "x " * 5000]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit(1))
    of = assert_components(df.repartition(3), rows)
    assert of[1] == of[2] == 0 and of[4] == 3 and of[8] != of[9]


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 40)
    monkeypatch.setattr(simhash, "COUNTED", 7)
    rng = random.Random(1)
    rows = [(i, rng.choice([" ", ""]).join(rng.choice(["ab ", "C\n", "déf ", "x" * 60]) for _ in range(i))) for i in range(60)]
    assert_components(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_repeated_and_missing_ids(spark):
    rows = [(None, "some words of a text"), (None, "some words of a text"), (7, "quite another one here"), (7, "quite another one here"), (3, "quite another one here")]
    got = simhash.simhash_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 5
    assert {(r.doc_id, r.component_id) for r in got} == {(None, None), (7, 3), (3, 3)}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_components(empty).collect() == []


def near_numbers():
    """Random fingerprints, chains of near ones, and values that very many share in one half or more."""
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for c in sorted(fps)[:40]:
        for _ in range(20):
            y = c
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 4])):
                y ^= 1 << b
            fps.add(y)
            c = rng.choice([c, y])
    hot = rng.getrandbits(64)
    fps |= {hot & ~0xFFFFFFFF | rng.getrandbits(32) for _ in range(900)}
    fps |= {hot & ~0xFFFF | rng.getrandbits(16) for _ in range(900)}
    fps |= {(hot ^ 1 << 40) & ~0xFFFFFFFF | hot & 0xFFFF | rng.getrandbits(16) << 16 for _ in range(400)}
    return sorted(fps | {0, (1 << 64) - 1, 7, 1 << 63})


def test_links_of_crowded_values(spark, monkeypatch):
    fps = near_numbers()
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    place = {signed(f): i for i, f in enumerate(fps)}
    want = plain_components(fps)
    for crowded in (256, 8):  # 8: values are looked up again at every level
        monkeypatch.setattr(simhash, "CROWDED", crowded)
        edges = simhash.fingerprint_links(df).collect()
        assert all(bin(fps[place[e.a]] ^ fps[place[e.b]]).count("1") for e in edges)
        to = list(range(len(fps)))
        for _ in range(len(fps)):
            moved = False
            for e in edges:
                low = min(to[place[e.a]], to[place[e.b]])
                moved |= to[place[e.a]] != low or to[place[e.b]] != low
                to[place[e.a]] = to[place[e.b]] = low
            if not moved:
                break
        assert to == want
        # A forest for each batch: far fewer edges than pairs.
        assert len(edges) < 3 * len(fps)


def test_questions_are_not_broadcast(spark, monkeypatch):
    """However small the fingerprints, the questions made of them are many times as many."""
    plans, kept = [], simhash.written

    def seen(df, label):
        if label == "near":
            plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return kept(df, label)

    monkeypatch.setattr(simhash, "written", seen)
    rows = kept(spark.createDataFrame([(signed(f),) for f in near_numbers()[:200]], "fp long"), "fps")
    simhash.fingerprint_links(rows)
    assert plans and all("SortMergeJoin" in p and "BroadcastHashJoin" not in p for p in plans)
