"""Whitening against a dense eigendecomposition, and its odd rows."""

from __future__ import annotations

import numpy as np
import pytest

from solstrand.llm import queries
from solstrand.llm.whitening import fit_whitening, identity_error, solved, usable, whitened, whitening_digest

SCHEMA = "vec_id long, embedding array<float>"


def plain(vectors):
    """n, deviations, centred rows, variances and axes by falling variance, of lists of floats."""
    x = [[int(np.floor(1024 * float(c))) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(column) for column in zip(*x, strict=True)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums, strict=True)] for v in x])
    _, singular, right = np.linalg.svd(centred, full_matrices=False)
    return n, deviations, centred, singular**2 / n, right.T


def assert_equals_plain(rows, ids, vectors, k):
    n, deviations, centred, values, axes = plain(vectors)
    assert len(rows) == k * n and {r.n for r in rows} == {n}
    want = centred @ axes[:, :k] / np.sqrt(values[:k])
    got = {(r.vec_id, r.component): r for r in rows}
    for j in range(k):
        mine = np.array([got[i, j + 1].whitened for i in ids])
        sign = np.sign(mine @ want[:, j])
        assert np.abs(sign * mine - want[:, j]).max() < 1e-8
        assert abs(rows[0].identity_error) < 1e-10
        shares = {r.explained for r in rows if r.component == j + 1}
        assert len(shares) == 1 and abs(shares.pop() / (values[j] / values.sum()) - 1) < 1e-9
    assert [got[i, 1].deviation for i in ids] == deviations


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    rows = queries.queries()["op11_shifted_cholesky_whitening"](spark, "/root/testdata/sf0.01").collect()
    assert_equals_plain(rows, [r.vec_id for r in table], [r.embedding for r in table], 8)


@pytest.mark.parametrize("spread", [1.0, 1e-4])
def test_badly_conditioned_rows(spark, spread):
    """Columns of very different spread, an axis nearly along another, over several tasks."""
    rng = np.random.default_rng(1)
    data = rng.normal(size=(400, 5)) * [1000, 100, 10, 1, 1]
    data[:, 4] = data[:, 0] + spread * data[:, 4]
    vectors = data.astype(np.float32).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), SCHEMA).repartition(6)
    model = fit_whitening(df, k=5)
    n, _, centred, values, axes = plain(vectors)
    assert np.allclose(model.variances, values, rtol=1e-8)
    assert np.abs(np.abs((model.components * axes).sum(0)) - 1).max() < 1e-6
    assert identity_error(df, model) < 1e-6 and model.passes <= 5


def test_rows_without_spread_in_some_directions(spark):
    rng = np.random.default_rng(2)
    flat = rng.normal(size=(50, 2))
    data = np.column_stack([flat[:, 0], flat[:, 1], np.full(50, 7.0), np.full(50, -1e4)])
    vectors = (np.round(data * 1024) / 1024).tolist()  # a third column that repeats the first one's steps
    vectors = [[*v, 2 * v[0]] for v in vectors]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    rows = whitening_digest(df).collect()
    assert_equals_plain(rows, list(range(50)), vectors, 2)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(size=3).astype(np.float32).tolist()) for i in range(20)]
    same = [(1, good[1][1])] * 15 + [(None, good[2][1])]
    bad = [
        (100, None),
        (101, []),
        (102, [1.0, None, 2.0]),
        (103, [1.0, float("nan"), 2.0]),
        (104, [1.0, float("inf"), 2.0]),
        (105, [float("-inf")] * 3),
        (106, [1.0, 2.0]),
        (107, [1.0, 2.0, 3.0, 4.0]),
        (108, [1.0, 2.0**60, 2.0]),
    ]
    df = spark.createDataFrame([*good, *same, *bad], SCHEMA).repartition(3)
    rows = whitening_digest(df).collect()
    counted = [*good, *same]
    assert {r.vec_id for r in rows} == {i for i, _ in counted} and len(rows) == 3 * len(counted)
    n, deviations, *_ = plain([v for _, v in counted])
    assert {r.n for r in rows} == {n}
    assert sorted(r.deviation for r in rows) == sorted(deviations * 3)
    assert rows[0].identity_error < 1e-12
    whole = {r.whitened for r in rows if r.vec_id == 1 and r.component == 1}
    assert len(whole) == 1


def test_no_rows_no_spread(spark):
    empty = spark.createDataFrame([], SCHEMA)
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 9):
        got = whitening_digest(spark.createDataFrame(rows, SCHEMA))
        assert got.columns == columns and got.collect() == []
    assert usable(empty)[1:] == (0, 0)


def test_own_columns_stay_and_far_entries_are_exact(spark):
    rows = [(i, [float(i * 2**45), 1.0], "mine", i) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, whitened string, deviation int")
    got = whitened(df, fit_whitening(df)).collect()
    _, deviations, *_ = plain([v for _, v, *_ in rows])
    for r in got:
        assert (r.whitened, r.deviation) == ("mine", r.vec_id)
        assert int(r._deviation) == deviations[r.vec_id] and len(r._whitened) == 1
    # Beyond a long the digest has no value.
    assert {r.deviation for r in whitening_digest(df.drop("whitened", "deviation")).collect()} == {None}


def test_triangular_solve():
    rng = np.random.default_rng(4)
    r = np.triu(rng.normal(size=(6, 6))) + 5 * np.eye(6)
    x = rng.normal(size=(9, 6))
    assert np.allclose(solved(x, r) @ r, x)
