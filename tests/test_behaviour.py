"""As-of joins, series, walks on graphs and running totals against plain versions."""

from __future__ import annotations

import bisect
import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from solstrand.operators.asof import Known, asof_join, asof_joins
from solstrand.operators.graphs import connected, reached
from solstrand.operators.running import running_total, tiled
from solstrand.operators.series import gaps_filled, resampled, rolling_scores

DAY = datetime.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else DAY + datetime.timedelta(minutes=minutes)


def plain_asof(left, right, exact, later, within):
    out = {}
    for row, (key, t) in enumerate(left):
        best = None
        for k, u, tie, v in right:
            if None in (key, t, k, u) or k != key or (u == t and not exact):
                continue
            if (u < t) if later else (u > t):
                continue
            if within is not None and abs(t - u) > within:
                continue
            rank = (-u if later else u, tie, v)
            best = max(best, rank) if best else rank
        out[row] = best and (best[2], abs(best[0]))
    return out


@pytest.mark.parametrize("later", [False, True])
@pytest.mark.parametrize("exact", [False, True])
def test_asof_equals_all_pairs(spark, exact, later):
    """Ties in time, NULL keys and times, a key with most rows, keys without a partner."""
    rng = random.Random(4)
    key = lambda: rng.choice([1, 1, 1, 1, 2, 3, 4, None])
    left = [(key(), rng.choice([None, *[rng.randint(0, 60) for _ in range(9)]])) for _ in range(250)]
    right = [
        (rng.choice([1, 1, 2, 3, 5, None]), rng.choice([None, *[rng.randint(0, 60) for _ in range(9)]]), rng.randint(0, 2), i)
        for i in range(120)
    ]
    lefts = spark.createDataFrame([(i, k, at(t)) for i, (k, t) in enumerate(left)], "row int, k int, t timestamp_ntz")
    rights = spark.createDataFrame([(k, at(t), tie, v) for k, t, tie, v in right], "k int, u timestamp_ntz, tie int, v int")
    for within, minutes in ((None, None), ("7 minutes", 7)):
        got = asof_join(
            lefts, rights, ["k"], "t", "u", {"v": "found", "u": "found_at"}, tie=["tie"], exact=exact, later=later, within=within
        ).collect()
        want = plain_asof(left, right, exact, later, minutes)
        assert {r.row: r.found and (r.found, (r.found_at - DAY).seconds // 60) for r in got} == {
            i: w if w and w[0] else (w and w[0]) for i, w in want.items()
        }
        assert len(got) == len(left)


def test_a_row_is_not_compared_with_every_cut(spark):
    """Cuts are found by halves, at their edges too, without a function called for each cut."""
    from solstrand.operators.asof import _cut_of

    rng = random.Random(6)
    for n in (0, 1, 2, 63):
        minutes = sorted(rng.sample(range(100), n))
        times = [None, *range(-1, 101)]
        rows = spark.createDataFrame([(m, at(m)) for m in times], "m int, t timestamp_ntz")
        placed = rows.select("m", _cut_of(F.col("t"), [at(m) for m in minutes]).alias("cut"))
        assert {r.m: r.cut for r in placed.collect()} == {m: -1 if m is None else bisect.bisect_left(minutes, m) for m in times}
        assert "lambda" not in placed._jdf.queryExecution().optimizedPlan().toString()


def test_asof_with_several_tables_and_empty_ones(spark):
    left = spark.createDataFrame([(1, at(5)), (2, at(5))], "k int, t timestamp_ntz")
    one = spark.createDataFrame([(1, at(4), "a"), (1, at(6), "b")], "k int, u timestamp_ntz, v string")
    none = one.limit(0)
    known = [Known(one, "u", {"v": "first"}), Known(none, "u", {"v": "second"})]
    got = sorted(tuple(r) for r in asof_joins(left, known, ["k"], "t").collect())
    assert got == [(1, at(5), "a", None), (2, at(5), None, None)]
    assert asof_joins(left.limit(0), known, ["k"], "t").collect() == []
    with pytest.raises(ValueError):
        asof_joins(left, [Known(one, "u", {"v": "t"})], ["k"], "t")


def test_a_hot_key_is_worked_off_by_many_tasks(spark):
    """No (key, cut) has more than a small part of a key's rows."""
    rows = spark.range(20000).select(F.lit(1).alias("k"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id)").alias("t"))
    joined = asof_join(rows, rows.withColumn("v", F.lit(1)), ["k"], "t", "t", {"v": "found"}, exact=False)
    assert joined.filter("found IS NULL").count() == 1
    from solstrand.operators.asof import _cut_of, time_cuts

    sizes = rows.groupBy(_cut_of(F.col("t"), time_cuts(rows.select("t")))).count().agg(F.max("count")).first()[0]
    assert sizes < 20000 / 64 * 1.5


def test_series_of_one_reading_and_of_none(spark):
    rows = [(1, at(5), 7), (1, at(200), 1), (2, at(10), 3), (2, at(10), None), (None, at(1), 1), (3, None, 1)]
    readings = spark.createDataFrame(rows, "k int, t timestamp_ntz, v long")
    series = gaps_filled(resampled(readings, "k", "t", F.col("v"), "1 hour"), "k")
    got = sorted((r.k, r.bucket.hour, r.n, r.total, r.carried, r.linear) for r in series.collect())
    assert got == [(1, 0, 1, 7, 7, 7.0), (1, 1, 0, None, 7, 5.0), (1, 2, 0, None, 7, 3.0), (1, 3, 1, 1, 1, 1.0), (2, 0, 1, 3, 3, 3.0)]
    assert gaps_filled(resampled(readings.limit(0), "k", "t", F.col("v"), "1 hour"), "k").collect() == []


def test_scores_do_not_end_at_a_chunk(spark, monkeypatch):
    from solstrand.operators import series as module

    rng = random.Random(2)
    values = [rng.choice([5, 5, rng.randint(0, 50)]) for _ in range(200)]
    rows = [(1, at(60 * i), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k int, bucket timestamp_ntz, v long")
    monkeypatch.setattr(module, "FRAMES_PER_CHUNK", 3)
    got = {r.bucket: r.score for r in rolling_scores(df, "k", "v", 4 * 3600).collect()}
    assert len(got) == 200
    for i, v in enumerate(values):
        frame = values[max(0, i - 4) : i]
        n, s, q = len(frame), sum(frame), sum(x * x for x in frame)
        if n < 2 or n * q == s * s:
            assert got[at(60 * i)] is None
        else:
            assert got[at(60 * i)] == pytest.approx((n * v - s) / math.sqrt(n * q - s * s))


def test_walks_end_in_cycles_and_at_the_limit(spark):
    pairs = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "d"), ("d", "d"), ("b", "c"), ("y", "z"), (None, "q"), ("d", None)]
    edges = spark.createDataFrame(pairs, "src string, dst string")
    seeds = spark.createDataFrame([("a",), ("x",), ("a",), (None,), ("alone",)], "node string")
    got = sorted(tuple(r) for r in reached(edges.filter("src IS NOT NULL AND dst IS NOT NULL"), seeds).collect())
    assert got == [("a", 0, None), ("alone", 0, None), ("b", 1, "a"), ("c", 2, "b"), ("d", 1, "x"), ("x", 0, None)]
    assert {r.node for r in reached(edges, seeds, 1).collect()} == {"a", "x", "alone", "b", "d"}
    assert reached(edges, seeds.limit(0)).collect() == []
    roots = {r.node: r.root for r in connected(edges).collect()}
    assert roots == {"a": "a", "b": "a", "c": "a", "d": "a", "x": "a", "y": "y", "z": "y"}


def test_edges_are_exchanged_once_and_a_crowded_source_is_spread(spark, monkeypatch):
    """Rounds leave the edges in their buckets; the hub's are in none, whatever its share of all edges."""
    from solstrand.operators import graphs as module

    rng = random.Random(5)
    pairs = [("hub", f"n{i}") for i in range(300)] + [(f"n{rng.randrange(400)}", f"n{rng.randrange(400)}") for _ in range(200)]
    pairs += [("start", "hub"), ("n1", "hub"), (None, "n2"), ("n3", None)]
    edges = spark.createDataFrame(pairs * 2, "src string, dst string")
    want, front = {"start": (0, None)}, {"start"}
    for hops in range(1, 5):
        near = {d: min(s for s, e in pairs if e == d and s in front) for s, d in pairs if s in front and d and d not in want}
        want |= {d: (hops, via) for d, via in near.items()}
        front = set(near)
    plans, largest = [], []

    def written(df, label, keep=module.written):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, label)

    def bucketed(df, *how, keep=module.bucketed):
        largest.append(df.groupBy("src").count().agg(F.max("count")).first()[0])
        return keep(df, *how)

    monkeypatch.setattr(module, "written", written)
    monkeypatch.setattr(module, "bucketed", bucketed)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for crowded in (256, 8):
            monkeypatch.setattr(module, "CROWDED", crowded)
            got = reached(edges, spark.createDataFrame([("start",)], "node string"), 4).collect()
            assert {r.node: (r.hops, r.via) for r in got} == want and len(got) == len(want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    rounds = [p for p in plans if "LeftAnti" in p]
    assert len(rounds) >= 6 and not any("hashpartitioning(src" in p for p in rounds)
    assert largest and max(largest) * 8 <= 2 * len(pairs)
    assert reached(edges.limit(0), spark.createDataFrame([("start",)], "node string")).collect() == [("start", 0, None)]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("edges_")]


def test_long_chains_are_one_component(spark):
    order = list(range(300))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:], strict=False)), "src int, dst int")
    assert {r.root for r in connected(edges).collect()} == {0}


def test_running_totals_and_tiles(spark, tmp_path, monkeypatch):
    from solstrand.operators import running as module

    rng = random.Random(3)
    rows = [(i, rng.choice([7, 7, 7, rng.randint(0, 100), None])) for i in range(500)]
    spark.createDataFrame(rows, "id int, v long").repartition(7).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    monkeypatch.setattr(module, "LEAST_BLOCK", 64)
    got = running_total(df, [F.col("v").desc_nulls_last(), F.col("id")], "v", "up_to").collect()
    total = 0
    for r, (i, v) in zip(sorted(got, key=lambda r: r["rank"]), sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0])), strict=True):
        total += v or 0
        assert (r.id, r.v, r.up_to) == (i, v, total)
    df.createOrReplaceTempView("to_tile")
    for tiles in (1, 3, 7, 500, 501):
        mine = {r.id: r.t for r in tiled(df, [F.col("id")], tiles, "t").collect()}
        assert mine == {r.id: r.t for r in spark.sql(f"SELECT id, ntile({tiles}) OVER (ORDER BY id) AS t FROM to_tile").collect()}
    assert running_total(df.limit(0), [F.col("id")], "v", "up_to").collect() == []
