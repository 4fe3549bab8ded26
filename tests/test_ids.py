from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from solstrand.operators.ids import numbered


def rows_with_a_hot_key(n: int = 600) -> list[tuple]:
    rng = random.Random(7)
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.34:
            rows.append(("hot", "same", 0))  # a third of all rows are equal copies
        elif kind < 0.4:
            rows.append((None, f"n{rng.randrange(5)}", i))
        else:
            rows.append((f"u{rng.randrange(200):03}", f"g{rng.randrange(3)}", i))
    return rows


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(
        rows_with_a_hot_key(), "url string, feed string, n int"
    ).repartition(7)


def test_numbers_are_the_global_row_numbers(frame):
    got = numbered(frame, [F.col("url"), F.col("n")]).orderBy("id").collect()
    want = sorted(
        rows_with_a_hot_key(), key=lambda r: (r[0] is not None, r[0] or "", r[2])
    )
    assert [r["id"] for r in got] == list(range(1, len(want) + 1))
    assert [(r["url"], r["n"]) for r in got] == [(w[0], w[2]) for w in want]


def test_numbers_restart_per_group(frame):
    got = numbered(frame, [F.col("url"), F.col("n")], "rank", group="feed").collect()
    by_feed: dict[str, list] = {}
    for r in got:
        by_feed.setdefault(r["feed"], []).append(r)
    for rows in by_feed.values():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
        keys = [(r["url"] is not None, r["url"] or "", r["n"]) for r in rows]
        assert keys == sorted(keys)


def test_a_null_group_is_numbered_too(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 5)], "g string, n int")
    got = {(r["g"], r["n"]): r["k"] for r in numbered(df, [F.col("n")], "k", group="g").collect()}
    assert got == {(None, 1): 1, (None, 2): 2, ("a", 5): 1}


def test_copies_are_spread_over_tasks(spark):
    """Equal rows do not end up in one task."""
    copies = spark.range(0, 4000, 1, 8).select(F.lit("hot").alias("url"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fixed = numbered(copies, [F.col("url")])
        assert fixed.agg(F.count_distinct("id"), F.max("id"), F.min("id")).first()[:] == (
            4000,
            4000,
            1,
        )
        files = {f for f in fixed.inputFiles() if "numbered-" in f}
        assert len(files) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_numbers_repeat_from_run_to_run(frame):
    def run():
        return sorted(map(tuple, numbered(frame, [F.col("url")]).collect()), key=lambda r: r[0])

    assert run() == run()


def test_empty(spark):
    df = spark.createDataFrame([], "url string")
    assert numbered(df, [F.col("url")]).count() == 0


def test_a_taken_name(spark):
    with pytest.raises(ValueError):
        numbered(spark.range(3), [F.col("id")], "id")
