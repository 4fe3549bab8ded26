from __future__ import annotations

import random
from collections import Counter

import pytest

from solstrand.operators.snapshots import snapshot_changes

SCHEMA = "k long, a string, b string"


def brute_force(old: list[tuple], new: list[tuple]) -> Counter:
    gone, came = Counter(old) - Counter(new), Counter(new) - Counter(old)
    out: Counter = Counter()
    left, arrived = {r[0] for r in gone}, {r[0] for r in came}
    for rows, single, image, other in (
        (gone, "delete", "update_preimage", arrived),
        (came, "insert", "update_postimage", left),
    ):
        for row, n in rows.items():
            out[(image if row[0] in other else single, n, *row)] += 1
    return out


def changes(spark, old, new) -> Counter:
    got = snapshot_changes(spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA), "k")
    return Counter(tuple(r) for r in got.collect())


def test_kinds(spark):
    old = [(1, "a", "x"), (2, "b", "x"), (3, "c", "x")]
    new = [(1, "a", "x"), (2, "B", "x"), (4, "d", "x")]
    assert changes(spark, old, new) == Counter(
        [
            ("update_preimage", 1, 2, "b", "x"),
            ("update_postimage", 1, 2, "B", "x"),
            ("delete", 1, 3, "c", "x"),
            ("insert", 1, 4, "d", "x"),
        ]
    )


def test_a_value_that_moves_to_the_next_column_is_a_change(spark):
    assert len(changes(spark, [(1, "v", None)], [(1, None, "v")])) == 2


@pytest.mark.parametrize("seed", range(3))
def test_brute_force_with_repeated_and_missing_keys(spark, seed):
    rng = random.Random(seed)

    def rows(n):
        hot = [(5, "h", None)] * (n // 3 + rng.randrange(3))
        return hot + [
            (rng.choice([None, *range(12)]), rng.choice("ab"), rng.choice(["x", None]))
            for _ in range(n)
        ]

    old, new = rows(60), rows(60)
    assert changes(spark, old, new) == brute_force(old, new)


def test_equal_snapshots(spark):
    rows = [(1, "a", None), (1, "a", None)]
    assert not changes(spark, rows, list(reversed(rows)))


def test_columns_must_agree(spark):
    a = spark.createDataFrame([(1,)], "k long")
    with pytest.raises(ValueError):
        snapshot_changes(a, spark.createDataFrame([(1, 2)], "k long, z int"), "k")
