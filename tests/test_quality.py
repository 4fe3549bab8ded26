from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from solstrand.operators.quality import Rule, email_report, expect, expectation_counts, with_flags


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(1, "a"), (2, None), (None, "c"), (-4, "d")], "n int, s string")


def rules(action: str = "warn") -> list[Rule]:
    return [Rule("positive", F.col("n") > 0, action), Rule("named", F.col("s").isNotNull())]


def test_warn_keeps_the_rows_and_counts(rows):
    seen = Observation()
    assert expect(rows, rules(), seen).count() == 4
    assert seen.get == {"rows": 4, "positive": 2, "named": 1}


def test_drop_removes_false_and_null(rows):
    seen = Observation()
    kept = expect(rows, rules("drop"), seen).collect()
    assert sorted(r["n"] for r in kept) == [1, 2]
    assert seen.get["rows"] == 4


def test_fail_stops_the_job(rows):
    with pytest.raises(PySparkException, match="rule broken: positive"):
        expect(rows, rules("fail")).collect()
    assert expect(rows.filter("n > 0"), rules("fail")).count() == 2


def test_unknown_action():
    with pytest.raises(ValueError):
        Rule("x", None, "ignore")


def test_counts(rows):
    got = {r["rule"]: (r["passed"], r["failed"]) for r in expectation_counts(rows, rules()).collect()}
    assert got == {"positive": (2, 2), "named": (3, 1)}
    none = expectation_counts(rows.limit(0), rules()).collect()
    assert {(r["passed"], r["failed"]) for r in none} == {(0, 0)}


def test_flags(rows):
    got = {r["n"]: r["broken_rules"] for r in with_flags(rows, rules()).collect()}
    assert got == {1: [], 2: ["named"], None: ["positive"], -4: ["positive"]}


def test_email_report(spark):
    df = spark.createDataFrame([("x", "a@b.co"), ("x", None), ("y", "a@b")], "g string, m string")
    got = {(r["g"], r["is_valid"]): r["n"] for r in email_report(df, "m", "g").collect()}
    assert got == {("x", True): 1, ("x", False): 1, ("y", False): 1}
