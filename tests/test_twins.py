"""Every registered query against its SQL twin on the stored tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as spark_entry
from tests.compare import compare, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


# Every pair of rows, and rows one by one through Python: no query may plan these.
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "MapInPandas"]


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query_equals_its_twin(spark, con, name):
    df = spark_entry.queries()[name](spark, SF_DIR)
    _, problem = compare(spark, con, lambda *_: df, spark_entry.oracle_sql()[name], SF_DIR)
    assert not problem
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [step for step in UNWANTED if step in plan]


def test_the_comparison_sees_a_difference(spark, con):
    query = spark_entry.queries()["feed_row_count"]
    _, problem = compare(spark, con, query, "SELECT count(*) + 1 AS n FROM pages", SF_DIR)
    assert problem


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns == spark_entry.entry(spark).columns
    assert df.count() > 0


def test_answers_are_not_parsed_for_each_field(spark):
    from solstrand import plans

    for name in ("survey_rows", "survey_options"):
        df = plans.queries()[name](spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        # Message, analysis, news input and answer; no parse for each field used.
        assert plan.count("from_json(") <= 5, name
        # Each marker word is counted once for each text.
        assert plan.count("replace(") <= 8, name
