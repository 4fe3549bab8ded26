from __future__ import annotations

import json
import os
import subprocess
import sys

import pandas as pd
import pytest
from pyspark.sql import functions as F

from solstrand.operators import enrich
from solstrand.operators.quality import expectation_counts
from solstrand.sources.schemas import ANALYSIS_FIELDS, ddl

GOOD = {
    "language": "Italian", "summary": "s", "country": "Italy", "city": "Rome",
    "state_iso3166_2": "IT-62", "latitude": 41.875, "longitude": 12.5, "wikidataID": "Q220",
}


def answer_good(prompts: pd.Series) -> pd.Series:
    return prompts.map(lambda p: json.dumps({**GOOD, "summary": str(len(p))}))


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [(1, "T", "D"), (2, None, "D"), (3, "T", None), (4, "long title", "")],
        "id long, title string, description string",
    )


def test_answer_becomes_columns(rows):
    got = {r["id"]: r for r in enrich.analysed(rows, enrich.python_scorer(answer_good)).collect()}
    assert got[1]["ai_city"] == "Rome" and got[1]["ai_latitude"] == 41.875
    assert got[1]["ai_cell_res_15"] is not None
    assert int(got[4]["ai_summary"]) == int(got[1]["ai_summary"]) + len("long title") - 2
    # No prompt, no question, no answer.
    for i in (2, 3):
        assert got[i]["ai_analysis"] is None and got[i]["ai_language"] is None
        assert got[i]["ai_cell_res_15"] is None


def test_each_prompt_is_asked_once(rows, spark):
    asked = spark.sparkContext.accumulator(0)

    def counting(prompts: pd.Series) -> pd.Series:
        asked.add(len(prompts))
        return answer_good(prompts)

    enrich.analysed(rows, enrich.python_scorer(counting)).collect()
    assert asked.value == 2


def test_answers_go_by_position(spark):
    df = spark.createDataFrame([(i, f"p{i}" if i % 3 else None) for i in range(30)], "i int, p string")
    scorer = enrich.python_scorer(lambda prompts: pd.Series([f"<{p}>" for p in prompts]))
    got = df.select("i", scorer(F.col("p")).alias("a")).collect()
    assert {r["i"]: r["a"] for r in got} == {i: f"<p{i}>" if i % 3 else None for i in range(30)}


def test_the_rule_scorer_needs_no_package_on_the_executors(tmp_path):
    """Unpickled where this package cannot be imported, as on a worker."""
    from pyspark import cloudpickle

    from solstrand.plans.messages import python_article_scorer

    scorer = python_article_scorer()
    udf = next(c.cell_contents for c in scorer.__closure__)
    (tmp_path / "f.pkl").write_bytes(cloudpickle.dumps(udf.func))
    script = (
        "import importlib.util, pickle, pandas as pd\n"
        "assert importlib.util.find_spec('solstrand') is None\n"
        "f = pickle.load(open('f.pkl', 'rb'))\n"
        "out = next(f(iter([pd.Series(['x\\nTitle: a der b und c', None])])))\n"
        "print(out[0], out[1])\n"
    )
    done = subprocess.run(
        [sys.executable, "-I", "-c", script],
        cwd=tmp_path,
        env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"},
        capture_output=True,
        text=True,
        timeout=120,
    )
    assert '"Berlin"' in done.stdout and done.stdout.strip().endswith("None"), done.stderr


def test_a_rerun_asks_for_new_rows_only(rows, spark):
    done = spark.createDataFrame([(1,), (3,)], "id long")
    assert sorted(r["id"] for r in enrich.pending(rows, done, "id").collect()) == [2, 4]


def test_contract(spark):
    missing = {k: v for k, v in GOOD.items() if k != "city"}
    answers = [
        json.dumps(GOOD),
        json.dumps(missing),
        json.dumps({**GOOD, "note": 1}),
        json.dumps({**GOOD, "latitude": "north"}),
        "sorry, no",
        json.dumps([GOOD]),
        None,
    ]
    df = spark.createDataFrame([(a,) for a in answers], "raw string").withColumn(
        "parsed", F.from_json("raw", ddl(ANALYSIS_FIELDS))
    )
    rules = enrich.contract_rules(F.col("raw"), F.col("parsed"), ANALYSIS_FIELDS)
    failed = {r["rule"]: r["failed"] for r in expectation_counts(df, rules).collect()}
    assert failed == {
        "answer is a JSON object": 3,
        "no field is missing": 4,
        "no other field": 4,
        "every field has its type": 5,
    }
    good, bad = enrich.accepted(df, rules)
    assert [r["raw"] for r in good.collect()] == [answers[0]] and bad.count() == 6
