"""Model enrichment of rows: prompt, answer, typed struct, contract.

A scorer turns a prompt column into a column of JSON answers.  Rule scorers are plain column
expressions; `python_scorer` wraps any batch function, a remote model's client for example.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solstrand.functions.grid import cell
from solstrand.operators.quality import Rule
from solstrand.sources.schemas import ANALYSIS_FIELDS, ddl

Scorer = Callable[[Column], Column]

# Answer field -> column of the enriched row.
ANALYSIS_COLUMNS = {
    "ai_language": "language",
    "ai_summary": "summary",
    "ai_country": "country",
    "ai_city": "city",
    "ai_state": "state_iso3166_2",
    "ai_latitude": "latitude",
    "ai_longitude": "longitude",
    "ai_wikidataID": "wikidataID",
}

_ARTICLE_TASK = (
    "Name the language of the article below, sum it up in that language, and name the country and "
    "the one city it concerns most, with the city's region code, coordinates and Wikidata id. "
    "Answer with one JSON object only.\nTitle: "
)


def python_scorer(answer: Callable[[pd.Series], pd.Series]) -> Scorer:
    """A scorer from a function of a batch of prompts.

    Only the prompt column travels to Python, in Arrow batches; the other columns of the row stay
    in the JVM.  Marked non-deterministic, so the planner never repeats the call to serve two
    columns of the answer.  NULL prompts are answered with NULL without asking.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for prompts in batches:
            asked = prompts.dropna()
            answers = pd.Series([None] * len(prompts), index=prompts.index, dtype=object)
            if len(asked):
                # By position: one answer per prompt, whatever index the function gives them.
                answers[asked.index] = list(answer(asked))
            yield answers

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    scorer = F.pandas_udf(run, "string").asNondeterministic()
    return lambda prompt: scorer(prompt)


def article_prompt(title: Column, description: Column) -> Column:
    """NULL if the title or the description is."""
    return F.concat(F.lit(_ARTICLE_TASK), title, F.lit("\nDescription: "), description)


def pending(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The rows whose key has no answer yet, so that a re-run asks for new rows only."""
    return rows.join(done.select(key), key, "left_anti")


def answered(rows: DataFrame, prompt: Column, scorer: Scorer, schema: str, name: str) -> DataFrame:
    """The answer as JSON text `<name>_json` and as a typed struct `name`.

    The struct comes out of a generator over one element.  Fields of an expression would each be
    parsed anew by whatever uses them; a generated column is parsed once for each row.
    """
    raw = f"{name}_json"
    asked = rows.withColumn(raw, scorer(prompt))
    return asked.withColumn(name, F.explode(F.array(F.from_json(raw, schema))))


def analysed(articles: DataFrame, scorer: Scorer) -> DataFrame:
    """Articles with the model's answer `ai_analysis`, its fields as `ai_*`, and the finest cell."""
    prompt = article_prompt(F.col("title"), F.col("description"))
    rows = answered(articles, prompt, scorer, ddl(ANALYSIS_FIELDS), "ai_analysis")
    fields = {c: F.col(f"ai_analysis.{f}") for c, f in ANALYSIS_COLUMNS.items()}
    place = cell(F.col("ai_analysis.longitude"), F.col("ai_analysis.latitude"))
    return rows.withColumns({**fields, "ai_cell_res_15": place}).drop("ai_analysis_json")


def contract_rules(raw: Column, parsed: Column, fields: Mapping[str, str] | Sequence[str]) -> list[Rule]:
    """An answer must be a JSON object with exactly the given fields, each of its type."""
    wanted = F.array(*[F.lit(f) for f in fields])
    keys = F.json_object_keys(raw)
    typed = F.lit(True)
    for field in fields:
        typed &= parsed.getField(field).isNotNull()
    return [
        Rule("answer is a JSON object", keys.isNotNull()),
        Rule("no field is missing", F.size(F.array_except(wanted, keys)) == 0),
        Rule("no other field", F.size(F.array_except(keys, wanted)) == 0),
        Rule("every field has its type", typed),
    ]


def accepted(rows: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep the contract, and the others."""
    ok = F.lit(True)
    for rule in rules:
        ok &= rule.kept
    return rows.filter(ok), rows.filter(~ok)
