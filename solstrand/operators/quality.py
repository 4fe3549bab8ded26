"""Row expectations: count, drop or refuse rows that break a rule."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from solstrand.functions.text import is_email


@dataclass(frozen=True, eq=False)
class Rule:
    """`holds` must be TRUE; FALSE and NULL both break the rule."""

    name: str
    holds: Column
    action: str = "warn"

    def __post_init__(self) -> None:
        if self.action not in ("warn", "drop", "fail"):
            raise ValueError(f"{self.name}: action must be warn, drop or fail")

    @property
    def kept(self) -> Column:
        return F.coalesce(self.holds, F.lit(False))


def expect(df: DataFrame, rules: Sequence[Rule], counts: Observation | str | None = None) -> DataFrame:
    """Apply the rules: warn keeps the row, drop removes it, fail stops the job.

    With `counts`, rows seen and rows breaking each rule are counted on the way, without a second
    pass; a stream reports them in its progress under that name.
    """
    if counts is not None:
        broken = [F.count_if(~r.kept).alias(r.name) for r in rules]
        df = df.observe(counts, F.count(F.lit(1)).alias("rows"), *broken)
    for rule in rules:
        if rule.action == "drop":
            df = df.filter(rule.kept)
        elif rule.action == "fail":
            stop = F.raise_error(f"rule broken: {rule.name}").cast("boolean")
            df = df.filter(F.when(rule.kept, F.lit(True)).otherwise(stop))
    return df


def with_flags(df: DataFrame, rules: Sequence[Rule], name: str = "broken_rules") -> DataFrame:
    """The names of the rules each row breaks, as an array."""
    marks = [F.when(~r.kept, F.lit(r.name)) for r in rules]
    return df.withColumn(name, F.array_compact(F.array(*marks)))


def expectation_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with passed and failed rows: one pass, partial counts per task."""
    totals = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(r.kept).alias(f"_{i}") for i, r in enumerate(rules)],
    )
    entries = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.col(f"_{i}").alias("passed"),
            (F.col("_rows") - F.col(f"_{i}")).alias("failed"),
        )
        for i, r in enumerate(rules)
    ]
    return totals.select(F.inline(F.array(*entries)))


def email_report(df: DataFrame, value: str, *by: str) -> DataFrame:
    """Rows with a valid and an invalid e-mail format in column `value`, per group."""
    return df.groupBy(*by, is_email(F.col(value)).alias("is_valid")).agg(F.count("*").alias("n"))
