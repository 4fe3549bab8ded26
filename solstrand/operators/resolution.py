"""Records of one person found by the evidence of their fields.

Records are compared if they share a block, a combination of fields.  Each field on which two records agree
counts by how rare the value is, log2(m / u): m is how often it agrees for one person, u the share of records
that have the value.  A field on which they differ counts log2((1 - m) / (1 - u)) with the field's chance
u of agreement; a missing one counts nothing.  Text that agrees but for a few typos counts half.  Pairs above the threshold are links, and linked records are one.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solstrand.operators.graphs import connected
from solstrand.sinks.scratch import written

#: Records of a block that one task compares with others.
PART = 1000


class Field(NamedTuple):
    name: str
    agrees: float  # for one person's records
    typos: int = 0  # edits within which text counts half


def evidence(records: DataFrame, key: str, fields: Sequence[Field], blocks: Sequence[Sequence[str]]) -> DataFrame:
    """(a, b, weight): the pairs of records, a < b, that share a block, with what their fields say.

    A block in which a field is NULL pairs nothing.  Of two values that differ in typos the rarer one counts.
    """
    total = records.count()
    known = records
    chance = {}
    for field in fields:
        shares = records.filter(F.col(field.name).isNotNull()).groupBy(field.name).agg((F.count("*") / total).alias(f"u_{field.name}"))
        shares = written(shares, "shares")
        known = known.join(shares, field.name, "left")
        chance[field.name] = shares.agg(F.sum(F.col(f"u_{field.name}") * F.col(f"u_{field.name}"))).first()[0] or 0.0
    known = written(known, "records")
    keyed = None
    for i, names in enumerate(blocks):
        there = F.lit(True)
        for name in names:
            there &= F.col(name).isNotNull()
        rows = known.filter(there).select(F.struct("*").alias("r"), F.xxhash64(F.lit(i), *names).alias("block"))
        keyed = keyed.unionByName(rows) if keyed else rows
    parts = keyed.groupBy("block").agg(F.ceil(F.count("*") / PART).alias("parts")).filter("block IS NOT NULL")
    placed = written(keyed.join(parts, "block"), "blocks")
    left = placed.select(F.col("r").alias("x"), "block", F.explode(F.sequence(F.lit(1), F.col("parts"))).alias("part"))
    right = placed.select(F.col("r").alias("y"), "block", (F.pmod(F.xxhash64(f"r.{key}"), F.col("parts")) + 1).alias("part"))
    pairs = left.join(right, ["block", "part"]).filter(F.col(f"x.{key}") < F.col(f"y.{key}"))

    def weight(field: Field) -> Column:
        x, y = F.col(f"x.{field.name}"), F.col(f"y.{field.name}")
        u = F.least(F.col(f"x.u_{field.name}"), F.col(f"y.u_{field.name}"))
        against = F.log2(F.lit((1 - field.agrees) / (1 - min(chance[field.name], 0.999999))))
        full = F.log2(F.lit(field.agrees) / u)
        found = F.when(x.isNull() | y.isNull(), 0.0).when(x == y, full)
        if field.typos:
            found = found.when(F.levenshtein(x, y, field.typos) >= 0, full / 2)
        return found.otherwise(against)

    weights = [weight(f) for f in fields]
    total_weight = weights[0]
    for w in weights[1:]:
        total_weight = total_weight + w
    return pairs.select(F.col(f"x.{key}").alias("a"), F.col(f"y.{key}").alias("b"), total_weight.alias("weight")).distinct()


def resolved(
    records: DataFrame, key: str, fields: Sequence[Field], blocks: Sequence[Sequence[str]], threshold: float
) -> DataFrame:
    """(key, entity): the least key of the records that links lead to; a record without links is its own."""
    links = evidence(records, key, fields, blocks).filter(F.col("weight") >= threshold)
    roots = connected(written(links.select(F.col("a").alias("src"), F.col("b").alias("dst")), "links"))
    return records.select(key).join(roots, F.col(key) == F.col("node"), "left").select(key, F.coalesce("root", key).alias("entity"))
