"""Which channels lead to conversions: credit by place in the path, and by taking a channel away."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solstrand.operators.asof import asof_join
from solstrand.operators.ids import numbered
from solstrand.sinks.scratch import written

#: Channels whose matrix the driver solves.
MOST_CHANNELS = 1000


def steps(touches: DataFrame, who: str, order: list[Column], channel: str, converts: Column) -> DataFrame:
    """(step, who, channel, converts, opens): the touches numbered over all users, in order.

    A path is what one user does up to a conversion, that included, or to the end; its first touch `opens`
    it.  The whole table is numbered in ranges and each row meets the one before by number, so no task
    sorts all touches of a user.  `touches` must be stored rows.
    """
    ordered = [o.alias(f"o{i}") for i, o in enumerate(order)]
    slim = touches.select(F.col(who).alias("who"), *ordered, F.col(channel).alias("channel"), converts.alias("converts"))
    by = [F.col("who"), *[F.col(f"o{i}") for i in range(len(order))]]
    at = written(numbered(slim, by, "step"), "steps")
    before = at.select(
        (F.col("step") + 1).alias("step"),
        F.col("who").alias("who_before"),
        F.col("converts").alias("after_conversion"),
    )
    joined = at.join(before, "step", "left")
    opens = F.coalesce(F.col("who") != F.col("who_before"), F.lit(True)) | F.col("after_conversion")
    return joined.select("step", "who", "channel", "converts", opens.alias("opens"))


def transitions(stepped: DataFrame) -> DataFrame:
    """(source, target, n): how often a channel follows another; `(start)`, `(sale)` and `(none)` are the ends."""
    following = stepped.select(
        (F.col("step") - 1).alias("step"),
        F.col("channel").alias("next"),
        F.col("converts").alias("sells"),
        F.col("opens").alias("next_opens"),
    )
    moves = stepped.filter("NOT converts").select("step", "channel").join(following, "step", "left")
    ends = F.coalesce(F.col("next_opens"), F.lit(True))
    target = F.when(ends, "(none)").when(F.col("sells"), "(sale)").otherwise(F.col("next"))
    inner = moves.select(F.col("channel").alias("source"), target.alias("target"))
    opened = F.when(F.col("converts"), "(sale)").otherwise(F.col("channel"))
    first = stepped.filter("opens").select(F.lit("(start)").alias("source"), opened.alias("target"))
    return inner.unionByName(first).groupBy("source", "target").agg(F.count("*").alias("n"))


def position_credit(stepped: DataFrame) -> DataFrame:
    """(channel, first, last, linear, n_paths) over the paths that end in a conversion after a touch.

    `linear` shares each conversion among the touches of its path.
    """
    starts = stepped.filter("opens").select("who", F.col("step").alias("path"))
    # Each touch belongs to the last start up to it; starts and touches are cut in the same ranges.
    placed = asof_join(stepped.drop("opens"), starts, ["who"], "step", "path", {"path": "path"})
    sold = placed.filter("converts").select("path")
    touched = placed.filter("NOT converts").join(sold, "path", "left_semi")
    per_path = touched.groupBy("path").agg(F.count("*").alias("m"), F.min("step").alias("a"), F.max("step").alias("z"))
    rows = touched.join(per_path, "path")
    # Touches of equally long paths are counted together, so sums are of few numbers, in order.
    by_length = rows.groupBy("channel", "m").agg(
        F.count("*").alias("n"),
        F.sum((F.col("step") == F.col("a")).cast("int")).alias("first"),
        F.sum((F.col("step") == F.col("z")).cast("int")).alias("last"),
    )
    return by_length.groupBy("channel").agg(
        F.sum("first").alias("first"), F.sum("last").alias("last"), F.sum(F.col("n") / F.col("m")).alias("linear")
    )


def _reaches_sale(counts: dict[tuple[str, str], int], without: str | None) -> float:
    """How often a path from the start sells; a removed channel loses whoever comes to it."""
    names = sorted({s for s, _ in counts} - {without})
    place = {s: i for i, s in enumerate(names)}
    matrix, sale = np.zeros((len(names), len(names))), np.zeros(len(names))
    leaving = np.zeros(len(names))
    for (source, target), n in counts.items():
        if source in place:
            leaving[place[source]] += n
            if target == "(sale)":
                sale[place[source]] += n
            elif target in place:
                matrix[place[source], place[target]] += n
    share = 1 / np.maximum(leaving, 1)
    return float(np.linalg.solve(np.eye(len(names)) - matrix * share[:, None], sale * share)[place["(start)"]])


def removal_effects(moves: DataFrame) -> dict[str, float]:
    """By channel, the part of all sales that would be lost without it.

    The matrix of the channels, MOST_CHANNELS squared at most, is solved on the driver.
    """
    counts = {(r["source"], r["target"]): r["n"] for r in moves.limit(MOST_CHANNELS**2 + 1).collect()}
    channels = sorted({s for s, _ in counts} - {"(start)"})
    if len(channels) > MOST_CHANNELS:
        raise ValueError(f"more than {MOST_CHANNELS} channels")
    if not any(t == "(sale)" for _, t in counts):
        return {c: 0.0 for c in channels}
    base = _reaches_sale(counts, None)
    return {c: 1 - _reaches_sale(counts, c) / base for c in channels}
