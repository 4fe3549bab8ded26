"""Streaming deduplication that survives an id with a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_seen(
    stream: DataFrame,
    key: str = "id",
    event_time: str = "timestamp",
    delay: str = "7 days",
    bounded: bool = False,
    salts: int = 16,
    spread: Sequence[str | Column] = ("topic", "partition", "offset"),
) -> DataFrame:
    """The first row seen of each key.

    Unbounded, a key is remembered for ever, since the event time is no part of it: the state grows
    with the number of keys.  Bounded, a key is forgotten `delay` after its event time, and copies
    further apart may come through again.

    Deduplication has no map-side part, so all copies of a key meet in one task.  With `salts` > 1
    copies are first removed per key and salt, a hash of the columns in `spread` that differ
    between copies: a key with a third of the rows is worked off by `salts` tasks, and at most
    `salts` copies within `delay` reach the final step.

    The first step forgets after `delay`.  It costs a second exchange: take `salts=1` where ids
    repeat a few times at most.  A query that has a checkpoint must keep to the choice between 1
    and more.
    """
    rows = stream.withWatermark(event_time, delay)
    if salts > 1:
        salt = F.pmod(F.xxhash64(*spread), F.lit(salts))
        rows = (
            rows.withColumn("_salt", salt).dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
        )
    if bounded:
        return rows.dropDuplicatesWithinWatermark([key])
    return rows.dropDuplicates([key])
