"""Stock levels by store, kept by a stream with state of its own and timers.

A store whose level falls below the reorder point is `short`; if it still is `patience` later, it is
`overdue`, once for each time it is short.  What is told does not depend on how the movements are
cut into batches, as long as no batch holds movements older than the batches before it.  Level, the start of the
shortage and the timer for its end are in the checkpoint, so a run that is started again goes on where
the last one ended.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "store long, kind string, ms long, level long"
DAY_MS = 24 * 3600 * 1000


class StockLevels(StatefulProcessor):
    """Levels from movements (store, ms, quantity), with `short` and `overdue` notices.

    Movements of a batch are taken in order of time, in milliseconds since 1970; those of one moment
    count together.
    """

    def __init__(self, opening: int, reorder_at: int, patience_days: int):
        self.opening = opening
        self.reorder_at = reorder_at
        self.patience = patience_days * DAY_MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # `since` is when the store fell short, NULL while it is not; `told` whether it was called overdue.
        self.state = handle.getValueState("state", "level long, since long, told boolean")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        (store,) = key
        moved: dict = {}
        for row in rows:
            moved[row.ms] = moved.get(row.ms, 0) + row.quantity
        level, since, told = self.state.get() if self.state.exists() else (self.opening, None, False)
        timed = since if since is not None and not told else None
        for at in sorted(moved):
            if since is not None and not told and at > since + self.patience:
                yield Row(store=store, kind="overdue", ms=since + self.patience, level=level)
                told = True
            level += moved[at]
            if level >= self.reorder_at:
                since, told = None, False
            elif since is None:
                since = at
                yield Row(store=store, kind="short", ms=at, level=level)
        self.state.update((level, since, told))
        waits = since if since is not None and not told else None
        if timed is not None and waits != timed:
            self.handle.deleteTimer(timed + self.patience)
        if waits is not None and waits != timed:
            self.handle.registerTimer(waits + self.patience)
        yield Row(store=store, kind="level", ms=max(moved), level=level)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        (store,) = key
        level, since, _ = self.state.get()
        self.state.update((level, since, True))
        yield Row(store=store, kind="overdue", ms=since + self.patience, level=level)

    def close(self) -> None:
        pass


def stock_levels(movements: DataFrame, opening: int, reorder_at: int, patience_days: int, delay: str = "0 seconds") -> DataFrame:
    """The notices of all stores; `movements` is a stream of (store, at, quantity)."""
    slim = movements.select(
        F.col("store").cast("long").alias("store"),
        "at",
        F.unix_millis("at").alias("ms"),
        F.col("quantity").cast("long").alias("quantity"),
    )
    told = (
        slim.withWatermark("at", delay)
        .groupBy("store")
        .transformWithState(StockLevels(opening, reorder_at, patience_days), OUTPUT, "Append", "EventTime")
    )
    return told.select("store", "kind", F.timestamp_millis("ms").alias("at"), "level")
