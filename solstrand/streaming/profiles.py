"""Profiles of users kept up to date by a stream: windows and sessions in event time.

Events may come twice, out of order, and too late.  A copy of an event is dropped within the delay; an
event older than the delay allows is late: it is dropped by the deduplication, row by row, before anything
is summed, so the number of dropped rows that the stream reports is the number of late events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def punctual(events: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """Each event once, without those that come later than `delay` behind the latest one seen."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def daily_profiles(events: DataFrame, user: str, time: str, width: str = "1 day") -> DataFrame:
    """(user, window start, n_events, n_purchases, cents) of each window that can get no more events.

    Events are summed within each task before they meet the state, so a user with a large part of all
    events is one row per task.
    """
    window = F.window(time, width)
    bought = F.col("event_type") == "purchase"
    return events.groupBy(user, window).agg(
        F.count("*").alias("n_events"),
        F.sum(F.when(bought, 1).otherwise(0)).alias("n_purchases"),
        F.coalesce(F.sum(F.when(bought, F.col("cents"))), F.lit(0)).alias("cents"),
    ).select(user, F.col("window.start").alias("starts"), "n_events", "n_purchases", "cents")


def sessions(events: DataFrame, user: str, time: str, gap: str = "8 hours") -> DataFrame:
    """(user, starts, ends, n_events): runs of a user's events with less than `gap` between them, once over."""
    window = F.session_window(time, gap)
    return events.groupBy(user, window).agg(F.count("*").alias("n_events")).select(
        user, F.col("session_window.start").alias("starts"), F.col("session_window.end").alias("ends"), "n_events"
    )


def late_rows(query: StreamingQuery) -> int:
    """Events that the deduplication of a finished run dropped as late."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
        if operator["operatorName"] == "dedupeWithinWatermark"
    )
