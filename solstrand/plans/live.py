"""Streams whose rows come in several batches, some twice, some late, with restarts in between."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from solstrand.sinks.scratch import scratch_path
from solstrand.sources.messages import file_stream
from solstrand.sources.tables import table
from solstrand.streaming.dedup import first_seen
from solstrand.streaming.hops import append
from solstrand.streaming.profiles import daily_profiles, late_rows, punctual, sessions
from solstrand.streaming.stock import stock_levels

DELAY = "2 days"
OPENING, REORDER_AT, PATIENCE = 2000, 500, 30
# Days that make a batch of arrivals, where every batch is a run, and where it is a file of one run.
RUN_DAYS, FILE_DAYS = 10, 4
# Rows of a file, where a batch may land as many files.
FILE_ROWS = 500_000
# How many days an event is on its way.
ON_THE_WAY = "CASE WHEN event_id % 7 = 3 THEN 12 WHEN event_id % 11 = 5 THEN 1 ELSE 0 END"
MOVED = "CAST(CASE WHEN l_returnflag = 'R' THEN 2 * l_quantity ELSE -l_quantity END AS BIGINT)"
YEARS = "CASE WHEN year(at) <= 1996 THEN 0 WHEN year(at) <= 1998 THEN 1 ELSE 2 END"


def _arrivals(spark: SparkSession, sf_dir: str, days: int) -> DataFrame:
    """Events with the batch they arrive in; every thirteenth is delivered twice."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.expr("CAST(round(value * 100) AS BIGINT)").alias("cents"), F.col("ts").cast("timestamp").alias("ts")
    )
    batch = F.expr(f"CAST(floor((datediff(ts, '2024-01-01') + {ON_THE_WAY}) / {days}) AS INT)")
    return events.unionByName(events.filter("event_id % 13 = 0")).withColumn("batch", batch)


def _staged(rows: DataFrame, root: str) -> DataFrame:
    """The rows written once by batch: a batch that lands reads its own."""
    rows.write.partitionBy("batch").parquet(f"{root}/staged")
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{root}/staged")


def _land(rows: DataFrame, batch: int, folder: str, files: int) -> None:
    rows.filter(F.col("batch") == batch).drop("batch").repartition(files).write.mode("append").parquet(folder)


def _batches(rows: DataFrame) -> list[int]:
    return sorted(r[0] for r in rows.select("batch").distinct().collect())


def _in_runs(rows: DataFrame, root: str, run: Callable[[DataFrame], StreamingQuery]) -> list[StreamingQuery]:
    """Each batch lands as three files or more, then the stream is started, runs to its end and stops."""
    rows, done = _staged(rows, root), []
    for batch in _batches(rows):
        n = rows.filter(F.col("batch") == batch).count()
        _land(rows, batch, f"{root}/in", max(3, -(-n // FILE_ROWS)))
        query = run(file_stream(rows.sparkSession, f"{root}/in", rows.drop("batch").schema))
        query.awaitTermination()
        done.append(query)
    return done


def _with_late(spark: SparkSession, sf_dir: str, label: str, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What `work` makes of the punctual events, in runs; `late_rows` is the number of the others."""
    root = scratch_path(spark, label)
    runs = _in_runs(
        _arrivals(spark, sf_dir, RUN_DAYS),
        root,
        lambda events: append(work(punctual(events, "event_id", "ts", DELAY)), f"{root}/rows", f"{root}/checkpoint"),
    )
    late = sum(map(late_rows, runs))
    return spark.read.parquet(f"{root}/rows").withColumn("late_rows", F.lit(late).cast("bigint"))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's closed days."""
    rows = _with_late(spark, sf_dir, "profiles", lambda events: daily_profiles(events, "user_id", "ts"))
    return rows.withColumn("starts", F.col("starts").cast("string"))


def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's closed sessions."""
    rows = _with_late(spark, sf_dir, "sessions", lambda events: sessions(events, "user_id", "ts"))
    return rows.withColumns({"starts": F.col("starts").cast("string"), "ends": F.col("ends").cast("string")})


def rate_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run over files taken one at a time, then a second run, which finds nothing new."""
    root = scratch_path(spark, "rate-capped")
    rows = _staged(_arrivals(spark, sf_dir, FILE_DAYS), root)
    for batch in _batches(rows):
        _land(rows, batch, f"{root}/in", 1)
    stream = file_stream(spark, f"{root}/in", rows.drop("batch").schema, files_per_trigger=1)
    once = first_seen(stream, key="event_id", event_time="ts", delay=DELAY, bounded=True, spread=["cents"])
    for _ in range(2):
        append(once.select("event_id", "user_id"), f"{root}/rows", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/rows")


def stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shortages of suppliers' stores, those not mended in time, and their levels at the end."""
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("store"), F.col("l_shipdate").cast("timestamp").alias("at"), F.expr(MOVED).alias("quantity")
    )
    moves = items.withColumn("batch", F.expr(YEARS))
    root = scratch_path(spark, "stock")
    _in_runs(
        moves,
        root,
        lambda rows: append(
            stock_levels(rows, OPENING, REORDER_AT, PATIENCE), f"{root}/rows", f"{root}/checkpoint"
        ),
    )
    told = spark.read.parquet(f"{root}/rows")
    levels = told.filter("kind = 'level'").groupBy("store").agg(F.max("at").alias("at"), F.max_by("level", "at").alias("level"))
    ends = levels.select("store", F.lit("level").alias("kind"), "at", "level")
    return told.filter("kind <> 'level'").unionByName(ends).select("store", "kind", F.date_format("at", "yyyy-MM-dd").alias("day"), "level")


QUERIES = {
    "stream_profiles": profiles,
    "stream_sessions": user_sessions,
    "stream_rate_capped": rate_capped,
    "stream_stock": stock,
}


def _arrived(days: int, lag: int) -> str:
    """Arrivals with `late`: not behind the latest event of the batches up to `lag` before, less the delay."""
    return f"""
        events_in AS (SELECT event_id, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents, ts,
            CAST(floor((date_diff('day', TIMESTAMP '2024-01-01', ts) + {ON_THE_WAY}) / {days}) AS INT) AS batch
            FROM events),
        sent AS (SELECT * FROM events_in UNION ALL SELECT * FROM events_in WHERE event_id % 13 = 0),
        latest AS (SELECT batch, date_trunc('millisecond', max(ts)) - INTERVAL {DELAY} AS mark FROM sent GROUP BY 1),
        arrived AS (SELECT s.*, coalesce(ts <= (SELECT max(mark) FROM latest AS l
            WHERE l.batch <= s.batch - {lag}), false) AS late FROM sent AS s),
        once AS (SELECT DISTINCT event_id, user_id, event_type, cents, ts FROM arrived WHERE NOT late),
        final AS (SELECT max(mark) AS mark FROM latest), tardy AS (SELECT count(*) AS n FROM arrived WHERE late)"""


ORACLES = {
    "stream_profiles": f"""
        WITH {_arrived(RUN_DAYS, 1)}
        SELECT user_id, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS starts, count(*) AS n_events,
          count(*) FILTER (event_type = 'purchase') AS n_purchases,
          CAST(coalesce(sum(cents) FILTER (event_type = 'purchase'), 0) AS BIGINT) AS cents, (SELECT n FROM tardy) AS late_rows
        FROM once GROUP BY user_id, date_trunc('day', ts)
        HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT mark FROM final)""",
    "stream_sessions": f"""
        WITH {_arrived(RUN_DAYS, 1)},
        marked AS (SELECT *, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 8 HOURS OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END
            AS opens FROM once WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM marked),
        found AS (SELECT user_id, min(ts) AS starts, max(ts) + INTERVAL 8 HOURS AS ends, count(*) AS n_events
            FROM numbered GROUP BY user_id, session)
        SELECT user_id, rtrim(rtrim(strftime(starts, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.') AS starts,
          rtrim(rtrim(strftime(ends, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.') AS ends, n_events, (SELECT n FROM tardy) AS late_rows
        FROM found WHERE ends <= (SELECT mark FROM final)""",
    # Within one run lateness is judged by the mark that the batch before started with.
    "stream_rate_capped": f"WITH {_arrived(FILE_DAYS, 2)} SELECT event_id, user_id FROM once",
    "stream_stock": f"""
        WITH days AS (SELECT l_suppkey AS store, l_shipdate AS d, sum({MOVED}) AS moved FROM lineitem GROUP BY 1, 2),
        levels AS (SELECT store, d, CAST({OPENING} + sum(moved) OVER (PARTITION BY store ORDER BY d) AS BIGINT) AS level
            FROM days),
        steps AS (SELECT *, level < {REORDER_AT} AS short,
            coalesce(lag(level) OVER (PARTITION BY store ORDER BY d), {OPENING}) < {REORDER_AT} AS was_short FROM levels),
        begun AS (SELECT store, d, level, d + INTERVAL {PATIENCE} DAYS AS due, (SELECT min(n.d) FROM steps AS n
            WHERE n.store = s.store AND n.d > s.d AND NOT n.short) AS mended FROM steps AS s WHERE short AND NOT was_short),
        told AS (SELECT store, 'short' AS kind, d, level FROM begun
            UNION ALL SELECT store, 'overdue', due, (SELECT arg_max(l.level, l.d) FROM levels AS l
                WHERE l.store = b.store AND l.d <= b.due) FROM begun AS b
            WHERE (mended IS NULL OR mended > due) AND due <= (SELECT max(d) FROM levels)
            UNION ALL SELECT store, 'level', max(d), arg_max(level, d) FROM levels GROUP BY store)
        SELECT store, kind, strftime(d, '%Y-%m-%d') AS day, level FROM told""",
}
