"""Queries on the behaviour of users and sensors over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from solstrand.operators.asof import Known, asof_joins, time_cuts
from solstrand.operators.series import gaps_filled, resampled, rolling_scores, seconds
from solstrand.sources.tables import table

HORIZON = "3 days"
KINDS = ("click", "error", "purchase")
CENTS = "CAST(round(value * 100) AS BIGINT)"


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their hour; several of a user often share it."""
    events = table(spark, sf_dir, "events")
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")
    return events.select("event_id", "user_id", "event_type", F.expr(CENTS).alias("cents"), hour)


def propensity_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each view: what was known of the user before its hour, and whether a purchase follows.

    Nothing of the view's own hour or later enters a feature.  `bought` looks at the three days after that
    hour; it is NULL where the data end before them.
    """
    events = _hourly(spark, sf_dir)
    views = events.filter("event_type = 'view'").select("event_id", "user_id", "hour")
    cuts = time_cuts(events.select("hour"))
    # Events of a user up to each hour; their number in a span is a difference of two of these.
    per_hour = events.groupBy("user_id", F.col("hour").alias("at")).agg(F.count("*").alias("n"))
    so_far = per_hour.select("user_id", "at", F.expr("sum(n) OVER (PARTITION BY user_id ORDER BY at)").alias("upto"))
    known = [Known(so_far, "at", {"upto": "now"})]
    for kind in KINDS:
        of_kind = events.filter(F.col("event_type") == kind).withColumn("at", F.col("hour"))
        known.append(Known(of_kind, "at", {"cents": f"{kind}_cents", "at": f"{kind}_at"}, ["event_id"]))
    rows = asof_joins(views, known, ["user_id"], "hour", exact=False, cuts=cuts)
    rows = rows.withColumn("week_before", F.expr("hour - INTERVAL 7 DAYS"))
    then = [Known(so_far, "at", {"upto": "then"})]
    rows = asof_joins(rows, then, ["user_id"], "week_before", exact=False, cuts=cuts)
    sold = events.filter("event_type = 'purchase'").select("user_id", F.col("hour").alias("at"))
    following = [Known(sold, "at", {"at": "next_purchase"})]
    rows = asof_joins(rows, following, ["user_id"], "hour", exact=False, later=True, within=HORIZON, cuts=cuts)
    end = events.agg(F.max("hour")).first()[0]
    known = F.expr(f"hour + INTERVAL {HORIZON}") <= F.lit(end)

    def hours(since: str) -> Column:
        return ((seconds(F.col("hour")) - seconds(F.col(since))) / 3600).cast("bigint").alias(f"hours_since_{since[:-3]}")

    return rows.select(
        "event_id",
        "user_id",
        *[c for k in KINDS for c in (f"{k}_cents", hours(f"{k}_at"))],
        (F.coalesce("now", F.lit(0)) - F.coalesce("then", F.lit(0))).alias("n_week"),
        F.when(known, F.col("next_purchase").isNotNull().cast("int")).alias("bought"),
    )


def propensity_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often a purchase follows, by cells of two features, drawn towards a half where views are few."""
    rows = propensity_features(spark, sf_dir).filter("bought IS NOT NULL")
    since = F.col("hours_since_click")
    recency = F.when(since <= 24, "day").when(since <= 72, "three days").when(since.isNotNull(), "longer")
    cells = rows.groupBy(
        F.coalesce(recency, F.lit("never")).alias("click"), F.least(F.floor(F.col("n_week") / 4), F.lit(5)).alias("activity")
    ).agg(F.count("*").alias("n_views"), F.sum("bought").alias("n_bought"))
    return cells.withColumn("propensity", (F.col("n_bought") + 1) / (F.col("n_views") + 2))


def sensor_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events as a series of six-hour buckets: gaps filled, scored against the day before."""
    events = table(spark, sf_dir, "events")
    series = gaps_filled(resampled(events, "user_id", "ts", F.expr(CENTS), "6 hours"), "user_id")
    scored = rolling_scores(series, "user_id", "carried", 24 * 3600)
    return scored.select("user_id", F.col("bucket").cast("string").alias("bucket"), "n", "total", "carried", "linear", "score")


QUERIES = {
    "propensity_features": propensity_features,
    "propensity_cells": propensity_cells,
    "sensor_series": sensor_series,
}

_FEATURES = f"""
    WITH e AS (SELECT event_id, user_id, event_type, {CENTS} AS cents, date_trunc('hour', ts) AS hour FROM events),
    last AS (SELECT user_id, event_type, hour, arg_max(cents, event_id) AS cents FROM e GROUP BY ALL)
    SELECT v.event_id, v.user_id,
      {', '.join(f"{k}.cents AS {k}_cents, date_diff('hour', {k}.hour, v.hour) AS hours_since_{k}" for k in KINDS)},
      (SELECT count(*) FROM e WHERE e.user_id = v.user_id AND e.hour < v.hour
        AND e.hour >= v.hour - INTERVAL 7 DAYS) AS n_week,
      CASE WHEN v.hour + INTERVAL {HORIZON} <= (SELECT max(hour) FROM e)
        THEN CAST(coalesce(s.hour <= v.hour + INTERVAL {HORIZON}, false) AS INTEGER) END AS bought
    FROM (SELECT * FROM e WHERE event_type = 'view') AS v
    {' '.join(f"ASOF LEFT JOIN (SELECT * FROM last WHERE event_type = '{k}') AS {k} ON {k}.user_id = v.user_id AND {k}.hour < v.hour" for k in KINDS)}
    ASOF LEFT JOIN (SELECT DISTINCT user_id, hour FROM e WHERE event_type = 'purchase') AS s
      ON s.user_id = v.user_id AND s.hour > v.hour"""

ORACLES = {
    "propensity_features": _FEATURES,
    "propensity_cells": f"""
        SELECT click, activity, count(*) AS n_views, CAST(sum(bought) AS BIGINT) AS n_bought,
          (sum(bought) + 1) / (count(*) + 2) AS propensity
        FROM (SELECT bought, CASE WHEN hours_since_click IS NULL THEN 'never' WHEN hours_since_click <= 24 THEN 'day'
            WHEN hours_since_click <= 72 THEN 'three days' ELSE 'longer' END AS click,
            least(n_week // 4, 5) AS activity FROM ({_FEATURES}) WHERE bought IS NOT NULL)
        GROUP BY 1, 2""",
    "sensor_series": f"""
        WITH sums AS (SELECT user_id, time_bucket(INTERVAL 6 HOURS, ts) AS bucket, count(*) AS n,
            CAST(sum({CENTS}) AS BIGINT) AS total FROM events GROUP BY 1, 2),
        spine AS (SELECT user_id, unnest(generate_series(min(bucket), max(bucket), INTERVAL 6 HOURS)) AS bucket
            FROM sums GROUP BY 1),
        series AS (SELECT p.user_id, p.bucket, coalesce(n, 0) AS n, total
            FROM spine AS p LEFT JOIN sums AS s ON s.user_id = p.user_id AND s.bucket = p.bucket),
        filled AS (SELECT *, last_value(total IGNORE NULLS) OVER before AS carried,
            last_value(CASE WHEN total IS NOT NULL THEN epoch(bucket)::BIGINT END IGNORE NULLS) OVER before AS f,
            first_value(total IGNORE NULLS) OVER after AS follows,
            first_value(CASE WHEN total IS NOT NULL THEN epoch(bucket)::BIGINT END IGNORE NULLS) OVER after AS t
            FROM series WINDOW
            before AS (PARTITION BY user_id ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            after AS (PARTITION BY user_id ORDER BY bucket ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        sized AS (SELECT *, count(*) OVER day AS m, sum(carried) OVER day AS s, sum(carried * carried) OVER day AS q
            FROM filled WINDOW day AS (PARTITION BY user_id ORDER BY bucket
            RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND INTERVAL 1 SECOND PRECEDING))
        SELECT user_id, strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket, n, total, carried,
          CASE WHEN t = f THEN CAST(carried AS DOUBLE)
            ELSE CAST(carried * (t - f) + (follows - carried) * (epoch(bucket)::BIGINT - f) AS DOUBLE) / (t - f) END AS linear,
          CASE WHEN m >= 2 AND m * q - s * s > 0
            THEN CAST(m * carried - s AS DOUBLE) / sqrt(CAST(m * q - s * s AS DOUBLE)) END AS score
        FROM sized""",
}
