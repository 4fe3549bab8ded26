"""Regular series out of irregular readings: buckets, filled gaps, rolling scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from solstrand.operators.asof import asof_join, time_cuts

#: Lengths of the rolling frame that one task looks at together.
FRAMES_PER_CHUNK = 16


def resampled(readings: DataFrame, key: str, time: str, value: Column, step: str) -> DataFrame:
    """(key, bucket, n, total): every bucket from a key's first reading to its last, empty ones too.

    `value` is a whole number; NULLs are not counted, nor are readings without key or time.  Readings
    are summed within each task first, so a key with many readings is as small as its buckets.
    """
    sums = (
        readings.filter(F.col(key).isNotNull() & F.col(time).isNotNull() & value.isNotNull())
        .groupBy(key, F.window(time, step)["start"].alias("bucket"))
        .agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    )
    spans = sums.groupBy(key).agg(F.min("bucket").alias("first"), F.max("bucket").alias("last"))
    spine = spans.select(key, F.explode(F.sequence("first", "last", F.expr(f"INTERVAL {step}"))).alias("bucket"))
    return spine.join(sums, [key, "bucket"], "left").select(
        key, "bucket", F.coalesce("n", F.lit(0)).alias("n"), "total"
    )


def seconds(time: Column) -> Column:
    """Whole seconds since 1970, of a TIMESTAMP with or without zone."""
    return F.unix_timestamp(time.cast("timestamp"))


def gaps_filled(series: DataFrame, key: str) -> DataFrame:
    """The series with `carried` (the last known total) and `linear` (on the line to the next one).

    Known buckets keep their total in both.  `linear` is one division of whole numbers, so it does
    not depend on the order of additions.  Neighbours come from as-of joins, so a long series of one key is
    split over tasks.
    """
    known = series.filter("total IS NOT NULL").select(key, F.col("bucket").alias("at"), F.col("total").alias("seen"))
    cuts = time_cuts(series.select("bucket"))
    before, after = {"seen": "carried", "at": "from_bucket"}, {"seen": "next_total", "at": "to_bucket"}
    both = asof_join(series, known, [key], "bucket", "at", before, cuts=cuts)
    both = asof_join(both, known, [key], "bucket", "at", after, later=True, cuts=cuts)
    gap = seconds(F.col("to_bucket")) - seconds(F.col("from_bucket"))
    gone = seconds(F.col("bucket")) - seconds(F.col("from_bucket"))
    line = F.col("carried") * gap + (F.col("next_total") - F.col("carried")) * gone
    linear = F.when(gap == 0, F.col("carried").cast("double")).otherwise(line.cast("double") / gap)
    return both.select(key, "bucket", "n", "total", "carried", linear.alias("linear"))


def rolling_scores(series: DataFrame, key: str, value: str, back: int) -> DataFrame:
    """The series with `score`: how many standard deviations `value` is off the mean of the `back`
    seconds before it, the own bucket left out; NULL with fewer than two buckets or without spread.

    A key's buckets are cut into chunks of FRAMES_PER_CHUNK frames; the last frame of a chunk goes to
    the next one, too, so every row finds its whole frame in one task.  Sums are of whole numbers.
    """
    at = seconds(F.col("bucket"))
    length = back * FRAMES_PER_CHUNK
    chunk = F.floor(at / length)
    near_end = at + back >= (chunk + 1) * length
    chunks = F.when(near_end, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    copies = series.select(
        "*", at.alias("_at"), chunk.alias("_own"), F.explode(chunks).alias("_chunk")
    )
    frame = Window.partitionBy(key, "_chunk").orderBy("_at").rangeBetween(-back, -1)
    n, s = F.count(value).over(frame), F.sum(value).over(frame)
    squares = F.sum(F.col(value) * F.col(value)).over(frame)
    scored = copies.withColumns({"_n": n, "_s": s, "_q": squares}).filter("_own = _chunk")
    spread = F.col("_n") * F.col("_q") - F.col("_s") * F.col("_s")
    score = (F.col("_n") * F.col(value) - F.col("_s")).cast("double") / F.sqrt(spread.cast("double"))
    return scored.select(*series.columns, F.when((F.col("_n") >= 2) & (spread > 0), score).alias("score"))
