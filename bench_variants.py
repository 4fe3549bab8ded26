"""Times of chosen plans next to the plans they replace; one JSON line per pair.

`python bench_variants.py [folder]`; the folder defaults to $BENCH_SF_DIR.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solstrand.operators import calendar, ids
from solstrand.operators import feeds as feed_ops
from solstrand.plans import feeds, streams
from solstrand.plans import geo as geo_plans
from solstrand.sinks.scratch import scratch_path
from solstrand.streaming.dedup import first_seen
from solstrand.streaming.hops import append
from tests.session import local_session


def seconds(build) -> float:
    def once() -> float:
        start = time.perf_counter()
        df = build()
        if isinstance(df, DataFrame):
            df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once()
    return round(statistics.median(once() for _ in range(3)), 2)


def main() -> None:
    default = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else default
    spark = local_session("variants")

    def exploded_spine() -> DataFrame:
        return spark.sql(
            "SELECT explode(sequence(to_date('-3999-01-01'), to_date('2100-12-31'), "
            "interval 1 day)) AS dt"
        )

    def spine() -> DataFrame:
        return calendar.date_spine(spark)

    def stories() -> DataFrame:
        return feed_ops.stacked(feeds.feeds(spark, sf_dir))

    def dedup(salts: int):
        def run() -> None:
            stream = first_seen(
                streams.events(spark, sf_dir), "user_id", "ts", salts=salts, spread=["event_id"]
            )
            root = scratch_path(spark, "variant")
            append(stream, f"{root}/rows", f"{root}/checkpoint").awaitTermination()

        return run

    def world(broadcasts: bool):
        def build() -> DataFrame:
            limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
            if not broadcasts:
                spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            try:
                return geo_plans.chain_join(spark, sf_dir)
            finally:
                spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)

        return build

    by_url = [F.col("url"), F.col("local_id")]
    pairs = {
        "whole calendar, attributes": {
            "range spine": lambda: calendar.with_calendar(spine()),
            "exploded sequence": lambda: calendar.with_calendar(exploded_spine()),
        },
        "whole calendar, daily running sums": {
            "range spine": lambda: calendar.calendar_indicators(spine()),
            "exploded sequence": lambda: calendar.calendar_indicators(exploded_spine()),
        },
        "row numbers over the feeds": {
            "range split and offsets": lambda: ids.numbered(stories(), by_url),
            "global row_number": lambda: stories().withColumn(
                "id", F.expr("row_number() OVER (ORDER BY url, local_id)")
            ),
        },
        "hierarchy": {"checked broadcasts": world(True), "merge joins": world(False)},
        "stream deduplication": {"16 salts": dedup(16), "no salts": dedup(1)},
    }
    for name, variants in pairs.items():
        print(json.dumps({name: {v: seconds(build) for v, build in variants.items()}}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
