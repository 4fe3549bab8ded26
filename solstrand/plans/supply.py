"""Queries on goods: which are traced, which matter most."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from solstrand.operators.graphs import reached
from solstrand.operators.running import running_total
from solstrand.sinks.scratch import written
from solstrand.sources.tables import table

MOST_HOPS = 6


def _moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where goods go: from a supplier's lot of a part into orders, to customers; returns go back into lots."""
    items = table(spark, sf_dir, "lineitem")
    lot = F.concat_ws(":", F.lit("lot"), "l_suppkey", "l_partkey")
    order = F.concat_ws(":", F.lit("order"), "l_orderkey")
    out = items.select(lot.alias("src"), order.alias("dst"))
    back = items.filter("l_returnflag = 'R'").select(order.alias("src"), lot.alias("dst"))
    sold = table(spark, sf_dir, "orders").select(
        F.concat_ws(":", F.lit("order"), "o_orderkey").alias("src"),
        F.concat_ws(":", F.lit("customer"), "o_custkey").alias("dst"),
    )
    return out.unionByName(back).unionByName(sold)


def recall_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whatever the lots of suppliers in debt can have come into contact with, six moves on."""
    lots = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "supplier").filter("s_acctbal < 0"), F.col("l_suppkey") == F.col("s_suppkey"), "left_semi"
    )
    seeds = lots.select(F.concat_ws(":", F.lit("lot"), "l_suppkey", "l_partkey").alias("node"))
    return reached(_moves(spark, sf_dir), seeds, MOST_HOPS)


def part_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by revenue: those that make the first 80 % are A, the next 15 % B, the rest C."""
    items = table(spark, sf_dir, "lineitem")
    revenue = items.groupBy("l_partkey").agg(
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents")
    )
    parts = written(revenue, "revenue")
    ranked = running_total(parts, [F.col("cents").desc(), F.col("l_partkey")], "cents", "up_to")
    total = parts.agg(F.sum("cents")).first()[0] or 0
    share = F.col("up_to") * 100
    kind = F.when(share <= F.lit(total) * 80, "A").when(share <= F.lit(total) * 95, "B").otherwise("C")
    return ranked.select("l_partkey", "cents", "rank", "up_to", kind.alias("class"))


QUERIES = {"recall_trace": recall_trace, "part_classes": part_classes}

ORACLES = {
    "recall_trace": f"""
        WITH RECURSIVE edges AS (
            SELECT 'lot:' || l_suppkey || ':' || l_partkey AS src, 'order:' || l_orderkey AS dst FROM lineitem
            UNION SELECT 'order:' || l_orderkey, 'lot:' || l_suppkey || ':' || l_partkey FROM lineitem
            WHERE l_returnflag = 'R'
            UNION SELECT 'order:' || o_orderkey, 'customer:' || o_custkey FROM orders),
        walk(node, hops) AS (
            SELECT DISTINCT 'lot:' || l_suppkey || ':' || l_partkey, 0 FROM lineitem
            JOIN supplier ON s_suppkey = l_suppkey WHERE s_acctbal < 0
            UNION SELECT dst, hops + 1 FROM walk JOIN edges ON src = node WHERE hops < {MOST_HOPS}),
        least AS (SELECT node, min(hops) AS hops FROM walk GROUP BY 1)
        SELECT n.node, n.hops, (SELECT min(e.src) FROM edges AS e JOIN least AS p ON p.node = e.src
            WHERE e.dst = n.node AND p.hops = n.hops - 1) AS via FROM least AS n""",
    "part_classes": """
        WITH revenue AS (SELECT l_partkey, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents
            FROM lineitem GROUP BY 1),
        ranked AS (SELECT *, row_number() OVER w AS rank, CAST(sum(cents) OVER w AS BIGINT) AS up_to FROM revenue
            WINDOW w AS (ORDER BY cents DESC, l_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
        SELECT l_partkey, cents, rank, up_to, CASE WHEN up_to * 100 <= (SELECT sum(cents) FROM revenue) * 80 THEN 'A'
            WHEN up_to * 100 <= (SELECT sum(cents) FROM revenue) * 95 THEN 'B' ELSE 'C' END AS class FROM ranked""",
}
