"""Graphs as tables of edges: what is reached from where, and connected components.

Each round is written to the scratch folder, so plans stay short and a lost executor costs a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solstrand.sinks.scratch import bucketed, written

#: Edges in a bucket; there are no fewer buckets than shuffle partitions.
PER_BUCKET = 500_000
#: A source with more than 1 / CROWDED of all edges is joined apart, so its edges are not all in one bucket.
CROWDED = 256


def reached(edges: DataFrame, seeds: DataFrame, max_hops: int | None = None) -> DataFrame:
    """(node, hops, via): all nodes reached from the seeds along (src, dst), with the fewest hops.

    `via` is the least node of the round before that leads there, NULL for seeds.  A node is looked at
    in the round that finds it only, so cycles end; without `max_hops` it goes on until a round finds
    nothing.  Copies of edges and loops change nothing; NULL ends are left out.  Edges are exchanged
    once, into buckets of their source; in a round only nodes that are new travel, once for each task
    that finds them.
    """
    spark = edges.sparkSession
    links = edges.select("src", "dst").filter("src <> dst")
    # Sources are told apart by hash: those that share a crowded one's are joined with it.
    size = links.select(F.xxhash64("src").alias("src")).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(src, {CROWDED}, {64 * CROWDED})").alias("top")
    )
    n, top = size.first()
    crowded = [t["item"] for t in top or [] if t["count"] * CROWDED > n]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // PER_BUCKET))
    front = written(
        seeds.select("node")
        .filter("node IS NOT NULL")
        .distinct()
        .select("node", F.lit(0).alias("hops"), F.lit(None).cast(links.schema["src"].dataType).alias("via")),
        "front",
    )
    seen, hops = front, 0
    apart = F.xxhash64("src").isin(crowded)
    many = written(links.filter(apart).distinct(), "edges") if crowded else None
    with bucketed(links.filter(~apart) if crowded else links, "edges", "src", buckets) as few:
        while max_hops is None or hops < max_hops:
            hops += 1
            # Nodes of a round are distinct, so what a task keeps of them is as even as the buckets.
            nodes, here = front.select("node"), F.col("node") == F.col("src")
            found = few.join(nodes.hint("shuffle_hash"), here)
            if many is not None:
                found = found.unionByName(many.join(F.broadcast(nodes.filter(F.xxhash64("node").isin(crowded))), here))
            new = found.groupBy(F.col("dst").alias("node")).agg(F.lit(hops).alias("hops"), F.min("src").alias("via"))
            front = written(new.join(seen.select("node"), "node", "left_anti"), "front")
            if front.limit(1).count() == 0:
                break
            seen = seen.unionByName(front)
    return seen


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the least node that is connected with each node of the edges (src, dst).

    Every node takes the least root of its neighbours, then the root of that root, so a chain of n
    nodes takes about log n rounds.
    """
    pairs = edges.select("src", "dst").filter("src <> dst")
    both = written(
        pairs.unionByName(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct(),
        "edges",
    )
    roots = written(both.groupBy(F.col("src").alias("node")).agg(F.least("node", F.min("dst")).alias("root")), "roots")
    while True:
        near = (
            both.join(roots.select(F.col("node").alias("dst"), F.col("root").alias("near")), "dst")
            .groupBy(F.col("src").alias("node"))
            .agg(F.min("near").alias("near"))
        )
        low = roots.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("low"))
        jump = roots.select(F.col("node").alias("low"), F.col("root").alias("lower"))
        new = written(low.join(jump, "low").select("node", "old", F.col("lower").alias("root")), "roots")
        roots = new.select("node", "root")
        if new.filter("old <> root").limit(1).count() == 0:
            return roots
