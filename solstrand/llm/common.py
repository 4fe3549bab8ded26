"""What several operators share: tables, scratch results, hashes as columns, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from solstrand.sinks.scratch import written

SEPARATORS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that `df` does not have yet, made from `names`."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def set_aside(df: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """`df` with columns called like one of `names` renamed, and {new name: old name}."""
    clash = [c for c in df.columns if c.lower() in {n.lower() for n in names}]
    away = dict(zip(clash, fresh(df, *[f"own_{c}" for c in clash]), strict=True))
    return df.withColumnsRenamed(away), {new: old for old, new in away.items()}


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def estimated_tokens(text: Column) -> Column:
    """About four bytes a token, rounded up; 0 without text."""
    return F.floor((utf8_bytes(text) + 3) / 4).cast("long")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node reachable over the edges, for every node with an edge.

    Labels sink along the edges and jump to the label of their label, so a chain of n nodes takes
    about log n rounds.  Each round is written to the shared folder; no node list reaches the driver.
    """
    both = edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
    both = both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y")))
    both = written(both.filter("x <> y").distinct(), "links")
    labels = written(both.groupBy("x").agg(F.least("x", F.min("y")).alias("root")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("x").alias("y"), F.col("root").alias("near")), "y")
            .groupBy("x")
            .agg(F.min("near").alias("near"))
        )
        sunk = labels.join(near, "x").select("x", "root", F.least("root", "near").alias("low"))
        jump = labels.select(F.col("x").alias("low"), F.col("root").alias("lower"))
        new = written(
            sunk.join(jump, "low").select("x", F.col("root").alias("old"), F.col("lower").alias("root")),
            "labels",
        )
        labels = new.select("x", "root")
        if new.filter("old <> root").limit(1).count() == 0:
            return labels.select(F.col("x").alias("node"), "root")


def hash_flags(names: DataFrame, column: str, bits: int) -> np.ndarray:
    """2^bits flags, packed: set for the low bits of each value of `column`.

    A filter of fixed size, whatever the input: 2^bits / 8 bytes on the driver and in each task.
    """
    low = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    flag = F.call_function("shiftleft", F.lit(1).cast("long"), low.bitwiseAND(F.lit(31)).cast("int"))
    rows = (
        names.groupBy(F.shiftright(low, 5).alias("word")).agg(F.bit_or(flag).alias("flags")).toArrow()
    )
    out = np.zeros(1 << (bits - 5), "<u4")
    out[rows.column("word").to_numpy()] = rows.column("flags").to_numpy()
    return out.view(np.uint8)


def grouped(key: list[str], work: Callable[[pa.Table], pa.RecordBatch | None]) -> Callable:
    """For mapInArrow: runs `work` on each run of equal keys of a partition sorted by them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                out = work(pa.Table.from_batches(held))
                if out is not None and out.num_rows:
                    yield out

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in key]
            change = np.zeros(batch.num_rows, bool)
            for x in keys:
                change[1:] |= x[1:] != x[:-1]
            starts = np.concatenate([[0], np.flatnonzero(change), [batch.num_rows]])
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                this = tuple(x[a] for x in keys)
                if last is not None and this != last:
                    yield from flush()
                    held = []
                held.append(batch.slice(a, b - a))
                last = this
        yield from flush()

    return run
