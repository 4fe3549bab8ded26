"""Nearest neighbours of vectors: an exact scan, and an index of inverted lists.

Vectors are compared by the dot product of their entries in 1024ths, whole numbers, so scores are exact and do
not depend on the order of additions.  Of equal scores the smaller id comes first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from solstrand.sinks.scratch import written

SCALE = 1024
#: Queries that are sent to all tasks at once; more are worked off block by block, a scan each.
BLOCK = 4096
#: Vectors the centres of an index are fitted on, at most.
SAMPLE = 20000
PART = 20000
#: Scores of queries and vectors that a task holds at once.
SCORES = 1 << 20
# Below every score, and with a negative that fits, too.
_SELF = -(1 << 62)


def _whole(column: pa.Array) -> np.ndarray:
    n = len(column)
    entries = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.round(entries * SCALE).astype(np.int64).reshape(n, -1) if n else np.zeros((0, 1), np.int64)


def _scores(queries: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Dot products; by way of doubles, which are faster, where these hold every sum exactly."""
    a, b = queries.astype(np.float64), x.astype(np.float64)
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * x.shape[1] < 2**53:
        return (a @ b.T).astype(np.int64)
    return queries @ x.T


def _merged(parts: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores), a row for each query, of the k best of all `parts` of the same queries."""
    ids, scores = (np.concatenate(side, axis=1) for side in zip(*parts, strict=True))
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)


def _best_of(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best of `ids` for each query, itself left out: its score is _SELF.

    Worked off in tiles of at most SCORES scores, whatever the number of queries and vectors.
    """
    wide = max(k, min(len(ids), 4096), 1)
    tall = max(1, SCORES // wide)
    found = []
    for top in range(0, len(query_ids), tall):
        mine, best = slice(top, top + tall), None
        for left in range(0, len(ids), wide):
            own = ids[left : left + wide]
            scores = _scores(queries[mine], x[left : left + wide])
            scores[query_ids[mine, None] == own[None, :]] = _SELF
            if scores.shape[1] > k:
                # Down to those as good as the k-th of each query, equal ones by id.
                least = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k][:, None]
                above = scores > least
                room = k - above.sum(1, keepdims=True)
                order = np.argsort(own, kind="stable")
                equal = (scores == least)[:, order]
                kept = above[:, order] | (equal & (np.cumsum(equal, axis=1, dtype=np.int32) <= room))
                at = order[np.nonzero(kept)[1].reshape(len(scores), k)]
                part = own[at], np.take_along_axis(scores, at, 1)
            else:
                part = np.broadcast_to(own, scores.shape), scores
            best = _merged([best, part] if best else [part], k)
        if best:
            found.append(best)
    if not found:
        return np.zeros((len(query_ids), 0), np.int64), np.zeros((len(query_ids), 0), np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _batch(query_ids: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    """(query, id, score) of what was found, without the queries themselves."""
    rows = np.repeat(np.arange(len(query_ids)), ids.shape[1])
    real = scores.ravel() > _SELF
    return pa.RecordBatch.from_pydict(
        {
            "query": pa.array(query_ids[rows][real]),
            "id": pa.array(ids.ravel()[real]),
            "score": pa.array(scores.ravel()[real]),
        }
    )


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def exact_neighbours(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query, rank, id, score): the k best of all `vectors` for each of `queries`; both have id and vector.

    Each block of queries is sent to all tasks, which keep the k best of all their own vectors; only those
    are exchanged.  Vectors are never moved.
    """
    n = queries.count()
    blocks = max(1, -(-n // BLOCK))
    out = None
    for block in range(blocks):
        mine = queries.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).select("id", "vector").toArrow()
        ids, x = mine.column("id").to_numpy(), _whole(mine.column("vector").combine_chunks())

        def scan(batches: Iterator[pa.RecordBatch], ids=ids, x=x) -> Iterator[pa.RecordBatch]:
            best = None
            for batch in batches:
                if batch.num_rows and len(ids):
                    own = batch.column("id").to_numpy()
                    part = _best_of(own, _whole(batch.column("vector")), ids, x, k)
                    best = _merged([best, part], k) if best else part
            if best:
                yield _batch(ids, *best)

        found = vectors.select("id", "vector").mapInArrow(scan, "query long, id long, score long")
        out = out.unionByName(found) if out else found
    return _ranked(out, k)


def fit_centres(vectors: DataFrame, lists: int, rounds: int = 10, seed: int = 1) -> np.ndarray:
    """Unit centres of `lists` groups of directions, fitted on at most SAMPLE vectors chosen by hash of id."""
    total = vectors.count()
    share = min(1.0, SAMPLE / max(total, 1))
    chosen = vectors.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    x = _whole(chosen.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toArrow().column("vector").combine_chunks()).astype(float)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(lists, len(x)), replace=False)]
    for _ in range(rounds):
        of = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, of, x)
        filled = np.bincount(of, minlength=len(centres)) > 0
        centres[filled] = sums[filled] / np.maximum(np.linalg.norm(sums[filled], axis=1, keepdims=True), 1e-9)
    return centres


def _lists_of(rows: DataFrame, centres: np.ndarray, probes: int) -> DataFrame:
    """The rows once for each of their `probes` nearest centres, as `list`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = np.argsort(-(_whole(batch.column("vector")) @ centres.T), axis=1, kind="stable")[:, :probes]
            rows = pa.array(np.repeat(np.arange(batch.num_rows), near.shape[1]))
            taken = batch.take(rows)
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(near.ravel().astype(np.int32))], names=["id", "vector", "list"])

    return rows.select("id", "vector").mapInArrow(run, "id long, vector array<float>, list int")


def index(vectors: DataFrame, centres: np.ndarray) -> DataFrame:
    """Every vector with its list, stored; a list is cut into parts of about PART vectors."""
    listed = written(_lists_of(vectors, centres, 1), "listed")
    parts = listed.groupBy("list").agg(F.ceil(F.count("*") / PART).alias("parts"))
    return written(listed.join(F.broadcast(parts), "list").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))), "index")


def index_neighbours(indexed: DataFrame, centres: np.ndarray, queries: DataFrame, k: int, probes: int) -> DataFrame:
    """(query, rank, id, score): the k best among the vectors of each query's `probes` nearest lists.

    Queries and vectors meet by list and part; the queries of a list are cut into parts of BLOCK, so a list with
    a large part of all rows on either side is worked off by many tasks.
    """
    asked = written(_lists_of(queries, centres, probes), "asked")
    parts = indexed.select("list", "parts").distinct()
    askers = asked.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    left = (
        indexed.join(F.broadcast(askers), "list")
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("list", "part", "block", "id", "vector")
    )
    right = (
        asked.join(F.broadcast(askers), "list")
        .join(F.broadcast(parts), "list")
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .select("list", "part", "block", "id", "vector")
    )

    def search(vectors: pa.Table, asking: pa.Table) -> pa.Table:
        if not vectors.num_rows or not asking.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("query", "id", "score")})
        sides = [(t.column("id").to_numpy(), _whole(t.column("vector").combine_chunks())) for t in (vectors, asking)]
        return pa.Table.from_batches([_batch(sides[1][0], *_best_of(*sides[0], *sides[1], k))])

    at = ["list", "part", "block"]
    found = left.groupBy(*at).cogroup(right.groupBy(*at)).applyInArrow(search, "query long, id long, score long")
    return _ranked(found, k)
