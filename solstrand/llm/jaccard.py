"""N-gram Jaccard join with signature trees: which documents are linked by similar shingle sets.

Two sets link when 100 * intersection >= 75 * union.  Equal sets are one class from the start.

1. Candidates.  With all shingles in one order, the first n - ceil(0.75 n) + 1 of a set of n (its
   prefix) meet the prefix of every set it links with.  The order puts shingles found common before
   last, so that widely shared passages seldom make candidates; any order gives all links.
2. Runs.  The classes that share a prefix shingle make a run; runs with the same least class are one.
   Each run builds a signature tree and traverses it against itself, which prunes pairs by their maximum
   possible overlap.
3. Exact comparison.  First, each run hands on only pairs that would join two groups if they all
   linked (a forest); they are compared exactly, and the links merge groups.  Large groups of near
   copies grow together in this way at the cost of about one comparison a member.  The last round
   hands on every pair that is left between different groups, so no link is lost.

Groups are merged by label propagation over the shared folder; sets travel to the comparisons only.
Sets are named by 63-bit hashes of their shingles' 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from solstrand.llm.common import col, components, fresh, grouped, hash_flags
from solstrand.llm.signatures import build, folded, forest, linked_leaves, signature
from solstrand.llm.words import buffers, mixed, slices, text_sets, words
from solstrand.sinks.scratch import written

SHINGLE = 5
NUM, DEN = 75, 100
#: Shingles held back to the end of the order: an ordering hint of bounded size.
HELD_BACK = 1 << 16
COMMON_SHARE = 1000
#: Classes of a run that are looked at together: a task holds at most two such blocks.
PART = 4096
FILTER_BITS = 24
_U = np.uint64


def _sets(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of all rows, distinct and in order within each, and the rows' boundaries."""
    raw, bounds = buffers(batch.column("text"))
    found = words(raw, bounds, lower=True)
    return text_sets(found.code, found.first, k)


def set_names(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """63-bit name of each set, whatever its order; 0 for the empty set."""
    sizes = np.diff(bounds)
    out, some = np.zeros(len(sizes), np.int64), np.flatnonzero(sizes)
    if len(some):
        total = np.add.reduceat(mixed(shingles ^ _U(0xA0761D6478BD642F)), bounds[some])
        out[some] = np.maximum(mixed(total + sizes[some].astype(_U)) >> _U(1), _U(1)).view(np.int64)
    return out


def _lists(values: np.ndarray, sizes: np.ndarray, missing: np.ndarray) -> pa.Array:
    """Lists of the given sizes, one after the other in `values`; NULL where `missing`."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)), mask=pa.array(missing))


def prefix_length(n: int, num: int, den: int) -> int:
    return n - -(-num * n // den) + 1


def _heavy(k: int) -> Callable:
    """(token, n): shingles met in three or more texts of a slice; a partial count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            tokens, n = np.unique(_sets(batch, k)[0], return_counts=True)
            often = n >= 3
            if often.any():
                yield pa.RecordBatch.from_pydict(
                    {"token": pa.array(tokens[often].view(np.int64)), "n": pa.array(n[often].astype(np.int64))}
                )

    return run


def held_back(docs: DataFrame, k: int) -> np.ndarray:
    """The most common shingles, at most HELD_BACK of them: only the order depends on them."""
    counts = docs.select("text").mapInArrow(_heavy(k), "token long, n long")
    total = docs.count()
    rows = (
        counts.groupBy("token")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") * COMMON_SHARE >= total)
        .orderBy(F.desc("n"), "token")
        .limit(HELD_BACK)
        .select("token")
        .collect()
    )
    return np.sort(np.array([r["token"] for r in rows], np.int64).view(_U))


def _described(k: int, num: int, den: int, last: np.ndarray) -> Callable:
    """Per document its id, text hash, set name and size; bitmap and prefix with the first copy in a task.

    The prefix comes in two parts: its shingles that are held back are `common`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            shingles, bounds = _sets(batch, k)
            names, sizes = set_names(shingles, bounds), np.diff(bounds)
            new = np.zeros(len(names), bool)
            for i, name in enumerate(names.tolist()):
                new[i] = name != 0 and name not in seen
                seen.add(name)
            elements, n = shingles[np.repeat(new, sizes)], sizes[new]
            row, starts = np.repeat(np.arange(len(n)), n), np.cumsum(n) - n
            late = np.zeros(len(elements), bool)
            if len(last):
                late = last[np.minimum(np.searchsorted(last, elements), len(last) - 1)] == elements
            want = prefix_length(n, num, den)
            n_late = np.bincount(row[late], minlength=len(n))
            n_prefix = np.minimum(n - n_late, want)
            n_common = np.minimum(n_late, want - n_prefix)
            before = np.cumsum(late) - late  # held-back shingles of this and earlier rows
            place = before - (np.cumsum(n_late) - n_late)[row]
            common = late & (place < n_common[row])
            prefix = ~late & (np.arange(len(elements)) - starts[row] - place < n_prefix[row])
            per_row = np.zeros((2, len(names)), np.int64)
            per_row[:, new] = n_prefix, n_common
            bits = np.full(len(names), None, object)
            bits[new] = [signature(elements[a : a + m]).tobytes() for a, m in zip(starts, n, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id").cast(pa.int64()),
                    "h": batch.column("h"),
                    "set_id": pa.array(names),
                    "n": pa.array(sizes.astype(np.int64)),
                    "bits": pa.array(bits, pa.binary()),
                    "prefix": _lists(elements[prefix], per_row[0], ~new),
                    "common": _lists(elements[common], per_row[1], ~new),
                }
            )

    return run


def _flagged(values: np.ndarray, flags: np.ndarray) -> np.ndarray:
    at = values & ((1 << FILTER_BITS) - 1)
    return (flags[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _wanted(k: int, texts: np.ndarray, flags: np.ndarray) -> Callable:
    """(set_id, shingles) of sets whose text's hash and name pass the filters, once per task.

    Only texts whose hash passes are cut into shingles again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for whole in batches:
            asked = whole.filter(pa.array(_flagged(whole.column("h").to_numpy(), texts)))
            for batch in slices(iter([asked]), "text"):
                shingles, bounds = _sets(batch, k)
                names, sizes = set_names(shingles, bounds), np.diff(bounds)
                new = _flagged(names, flags)
                for i in np.flatnonzero(new).tolist():
                    new[i] = names[i] not in done
                    done.add(names[i])
                kept = shingles[np.repeat(new, sizes)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "set_id": pa.array(names[new]),
                        "shingles": _lists(kept, sizes[new], np.zeros(int(new.sum()), bool)),
                    }
                )

    return run


def _run_pairs(num: int, den: int, last: bool) -> Callable:
    """Pairs between different groups of a run that its signature trees let through.

    Bitmaps grow with the sets.  Similar sets have the same width or the next one, so there is a tree
    for each width, which holds the next width, too, folded.
    """

    def work(run: pa.Table) -> pa.RecordBatch | None:
        names, sizes = run.column("set_id").to_numpy(), run.column("n").to_numpy()
        if len(names) < 2:
            return None
        order = np.lexsort((names, sizes))
        names, sizes = names[order], sizes[order]
        bitmaps = run.column("bits").combine_chunks().take(pa.array(order)).to_pylist()
        bitmaps = [np.frombuffer(x, np.uint64) for x in bitmaps]
        widths = np.array([len(x) * 64 for x in bitmaps])
        _, groups = np.unique(run.column("grp").to_numpy()[order], return_inverse=True)
        found = []
        for bits in np.unique(widths).tolist():
            own = np.flatnonzero((widths == bits) | (widths == 2 * bits))
            tree = build(np.stack([folded(bitmaps[i], bits) for i in own]), sizes[own])
            pairs = (
                (own[a], own[b])
                for a, b in linked_leaves(tree, num, den, lambda own=own: groups[own])
            )
            narrow = ((a[widths[a] == bits], b[widths[a] == bits]) for a, b in pairs)
            if last:
                narrow = ((a[groups[a] != groups[b]], b[groups[a] != groups[b]]) for a, b in narrow)
            else:
                narrow = forest(narrow, groups)
            found += [np.stack([names[a], names[b]], 1) for a, b in narrow]
        if not found:
            return None
        both = np.concatenate(found)
        name = pa.array([run.column("run")[0].as_py()] * len(both), pa.int64())
        return pa.RecordBatch.from_pydict({"run": name, "a": pa.array(both.min(1)), "b": pa.array(both.max(1))})

    return work


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("h", F.xxhash64("text"))


def _exact_links(docs: DataFrame, texts: DataFrame, pairs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs whose sets are similar; only sets of the pairs are made again and exchanged.

    `texts` has the hash `h` of a text of each set.
    """
    wanted = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    wanted = written(wanted.join(texts, "set_id"), "asked")
    flags = [hash_flags(wanted, c, FILTER_BITS) for c in ("h", "set_id")]
    sets = _hashed(docs).select("text", "h").mapInArrow(_wanted(k, *flags), "set_id long, shingles array<long>")
    sets = written(sets.join(wanted, "set_id", "left_semi").dropDuplicates(["set_id"]), "wanted")
    left = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    reaches = den * both >= num * (F.size("x") + F.size("y") - both)
    return written(pairs.join(left, "a").join(right, "b").filter(reaches).select("a", "b"), "links")


def _parts(members: DataFrame, num: int, den: int, paired: bool) -> DataFrame:
    """(run, part, set_id, grp) of the runs with several groups, in parts that fit a task.

    `members` has run, set_id, n, grp.  Not paired, a run is cut by hash into parts of about PART
    classes.  Paired, it is cut by size into blocks of PART, and every two blocks whose sizes can be
    similar make a part, so every pair that may link meets in one.  A run of PART or fewer is one part.
    """
    by_run = Window.partitionBy("run")
    counted = members.withColumns(
        {
            "low": F.min("grp").over(by_run),
            "high": F.max("grp").over(by_run),
            "blocks": F.ceil(F.count("*").over(by_run) / PART),
        }
    )
    if not paired:
        placed = counted.filter("low <> high").withColumn("part", F.pmod(F.xxhash64("set_id"), F.col("blocks")))
        return placed.select("run", "part", "set_id", "grp")
    place = F.row_number().over(by_run.orderBy("n", "set_id")) - 1
    placed = counted.withColumn("place", place).withColumns(
        {
            "block": F.floor(F.col("place") / PART),
            # The least size of each block; no size exceeds that of the next block.
            "starts": F.array_sort(F.collect_list(F.when(F.col("place") % PART == 0, F.col("n"))).over(by_run)),
        }
    )
    meets = F.expr(
        f"""filter(sequence(0L, blocks - 1), b -> b = block
            OR (b > block AND {den} * n >= {num} * get(starts, int(b)))
            OR (b < block AND {den} * get(starts, int(b + 1)) >= {num} * n))"""
    )
    part = F.transform(meets, lambda b: F.least("block", b) * F.col("blocks") + F.greatest("block", b))
    return placed.filter("low <> high").select("run", F.explode(part).alias("part"), "set_id", "grp")


def _sharers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(run, set_id): of rows in order of token and set, the sets of tokens that several sets have.

    A token's run is its least set.  What is known of the last token goes on into the next batch.
    """
    last, held = None, []  # the last token, its least and its last set
    for batch in batches:
        if not batch.num_rows:
            continue
        token, sets = batch.column("token").to_numpy(), batch.column("set_id").to_numpy()
        if last == token[0]:
            token, sets = np.concatenate([[last, last], token]), np.concatenate([held, sets])
        first = np.ones(len(token), bool)
        first[1:] = token[1:] != token[:-1]
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(token)))
        run = np.repeat(sets[starts], sizes)
        other = sets != run
        own = first & np.repeat(np.logical_or.reduceat(other, starts), sizes)
        other[1:] &= sets[1:] != sets[:-1]
        yield pa.RecordBatch.from_pydict(
            {
                "run": pa.array(np.concatenate([run[own], run[other]])),
                "set_id": pa.array(np.concatenate([run[own], sets[other]])),
            }
        )
        last, held = token[-1], [run[-1], sets[-1]]


def _named_runs(first_copies: DataFrame) -> DataFrame:
    """(run, set_id): the sets that share a prefix shingle, named by the least of them.

    Runs of one name are looked at as one: copies share many shingles, and each class is sent to few
    runs.  Shingles held back may be in a large part of all sets.  There are at most HELD_BACK of them,
    so their least sets are found within each task first, and sent to all tasks; the rows of a common
    shingle never meet in one.
    """
    tokens = first_copies.select("set_id", F.explode("prefix").alias("token"))
    rare = (
        tokens.repartition("token")
        .sortWithinPartitions("token", "set_id")
        .mapInArrow(_sharers, "run long, set_id long")
    )
    often = first_copies.select("set_id", F.explode("common").alias("token"))
    least = often.groupBy("token").agg(F.min("set_id").alias("run"), F.max("set_id").alias("most"))
    common = often.join(F.broadcast(least.filter("run <> most")), "token").select("run", "set_id")
    return rare.union(common).distinct()


def linked_sets(docs: DataFrame, k: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """(id, set_id, n, grp): each document's set, and the group of sets its own is linked with.

    `docs` has `id` (integer or NULL) and `text`; it is read several times, so it must be stored rows.
    """
    last = held_back(docs, k)
    members = written(
        _hashed(docs.select("id", "text")).mapInArrow(
            _described(k, num, den, last),
            "id long, h long, set_id long, n long, bits binary, prefix array<long>, common array<long>",
        ),
        "sets",
    )
    first_copies = members.filter("prefix IS NOT NULL")
    described = first_copies.select("set_id", "h", "n", "bits")
    named = _named_runs(first_copies)
    # Sizes join the few rows that are left here; they do not travel with every shingle.
    named = named.join(described.groupBy("set_id").agg(F.first("n").alias("n")), "set_id")
    # Similar sets have sizes alike; who is unlike the next smaller and larger in a run is alone there.
    by_size = Window.partitionBy("run").orderBy("n", "set_id")
    near = (den * F.lag("n").over(by_size) >= num * F.col("n")) | (
        num * F.lead("n").over(by_size) <= den * F.col("n")
    )
    runs = written(named.withColumn("near", near).filter("near").select("run", "set_id"), "runs")
    known = runs.select("set_id").distinct()
    bitmaps = written(described.join(known, "set_id", "left_semi").dropDuplicates(["set_id"]), "bitmaps")
    groups = bitmaps.select("set_id", "n", F.col("set_id").alias("grp"))
    tested = None
    for paired, final in ((False, False), (True, False), (True, True)):
        open_runs = _parts(runs.join(groups, "set_id"), num, den, paired)
        found = (
            open_runs.join(bitmaps.select("set_id", "n", "bits"), "set_id")
            .repartition("run", "part")
            .sortWithinPartitions("run", "part")
            .mapInArrow(grouped(["run", "part"], _run_pairs(num, den, final)), "run long, a long, b long")
        )
        found = written(found, "found")
        # A run that let nothing through has no pair for later rounds, either, unless it was in parts.
        large = runs.groupBy("run").agg(F.count("*").alias("m")).filter(F.col("m") > PART)
        still = found.select("run").union(large.select("run")).distinct()
        runs = written(runs.join(still, "run", "left_semi"), "runs")
        pairs = found.select("a", "b").distinct()
        pairs = written(pairs.join(tested, ["a", "b"], "left_anti") if tested else pairs, "pairs")
        tested = tested.union(pairs) if tested else pairs
        if pairs.limit(1).count() == 0:
            continue
        links = _exact_links(docs, bitmaps.select("set_id", "h"), pairs, k, num, den)
        if links.limit(1).count() == 0:
            continue
        of = lambda c: groups.select(F.col("set_id").alias(c), F.col("grp").alias(f"g{c}"))
        roots = components(links.join(of("a"), "a").join(of("b"), "b"), "ga", "gb")
        groups = written(
            groups.join(roots, F.col("grp") == F.col("node"), "left").select(
                "set_id", "n", F.coalesce("root", "grp").alias("grp")
            ),
            "groups",
        )
    return (
        members.select("id", "set_id", "n")
        .join(groups.drop("n"), "set_id", "left")
        .select("id", "set_id", "n", F.coalesce("grp", "set_id").alias("grp"))
    )


def document_components(docs: DataFrame, k: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    Documents without words have empty sets and are components of their own.  Repeated rows and
    equal texts are linked if they have words.  A component of documents that all lack an id has none.
    """
    base = docs.select(col("doc_id").cast("long").alias("id"), col("text").alias("text"))
    linked = linked_sets(base, k, num, den)
    sizes = linked.filter("n > 0").groupBy("grp").agg(F.min("id").alias("component"))
    return linked.join(sizes, "grp", "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The first document of each component, with all columns; documents without words all stay.

    Rows are told apart by a number that is stored with them once, so it does not change with the files'
    layout or the executors at hand; repeated rows and repeated ids leave one row, too.
    """
    (place,) = fresh(docs, "place")
    placed = written(docs.withColumn(place, F.monotonically_increasing_id()), "placed")
    linked = linked_sets(placed.select(col(place).alias("id"), col("text").alias("text")))
    first = linked.filter("n > 0").groupBy("grp").agg(F.min("id").alias("first"))
    gone = linked.filter("n > 0").join(first, "grp").filter("id <> first").select(col("id").alias(place))
    return placed.join(gone, place, "left_anti").drop(place)
