"""SimHash fingerprints and their links by multi-index hashing.

A bit of a text's fingerprint is set if it is set in over half of the 64-bit hashes of its word
shingles, repeats included.  Two fingerprints link when they differ in at most three bits.

Links.  Cut into two halves, fingerprints that differ in three bits at most agree in one half but for
one bit.  The table of a half holds every distinct fingerprint under the value of that half; each
fingerprint asks it for its own value and for all values one bit away (only those with a bit more: of
two values one bit apart one asks for the other).  What is fetched is compared in all bits.

A value with more than CROWDED fingerprints is not fetched whole.  Its fingerprints are looked up once
more under the value and a half of the bits that are left: again one of the two halves agrees but for a
bit.  This is done for halves of 32, 16 and 8 bits; after the last, 8 free bits leave 256
fingerprints at most, which is CROWDED, so nothing is cut off and no list grows with the data.

Equal fingerprints are one row from the start, so copies are never paired.  Each batch of fetched
matches leaves a spanning forest, not its pairs; the forests are merged by label propagation over
the shared folder.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solstrand.llm.common import col, components
from solstrand.sinks.scratch import written

SHINGLE = 3
SEED = 42
DISTANCE = 3
WIDTHS = (32, 16, 8)
CROWDED = 256
#: A fingerprint with more than this part of all rows is common; there are 1 / COMMON of them at most.
COMMON = 0.001
# Bytes of a text that are split into words at once, and shingles whose bits are counted at once.
PIECE = 1 << 20
COUNTED = 1 << 14
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in parts of about PIECE bytes that end between words."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + PIECE)
        to = gap.start() if gap else len(text)
        yield text[at:to]
        at = to


def shingle_hashes(text: bytes, k: int = SHINGLE) -> Iterator[list[int]]:
    """XXH64 of every shingle of k words, in lists; of the whole sequence if there are fewer words."""
    from xxhash import xxh64_intdigest as digest

    held: list[bytes] = []
    any_yet = False
    for piece in _pieces(text):
        words = held + piece.lower().split()
        held = words[max(0, len(words) - k + 1) :]
        if len(words) < k:
            held = words
            continue
        plain = b" ".join(words)
        ends, at = [], -1
        for word in words:
            at += len(word) + 1
            ends.append(at)
        starts = [0, *[e + 1 for e in ends]]
        yield [digest(plain[a:b], SEED) for a, b in zip(starts, ends[k - 1 :], strict=False)]
        any_yet = True
    if held and not any_yet:
        yield [digest(b" ".join(held), SEED)]


def fingerprint(text: bytes | None, k: int = SHINGLE) -> int:
    """The fingerprint as an unsigned number; 0 without words."""
    total, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text or b"", k):
        found = np.array(hashes, np.uint64)
        n += len(found)
        for a in range(0, len(found), COUNTED):
            part = found[a : a + COUNTED].view(np.uint8).reshape(-1, 8)
            total += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0]) if n else 0


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint of each row of `docs`, which has `id` and `text`, as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            found = np.array([fingerprint(t.as_py(), k) for t in texts], np.uint64)
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column("id"), "fp": pa.array(found.view(np.int64), pa.int64())}
            )

    return docs.select("id", "text").mapInArrow(run, "id long, fp long")


def _shifted(x: int, by: Column) -> Column:
    return F.call_function("shiftleft", F.lit(x).cast("long"), by)


def _near(key: Column, low: Column, width: int, more_only: bool) -> Column:
    """`key` and what it becomes by one other bit of the segment; `more_only`: by one more set bit."""
    flags = F.array(*[_shifted(1, low + i) for i in range(width)])
    if more_only:
        flags = F.filter(flags, lambda f: key.bitwiseAND(f) == 0)
    return F.concat(F.array(key), F.transform(flags, lambda f: key.bitwiseXOR(f)))


def _keys(rows: DataFrame, width: int, asks: bool, more_only: bool = False) -> DataFrame:
    """(path, free, key, fp): the rows once for each half of their free bits, under its value.

    `rows` has `path` (the halves taken so far), `key` (their bits, as looked for), `fp`, and `free`, the
    lowest of the 2 * width free bits.  With `asks` there is a row for each value near by, too.
    """

    def half(which: int) -> Column:
        low = F.col("free") + which * width
        key = F.col("key").bitwiseOR(F.col("fp").bitwiseAND(_shifted((1 << width) - 1, low)))
        keys = _near(key, low, width, more_only) if asks else F.array(key)
        path, left = F.col("path") * 2 + which, F.col("free") + (1 - which) * width
        return F.transform(keys, lambda x: F.struct(path.alias("path"), left.alias("free"), x.alias("key")))

    both = rows.select("fp", F.explode(F.concat(half(0), half(1))).alias("at"))
    return both.select("at.path", "at.free", "at.key", "fp")


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): a spanning forest of the matches of each batch that are near enough in all bits."""
    for batch in batches:
        lists = batch.column("entries")
        sizes = np.diff(lists.offsets.to_numpy())
        own = np.repeat(batch.column("fp").to_numpy(), sizes).view(np.uint64)
        other = lists.flatten().to_numpy().view(np.uint64)
        apart = np.bitwise_count(own ^ other)
        near = (apart > 0) & (apart <= DISTANCE)
        a, b = spanning(own[near].view(np.int64), other[near].view(np.int64))
        yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) of the graph of the pairs, roots left out."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """(a, b): edges that connect all distinct `fp` of `fps` which differ in three bits at most.

    `fps` holds each fingerprint once and is read several times, so it must be stored rows.
    """
    at = ["path", "key"]
    start = fps.select(
        F.lit(0).alias("path"), F.lit(0).alias("free"), F.lit(0).cast("long").alias("key"), "fp"
    )
    own, asked = start, start
    links = None
    for width in WIDTHS:
        entries = _keys(own, width, asks=False)
        # At first both of two fingerprints ask; later only the one that came by asking does.
        questions = _keys(asked, width, asks=True, more_only=width == WIDTHS[0])
        sizes = entries.groupBy(at).agg(F.count("*").alias("size"))
        # After the last level a value has as many fingerprints as there are free bits to tell them apart.
        most = CROWDED if width > WIDTHS[-1] else 1 << WIDTHS[-1]
        crowded = written(sizes.filter(F.col("size") > most), "crowded")
        # Rows of a common value never meet in one task: it is taken out by broadcast, at most
        # 1 / COMMON values, and the others by whatever join the planner likes.
        total = COMMON * entries.count()
        common = F.broadcast(crowded.filter(F.col("size") > total).select(at))
        calm = written(
            entries.join(common, at, "left_anti")
            .join(crowded.filter(F.col("size") <= total), at, "left_anti")
            .groupBy(at)
            .agg(F.collect_list("fp").alias("entries")),
            "calm",
        )
        # The planner takes the exploded questions for as small as the fingerprints, and would broadcast them.
        met = questions.join(calm.hint("merge"), at).select("fp", "entries")
        found = written(met.mapInArrow(_verified, "a long, b long"), "near")
        links = links.unionByName(found) if links else found
        if crowded.limit(1).count() == 0:
            break

        def of_crowded(rows: DataFrame, common=common, crowded=crowded, total=total) -> DataFrame:
            rest = crowded.filter(F.col("size") <= total)
            kept = rows.join(common, at, "left_semi").unionByName(
                rows.join(common, at, "left_anti").join(rest, at, "left_semi")
            )
            return written(kept.select("path", "free", "key", "fp"), "crowded-rows")

        own, asked = of_crowded(entries), of_crowded(questions)
    return links


def simhash_components(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of `docs`; other columns are not used.

    Rows without words (NULL, empty or blank texts) have fingerprint zero, and link like any other:
    with one another and with fingerprints of three set bits at most.  Repeated rows stay.  A
    component of rows that all lack a doc_id has no component_id.  An empty table gives no rows.
    """
    base = docs.select(col("doc_id").cast("long").alias("id"), col("text").alias("text"))
    members = written(fingerprints(base, k), "fingerprints")
    classes = written(
        members.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")), "classes"
    )
    roots = components(fingerprint_links(classes.select("fp")), "a", "b")
    rooted = written(
        classes.join(roots, F.col("fp") == F.col("node"), "left").select(
            "fp", "least", "n", F.coalesce("root", "fp").alias("root")
        ),
        "rooted",
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    known = written(rooted.join(least, "root").select("fp", "n", "component"), "components")
    # Rows of a common fingerprint never meet in one task: theirs is looked up by broadcast.
    total = COMMON * (classes.agg(F.sum("n")).first()[0] or 0)
    common = F.broadcast(known.filter(F.col("n") > total).select("fp", "component"))
    rest = known.filter(F.col("n") <= total).select("fp", "component")
    of_common = members.join(common, "fp")
    of_rest = members.join(common, "fp", "left_anti").join(rest, "fp")
    return of_common.unionByName(of_rest).select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
