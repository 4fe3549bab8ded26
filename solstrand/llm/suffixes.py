"""Repeated passages across documents, from a sparse suffix array.

Suffixes are retained at minimisers only: of every WINDOW consecutive grams of GRAM words, the one
with the least hash.  Content selects them, so a passage that stands in two texts retains the same
suffixes in both.  Suffixes meet by the hash of their first STEM words.  A window of MIN_WORDS =
STEM + WINDOW - 1 words holds at least one whole matching stem, whatever it lies between, so all its
other words are among the WINDOW - 1 words left and right of that stem.  Matches are extended by
these: for each number of words to the left, suffixes that agree in so many words before the stem and
in the rest of a window behind it are neighbours, and the window repeats if they are of different rows.

One order of the suffixes is not enough.  Neighbours by their left or by their right words alone may
be different documents, and a suffix at the edge of a passage need not be retained in both texts.

A stem or context shared by a third of all documents is counted within each task first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from solstrand.llm.common import col, fresh, hash_flags
from solstrand.llm.words import Words, buffers, gram_rows, grams, long_grams, slices, words
from solstrand.sinks.scratch import written

MIN_WORDS = 50
WINDOW = 15
STEM = MIN_WORDS - WINDOW + 1
GRAM = 6
FILTER_BITS = 25


def anchors(found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, word number, stem hash) of the retained suffixes of a slice with a whole stem."""
    small = grams(found.code, GRAM)
    n = len(small) - WINDOW + 1
    rows, _ = gram_rows(found.first, STEM)
    if n <= 0 or not len(rows):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64)
    # The leftmost least gram of each window, by one comparison per place in it.
    least, at = small[:n].copy(), np.zeros(n, np.int8)
    for j in range(1, WINDOW):
        other = small[j : j + n]
        lower = other < least
        least[lower] = other[lower]
        at[lower] = j
    # Windows over the border of two rows select nothing.
    row_of = np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))
    whole = row_of[:n] == row_of[WINDOW + GRAM - 2 : WINDOW + GRAM - 2 + n]
    taken = np.zeros(len(small), bool)
    taken[(np.arange(n) + at)[whole]] = True
    _, stem_whole = gram_rows(found.first, STEM)
    taken = taken[: len(stem_whole)] & stem_whole[: len(taken)]
    place = np.flatnonzero(taken)
    return row_of[place], place, long_grams(found.code, STEM)[place]


def _stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        found = words(*buffers(batch.column("text")))
        row, _, stem = anchors(found)
        yield pa.RecordBatch.from_pydict(
            {
                "stem": pa.array(stem.view(np.int64)),
                "doc": batch.column("doc").take(pa.array(row)),
            }
        )


def _suffixes(flags: np.ndarray) -> Callable:
    """(stem, doc, at, before, behind, least, most) of the suffixes whose stem passes the filter.

    `before` and `behind` hold WINDOW word hashes next to the stem, nearest first, four bytes each;
    0 stands beyond the end of the text.  Windows of MIN_WORDS words that hold the stem start `least`
    to `most` words before it, as far as the text goes; none if `least` is above.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = words(*buffers(batch.column("text")))
            row, place, stem = anchors(found)
            low = (stem & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
            hit = flags[low >> 3] >> (low & 7).astype(np.uint8) & 1 > 0
            row, place, stem = row[hit], place[hit], stem[hit]
            if not len(row):
                continue
            short = (found.code >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
            near = np.arange(WINDOW)
            first, last = found.first[row][:, None], found.first[row + 1][:, None]
            left = place[:, None] - 1 - near
            right = place[:, None] + STEM + near
            before = np.where(left >= first, short[np.maximum(left, 0)], 0).astype(">u4")
            behind = np.where(right < last, short[np.minimum(right, len(short) - 1)], 0).astype(">u4")
            width = pa.binary(4 * WINDOW)
            yield pa.RecordBatch.from_pydict(
                {
                    "stem": pa.array(stem.view(np.int64)),
                    "doc": batch.column("doc").take(pa.array(row)),
                    "at": pa.array(place - found.first[row]),
                    "least": pa.array(np.maximum(WINDOW - 1 - (last[:, 0] - place - STEM), 0).astype(np.int32)),
                    "most": pa.array(np.minimum(place - first[:, 0], WINDOW - 1).astype(np.int32)),
                    "before": pa.FixedSizeBinaryArray.from_buffers(
                        width, len(row), [None, pa.py_buffer(before.tobytes())]
                    ).cast(pa.binary()),
                    "behind": pa.FixedSizeBinaryArray.from_buffers(
                        width, len(row), [None, pa.py_buffer(behind.tobytes())]
                    ).cast(pa.binary()),
                }
            )

    return run


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc, start, stop): passages, in word numbers, each MIN_WORDS words of which stand in another row, too.

    `docs` has `doc`, a number of its own for each row, and `text`; stored rows, as it is read twice.
    Texts without words or NULL have none; two rows with the same text repeat each other whole.
    Repeats within one document alone are not reported.
    """
    stems = docs.select("doc", "text").mapInArrow(_stems, "stem long, doc long")
    shared = written(
        stems.groupBy("stem")
        .agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
        .filter("low <> high")
        .select("stem"),
        "stems",
    )
    flags = hash_flags(shared, "stem", FILTER_BITS)
    suffixes = docs.select("doc", "text").mapInArrow(
        _suffixes(flags), "stem long, doc long, at long, least int, most int, before binary, behind binary"
    )
    # The filter lets a few others through; the join is exact.
    suffixes = written(suffixes.join(shared, "stem", "left_semi"), "suffixes")
    return _stretches(suffixes)


def _stretches(suffixes: DataFrame) -> DataFrame:
    """(doc, start, stop) of the longest stretches whose windows of MIN_WORDS words are in other rows, too.

    Suffixes that agree in stem and in all words next to it have one context.  Where a context stands in
    two rows, all its windows do.  Only the windows of the others, and of contexts that share a stem with
    them, are compared one by one.  Contexts are counted within each task before they travel.
    """
    named = suffixes.withColumn("context", F.xxhash64("stem", "before", "behind")).filter("least <= most")
    facts = [F.first(c).alias(c) for c in ("stem", "before", "behind", "least", "most")]
    contexts = named.groupBy("context").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), *facts)
    contexts = written(contexts, "contexts")
    lone = contexts.filter("low = high")
    back = F.col("back")
    key = F.xxhash64(
        "stem",
        "back",
        F.substring("before", F.lit(1), 4 * back),
        F.substring("behind", F.lit(1), 4 * (WINDOW - 1 - back)),
    )
    peers = contexts.join(lone.select("stem").distinct(), "stem", "left_semi")
    windows = peers.withColumn("back", F.explode(F.sequence("least", "most"))).withColumn("window", key)
    elsewhere = (
        windows.groupBy("window")
        .agg(F.min("low").alias("first"), F.max("high").alias("last"))
        .filter("first <> last")
        .select("window")
    )
    found = windows.filter("low = high").select("window", "context", "back").join(elsewhere, "window", "left_semi")
    spans = found.select("context", F.col("back").alias("least"), F.col("back").alias("most")).unionByName(
        contexts.filter("low <> high").select("context", "least", "most")
    )
    placed = named.select("context", "doc", "at").join(spans, "context")
    starts = placed.select("doc", (F.col("at") - F.col("most")).alias("a"), (F.col("at") - F.col("least")).alias("b"))
    in_text = Window.partitionBy("doc").orderBy("a", "b")
    reached = F.max("b").over(in_text.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("a") > reached + 1, F.lit(True)).cast("int")
    return (
        starts.withColumn("opens", opens)
        .withColumn("stretch", F.sum("opens").over(in_text.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc", "stretch")
        .agg(F.min("a").alias("start"), (F.max("b") + MIN_WORDS).alias("stop"))
        .drop("stretch")
    )


def document_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, start_word, end_word, n_words) of every repeated passage of `docs`."""
    (place,) = fresh(docs, "place")
    placed = docs.select(F.monotonically_increasing_id().alias(place), col("doc_id").alias("doc_id"), col("text").alias("text"))
    placed = written(placed, "placed")
    found = repeated_passages(placed.select(col(place).alias("doc"), col("text").alias("text")))
    ids = placed.select(col(place).alias("doc"), col("doc_id").alias("doc_id"))
    return found.join(ids, "doc").select(
        "doc_id",
        F.col("start").alias("start_word"),
        F.col("stop").alias("end_word"),
        (F.col("stop") - F.col("start")).alias("n_words"),
    )
