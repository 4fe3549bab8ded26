"""Quality rules: base counts of each text, and its distance from its language's habits.

References are learned from all documents: per language, the shares of character classes and of the
most common words.  A document is compared with the nearest reference by the Jensen-Shannon distance
(square root of the divergence in bits, 0 to 1) of both histograms, added up.  Documents too short for a
histogram to mean anything are not judged by it, nor are those whose own language has no reference.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from solstrand.llm.common import col, fresh, set_aside
from solstrand.llm.words import buffers, byte_table, gram_rows, grams, slices, words
from solstrand.sinks.scratch import written

#: lower, upper, outside ASCII, digit, blank, line end, marks of prose, other marks, control.
CLASSES = 9
COMMON_WORDS = 100
MIN_REFERENCE_WORDS = 1000
MIN_CHARS = 200
MIN_WORDS = 50
#: Of both distances together.
MAX_DISTANCE = 0.65
_PARTIAL_WORDS = 1 << 19
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
ADDED = [*COUNTS, "class_distance", "word_distance", "base_failed", "kept"]


def _class_of_bytes() -> np.ndarray:
    """Class of each byte; continuation bytes of UTF-8 have the class above the last."""
    out = np.full(256, 8, np.int64)
    out[0x21:0x7F] = 7
    out[list(b".,;:!?'\"()-")] = 6
    out[ord("0") : ord("9") + 1] = 3
    out[ord("a") : ord("z") + 1] = 0
    out[ord("A") : ord("Z") + 1] = 1
    out[0x80:0xC0] = CLASSES
    out[0xC0:] = 2
    out[[9, 32]] = 4
    out[[10, 11, 12, 13]] = 5
    return out


def class_counts(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    rows = np.repeat(np.arange(len(bounds) - 1) * (CLASSES + 1), np.diff(bounds))
    flat = np.bincount(rows + _class_of_bytes()[raw], minlength=(len(bounds) - 1) * (CLASSES + 1))
    return flat.reshape(-1, CLASSES + 1)[:, :CLASSES]


class Reference(NamedTuple):
    lang: str
    classes: np.ndarray  # shares, CLASSES of them
    words: np.ndarray  # hashes of the common words, ascending
    shares: np.ndarray  # their shares of all words, and behind them that of all others


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, is_class, key, n) partial counts of each task."""

    def rows(lang: list, is_class: bool, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {
                "lang": pa.array(lang, pa.string()),
                "is_class": pa.array([is_class] * len(lang), pa.bool_()),
                "key": pa.array(key.astype(np.int64)),
                "n": pa.array(n.astype(np.int64)),
            }
        )

    classes: dict[str, np.ndarray] = {}
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def merged(pairs: list) -> tuple[np.ndarray, np.ndarray]:
        codes, which = np.unique(np.concatenate([c for c, _ in pairs]), return_inverse=True)
        return codes, np.bincount(which, np.concatenate([n for _, n in pairs])).astype(np.int64)

    for batch in slices(batches, "text"):
        raw, bounds = buffers(batch.column("text"))
        found = words(raw, bounds)
        kinds = class_counts(raw, bounds)
        langs = np.array(batch.column("lang").fill_null("").to_pylist(), object)
        word_lang = np.repeat(np.arange(len(langs)), np.diff(found.first))
        for lang in set(langs.tolist()):
            mine = langs == lang
            classes[lang] = classes.get(lang, np.zeros(CLASSES, np.int64)) + kinds[mine].sum(0)
            pair = np.unique(found.code[mine[word_lang]], return_counts=True)
            held.setdefault(lang, []).append(pair)
            size += len(pair[0])
        if size > 2 * _PARTIAL_WORDS:
            held = {k: [merged(v)] for k, v in held.items()}
            size = sum(len(v[0][0]) for v in held.values())
            if size > _PARTIAL_WORDS:
                for lang, pairs in held.items():
                    yield rows([lang] * len(pairs[0][0]), False, pairs[0][0].view(np.int64), pairs[0][1])
                held, size = {}, 0
    for lang, pairs in held.items():
        codes, n = merged(pairs)
        yield rows([lang] * len(codes), False, codes.view(np.int64), n)
    for lang, n in classes.items():
        yield rows([lang] * CLASSES, True, np.arange(CLASSES), n)


def references(docs: DataFrame, common: int = COMMON_WORDS) -> list[Reference]:
    """The reference of each language with at least MIN_REFERENCE_WORDS words in `docs`.

    NULL languages form one of their own.  What reaches the driver is `common` words and the
    character classes of each language.
    """
    counts = (
        docs.select(col("lang").cast("string").alias("lang"), col("text").alias("text"))
        .mapInArrow(_counted, "lang string, is_class boolean, key long, n long")
        .groupBy("lang", "is_class", "key")
        .agg(F.sum("n").alias("n"))
    )
    # Looked at three times: the classes, the words of each language, its most common words.
    counts = written(counts, "vocabulary")
    listed_words = counts.filter("NOT is_class")
    totals = {r["lang"]: r["total"] for r in listed_words.groupBy("lang").agg(F.sum("n").alias("total")).collect()}
    # A rank limit in the map tasks leaves `common` words of a language in each before they travel.
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "key"))
    ranked = listed_words.withColumn("rank", rank).filter(F.col("rank") <= common).drop("rank").collect()
    # Only words of at least a ten-thousandth of their language.
    top = counts.filter("is_class").collect() + [r for r in ranked if r["n"] * 10_000 >= totals[r["lang"]]]
    out = []
    for lang in sorted({r["lang"] for r in top}):
        mine = [r for r in top if r["lang"] == lang]
        listed = sorted((r["key"] % (1 << 64), r["n"]) for r in mine if not r["is_class"])
        total = totals.get(lang, 0)
        if total < MIN_REFERENCE_WORDS:
            continue
        classes = np.zeros(CLASSES)
        for r in mine:
            if r["is_class"]:
                classes[r["key"]] = r["n"]
        shares = np.array([n for _, n in listed], float)
        out.append(
            Reference(
                lang,
                classes / classes.sum(),
                np.array([k for k, _ in listed], np.uint64),
                np.append(shares, total - shares.sum()) / total,
            )
        )
    return out


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Row-wise Jensen-Shannon distance of shares `p` (rows) from `q`."""
    m = (p + q) / 2

    def kl(a: np.ndarray) -> np.ndarray:
        a = np.broadcast_to(a, m.shape)
        return np.where(a > 0, a * np.log2(np.where(a > 0, a, 1) / np.where(m > 0, m, 1)), 0).sum(1)

    return np.sqrt(np.clip((kl(p) + kl(q)) / 2, 0, 1))


def _distances(found, kinds: np.ndarray, refs: list[Reference]) -> tuple[np.ndarray, np.ndarray]:
    """Of each row, its class and word distance from the nearest reference (by their sum)."""
    n = len(kinds)
    counts = np.diff(found.first)
    row = np.repeat(np.arange(n), counts)
    best = np.full((n, 2), np.inf)
    p = kinds / np.maximum(kinds.sum(1, keepdims=True), 1)
    for ref in refs:
        k = len(ref.words)
        at = np.minimum(np.searchsorted(ref.words, found.code), max(k - 1, 0))
        bin_of = np.where(ref.words[at] == found.code, at, k) if k else np.zeros(len(found.code), int)
        hist = np.bincount(row * (k + 1) + bin_of, minlength=n * (k + 1)).reshape(n, k + 1)
        shares = hist / np.maximum(counts, 1)[:, None]
        both = np.stack([js_distance(p, ref.classes), js_distance(shares, ref.shares)], 1)
        nearer = both.sum(1) < best.sum(1)
        best[nearer] = both[nearer]
    return best[:, 0], best[:, 1]


def base_counts(raw: np.ndarray, bounds: np.ndarray, found) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each row."""
    n = len(bounds) - 1
    symbol, gap = byte_table(b"#*$%&|<>"), byte_table(b"\x20\t\n\x0b\x0c\r")
    kind = np.zeros(256, np.int8)
    kind[(np.arange(256) & 0xC0) != 0x80] = 1  # a code point starts
    kind[gap] = 0

    def per_row(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[bounds[1:]] - total[bounds[:-1]]

    code, first = found.code, found.first
    repeat = np.zeros(len(code), bool)
    rows, whole = gram_rows(first, 5)
    if whole.any():
        windows = grams(code, 5)[whole]
        places, rows = np.flatnonzero(whole), rows[whole]
        order = np.lexsort((windows, rows))
        same = (windows[order][1:] == windows[order][:-1]) & (rows[order][1:] == rows[order][:-1])
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        hit = places[order[twice]]
        for j in range(5):
            repeat[hit + j] = True
    total = np.concatenate([[0], np.cumsum(repeat)])
    return {
        "n_words": np.diff(first),
        "word_chars": per_row(kind[raw]),
        "n_symbols": per_row(symbol[raw]),
        "n_dup_lines": np.array(
            [_dup_lines(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], np.int64
        )
        if n
        else np.zeros(0, np.int64),
        "n_repeat_words": total[first[1:]] - total[first[:-1]],
    }


def _dup_lines(raw: np.ndarray) -> int:
    lines = [x for x in raw.tobytes().split(b"\n") if x.strip(b"\x20\t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def judged(docs: DataFrame, refs: list[Reference], text: str = "text", lang: str = "lang") -> DataFrame:
    """`docs` with the base counts, distances, `base_failed` and `kept`; one pass, no exchange.

    A NULL or empty text has no words and fails.  Distances are NULL where the text is shorter than
    MIN_CHARS or MIN_WORDS, or there is no reference of the document's own language (NULL is one of
    its own); `kept` then follows the base rules alone.  Existing columns of these names are replaced;
    every row is judged by itself, copies included.
    """
    ints, added = COUNTS, ADDED
    docs = docs.drop(*added)
    (own,) = fresh(docs, "has_reference")
    known = F.coalesce(col(lang).cast("string"), F.lit("")).isin([ref.lang for ref in refs])
    marked = docs.withColumn(own, known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            column = batch.column(batch.schema.get_field_index(text))
            raw, bounds = buffers(column)
            found = words(raw, bounds)
            counts = base_counts(raw, bounds, found)
            failed = (counts["n_words"] < 10) | (100 * counts["n_repeat_words"] > 20 * counts["n_words"])
            kinds = class_counts(raw, bounds)
            by_class, by_word = _distances(found, kinds, refs)
            judge = (kinds.sum(1) >= MIN_CHARS) & (counts["n_words"] >= MIN_WORDS)
            judge &= batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            far = judge & (by_class + by_word > MAX_DISTANCE)
            arrays = [pa.array(counts[c].astype(np.int64)) for c in ints]
            arrays += [pa.array(x, pa.float64(), mask=~judge) for x in (by_class, by_word)]
            arrays += [pa.array(failed), pa.array(~failed & ~far)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *arrays], names=[*batch.schema.names[:-1], *added]
            )

    extra = ", ".join(f"{c} long" for c in ints)
    ddl = f"{extra}, class_distance double, word_distance double, base_failed boolean, kept boolean"
    schema = T.StructType([*docs.schema, *T.StructType.fromDDL(ddl)])
    return marked.mapInArrow(run, schema)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents the rules keep, with their own columns."""
    own, back = set_aside(docs, ADDED)
    kept = judged(own, references(docs)).filter("kept").select(*[col(c) for c in own.columns])
    return kept.withColumnsRenamed(back)


def quality_digest(docs: DataFrame) -> DataFrame:
    slim = docs.select(col("doc_id").alias("doc_id"), col("lang").alias("lang"), col("text").alias("text"))
    return judged(slim, references(slim)).drop("lang", "text")
