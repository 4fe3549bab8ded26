"""Words and their hashes for whole Arrow columns at a time, in NumPy.

A word is a run of bytes other than space and 0x09-0x0D; those bytes never occur inside a UTF-8
sequence, so words are found on bytes.  Texts are worked off in slices of about a mebibyte, and
a longer text in pieces of that size cut between words, so memory per byte stays small.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
_U = np.uint64
# Odd multiplier of the polynomial hash over the few words of a shingle.
_WORD_BASE = 0xD1342543DE82EF95
# Longer spans of bytes are hashed one by one.
_LONG = 256
_POWERS: dict[int, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix finalizer)."""
    x = x.astype(_U)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _POWERS or len(_POWERS[base]) < n:
        steps = np.full(max(n, SLICE + 4096), base, _U)
        steps[0] = 1
        _POWERS[base] = np.multiply.accumulate(steps)
    return _POWERS[base]


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of bytes.

    Eight bytes at a time go into the state and through a bijection, so parts of a span cannot be
    swapped without a trace, as they can in sums of powers modulo 2^64.
    """
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[: len(raw)] = raw
    lanes = np.ndarray((len(raw) + 1,), "<u8", padded.data, 0, (1,))  # eight bytes from each byte on
    kept = np.array([(1 << 8 * n) - 1 for n in range(9)], _U)
    left = np.asarray(end - start, np.int64)
    out = mixed(left.astype(_U) + _U(_WORD_BASE))
    alive = np.flatnonzero(left <= _LONG)
    at, left_alive = start[alive], left[alive]
    while len(alive):
        out[alive] = mixed(out[alive] ^ (lanes[at] & kept[np.minimum(left_alive, 8)]))
        more = left_alive > 8
        alive, at, left_alive = alive[more], at[more] + 8, left_alive[more] - 8
    for i in np.flatnonzero(left > _LONG).tolist():
        whole = hashlib.blake2b(raw[start[i] : end[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(whole, "little")
    return out


def byte_table(hit: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(hit)] = True
    return out


def _separators() -> np.ndarray:
    return byte_table(b"\x20\t\n\x0b\x0c\r")


def _lower(part: np.ndarray) -> np.ndarray:
    return part + ((part - np.uint8(65)) < 26).view(np.uint8) * np.uint8(32)


def _inside(part: np.ndarray) -> np.ndarray:
    """Whether each byte belongs to a word: comparisons, which are faster than a table."""
    return (part != 0x20) & ((part - np.uint8(9)) > 4)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row boundaries; NULL reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(bounds):
        bounds = np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The batches again, cut into runs of rows with about SLICE bytes of text."""
    for batch in batches:
        _, bounds = buffers(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(bounds, bounds[at] + SLICE, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


class Words(NamedTuple):
    code: np.ndarray  # hash of each word
    start: np.ndarray  # first byte, counted from the first row's first byte
    end: np.ndarray  # byte after the last
    first: np.ndarray  # number of the first word of each row, and the number of words


def _pieces(raw: np.ndarray, bounds: np.ndarray, gap: np.ndarray) -> Iterator[tuple[int, int]]:
    """Spans of about SLICE bytes that end after a separator or at the end of a row."""
    at, n = 0, len(raw)
    ends = set(bounds.tolist()) if n > 2 * SLICE else ()
    while at < n:
        to = min(at + SLICE, n)
        if n <= 2 * SLICE:
            to = n
        while to < n and to not in ends and not gap[raw[to]]:
            to += 1
        yield at, to
        at = to


def words(raw: np.ndarray, bounds: np.ndarray, lower: bool = False) -> Words:
    gap = _separators()
    codes, starts, ends = [], [], []
    for a, b in _pieces(raw, bounds, gap):
        part = _lower(raw[a:b]) if lower else raw[a:b]
        inside = _inside(part)
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        edges = bounds[(bounds > a) & (bounds < b)] - a
        begin[edges] = inside[edges]
        after = np.empty(b - a, bool)  # the word's last byte
        after[-1:] = inside[-1:]
        after[:-1] = inside[:-1] & (~inside[1:] | begin[1:])
        s, e = np.flatnonzero(begin), np.flatnonzero(after) + 1
        codes.append(span_hashes(part, s, e))
        starts.append(s + a)
        ends.append(e + a)
    if not codes:
        none = np.zeros(0, np.int64)
        return Words(none.astype(_U), none, none, np.zeros(len(bounds), np.int64))
    start = np.concatenate(starts)
    return Words(np.concatenate(codes), start, np.concatenate(ends), np.searchsorted(start, bounds))


def grams(code: np.ndarray, k: int) -> np.ndarray:
    """The hash of the k words from each word on; the last k - 1 entries are left out."""
    n = len(code) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.zeros(n, _U)
    for j in range(k):
        out *= _U(_WORD_BASE)
        out += code[j : j + n]
    return mixed(out)


def long_grams(code: np.ndarray, k: int) -> np.ndarray:
    """As `grams`, by prefix sums: the work does not grow with k."""
    n = len(code) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    total = np.zeros(len(code) + 1, _U)
    up, down = _powers(_WORD_BASE, len(code)), _powers(pow(_WORD_BASE, -1, 1 << 64), n)
    np.cumsum(code * up[: len(code)], out=total[1:])
    return mixed((total[k:] - total[:n]) * down[:n])


def gram_rows(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For `grams` of a whole slice: the row of each gram, and whether it lies in one row."""
    counts = np.diff(first)
    row = np.repeat(np.arange(len(counts)), counts)
    n = max(0, len(row) - k + 1)
    return row[:n], row[:n] == row[k - 1 :] if n else np.zeros(0, bool)


def text_sets(code: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct k-word shingles of all rows, in order within each, and the rows' boundaries.

    A row of fewer words has one shingle, a row without words none.
    """
    counts, found = np.diff(first), grams(code, k)
    whole = np.flatnonzero(counts >= k)
    starts, ends = first[:-1][whole], first[1:][whole] - k + 1
    edge = np.zeros(len(found) + 1, np.int8)
    edge[starts] += 1
    edge[ends] -= 1  # a row's last grams reach into the next one
    kept = np.cumsum(edge[:-1], dtype=np.int8).view(bool)
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        found[a:b].sort()
    kept[1:] &= found[1:] != found[:-1]
    kept[starts] = True
    at = np.flatnonzero(kept)
    values, bounds = found[at], np.searchsorted(at, first)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        single = [grams(code[first[r] : first[r + 1]], int(counts[r])) for r in short.tolist()]
        values = np.insert(values, bounds[short], np.concatenate(single))
        bounds = bounds + np.searchsorted(short, np.arange(len(bounds)))
    return values, bounds
