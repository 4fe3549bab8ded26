"""Alignment of two tokenizers over the same bytes, and corpus-wide counts of linked ids.

`space + text` is cut by tokenizer A (byte-level BPE) and by tokenizer B (BPE with byte fallback, which
adds the space itself).  Tokens whose bytes overlap belong to one group.

Groups by pointer jumping: every token points to the overlapping token of the other tokenizer that
ends farthest right, if that ends behind it (of two that end together B's points to A's, which
points to itself).  Replacing each pointer by its target's pointer halves every chain, so after a few
rounds over all tokens at once each points to the last token of its group, which names the group.

Texts are cut into chunks before a space that a printing character follows and no space goes before.
A opens a new pre-token there, and no piece of B has a space behind another character, so neither
tokenizer has a token across such a cut.  Each distinct chunk a task meets is encoded and aligned once.

Counts over the corpus.  Links of a text are stored as (id pair, times).  Pairs that hold a 2^-19th of
all links or more, 2^19 at most, are looked up by broadcast; the rows of all other pairs are joined.
No list of texts, and no pair beyond those, reaches the driver.
"""

from __future__ import annotations

import hashlib
import re
import sys
import types
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solstrand.llm.common import col
from solstrand.llm.words import SLICE, slices
from solstrand.sinks.scratch import written

#: Pairs are looked up by broadcast if they hold this part of all links or more.
COMMON = 1 / (1 << 19)
# Chunks and bytes of chunks that a task remembers.
CACHE, CACHE_BYTES = 1 << 19, 1 << 25
# New chunks that are encoded as one text.
JOINT = 128
# What Unicode calls white space, behind a space: there A may go on with a run of blanks.
_BLANK = re.compile(
    rb"[\x09-\x0D]|\xC2[\x85\xA0]|\xE1\x9A\x80|\xE1\xA0\x8E|\xE2\x80[\x80-\x8A\xA8\xA9\xAF]|\xE2\x81\x9F|\xE3\x80\x80"
)
_ODD = re.compile(rb"^ |  | $| (?:" + _BLANK.pattern + rb")")
_CUT = re.compile(rb"(?<=[^ ]) (?! |" + _BLANK.pattern + rb"|$)")
_LOW = (1 << 32) - 1


def byte_letters() -> dict[str, int]:
    """The letters byte-level BPE writes bytes with: printing ones stand for themselves, others follow."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Tokenizer A: ids and the bytes of each id."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Strings of special tokens in a text are then ordinary text.
        self.tokenizer.encode_special_tokens = True
        letters = byte_letters()
        self.bytes = {
            i: bytes(letters[c] for c in entry)
            for entry, i in self.tokenizer.get_vocab(with_added_tokens=False).items()
        }

    def encode(self, chunks: list[str]) -> list[list[int]]:
        texts = [f" {c}" for c in chunks]
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """Tokenizer B: ids and the bytes of each id; it adds the space in front itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.bytes = {}
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes[i] = bytes([int(piece[3:5], 16)])
            else:
                self.bytes[i] = piece.replace("▁", " ").encode()

    def encode(self, chunks: list[str]) -> list[list[int]]:
        return self.model.encode(chunks, num_threads=1)


def chunks_of(text: bytes) -> list[bytes]:
    """`space + text` cut into chunks that no token crosses, each without its leading space."""
    parts = text.split(b" ")
    if not _ODD.search(text):
        return parts
    first = []
    behind_space = False
    for i, part in enumerate(parts):
        if not i or not (behind_space or not part or _BLANK.match(part)):
            first.append(i)
        behind_space = not part
    return [b" ".join(parts[a:b]) for a, b in zip(first, [*first[1:], len(parts)], strict=True)]


def pieces_of(text: bytes) -> Iterator[bytes]:
    """A text in parts of about SLICE bytes, cut between chunks, without the spaces in between."""
    at = 0
    while at < len(text) or not at:
        cut = _CUT.search(text, at + SLICE) if at + SLICE < len(text) else None
        yield text[at : cut.start()] if cut else text[at:]
        if not cut:
            return
        at = cut.end()


def last_of_group(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """For A's tokens, then B's: the last token of each one's group.

    The tokens of either side follow one another without gaps from offset 0, and both end together;
    `a_end` and `b_end` are the offsets behind them.
    """
    n = len(a_end)
    a_start = np.concatenate([[0], a_end[:-1]])
    b_start = np.concatenate([[0], b_end[:-1]])
    # The last token of the other side that starts before this one ends.
    b_for_a = np.searchsorted(b_start, a_end, "left") - 1
    a_for_b = np.searchsorted(a_start, b_end, "left") - 1
    to = np.concatenate(
        [
            np.where(b_end[b_for_a] > a_end, b_for_a + n, np.arange(n)),
            np.where(a_end[a_for_b] >= b_end, a_for_b, np.arange(n, n + len(b_end))),
        ]
    )
    while True:
        farther = to[to]
        if (farther == to).all():
            return to
        to = farther


class Aligner:
    """Alignments of chunks, remembered; arrays are by chunk, ragged ones between `at[i]` and `at[i + 1]`."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.a_bytes = np.zeros(max(self.a.bytes) + 1, np.int64)
        self.b_bytes = np.zeros(max(self.b.bytes) + 1, np.int64)
        for sizes, known in ((self.a_bytes, self.a.bytes), (self.b_bytes, self.b.bytes)):
            for i, entry in known.items():
                sizes[i] = len(entry)
        # How a token is written within its group, and as the last one of its side.
        self.letters = [f"{i}{mark}" for i in range(len(self.a_bytes)) for mark in ",|"]
        self.letters += [f"{i}{mark}" for i in range(len(self.b_bytes)) for mark in ",;"]
        self.forget()

    def forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.size = 0
        self.groups: list[str] = []
        # Tokens of A and of B and groups of each chunk; -1 where the bytes differ.
        self.counts = np.zeros((0, 3), np.int64)
        self.at = np.zeros(1, np.int64)
        self.pairs = np.zeros(0, np.int64)
        self.ends = np.zeros(0, np.int64)

    def learn(self, chunks: set[bytes]) -> None:
        new = sorted(chunks - self.place.keys())
        if not new:
            return
        # Chunks that are cut apart again if they stand side by side are encoded as one text.
        joint = [c for c in new if c and c[0] != 0x20 and c[-1] != 0x20 and not _BLANK.match(c)]
        encoded = self._encoded_jointly(joint)
        if encoded is None:  # none, or the bytes of some differ
            joint = []
        alone = sorted(set(new) - set(joint)) if len(joint) < len(new) else []
        parts = [(joint, *encoded)] if joint else []
        if alone:
            parts.append(self._encoded_alone(alone))
        for names, a, b, chunk_a, chunk_b, same in parts:
            counts = np.full((len(names), 3), -1, np.int64)
            sizes = np.zeros(len(names), np.int64)
            groups = [""] * len(names)
            pairs = ends = np.zeros(0, np.int64)
            if len(same):
                pairs, ends, n_links, n_groups, texts = self._align(a, b, chunk_a)
                counts[same] = np.stack([np.diff(chunk_a), np.diff(chunk_b), n_groups], 1)
                sizes[same] = n_links
                for i, text in zip(same.tolist(), texts, strict=True):
                    groups[i] = text
            first = len(self.groups)
            self.place |= zip(names, range(first, first + len(names)), strict=True)
            self.size += sum(map(len, names))
            self.groups += groups
            self.counts = np.concatenate([self.counts, counts])
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(sizes)])
            self.pairs = np.concatenate([self.pairs, pairs])
            self.ends = np.concatenate([self.ends, ends])

    def _encoded_jointly(self, chunks: list[bytes]):
        """All ids of A and of B, each chunk's first ones, and which chunks these are: all of them.

        None if there are no chunks, or a tokenizer changes the bytes of any.
        """
        if not chunks:
            return None
        want = b" " + b" ".join(chunks)
        texts = [
            b" ".join(chunks[i : i + JOINT]).decode("utf-8", "replace") for i in range(0, len(chunks), JOINT)
        ]
        a, b = (list(chain.from_iterable(side.encode(texts))) for side in (self.a, self.b))
        edges = np.concatenate([[0], np.cumsum([len(c) + 1 for c in chunks])])
        out = []
        for ids, known, sizes in ((a, self.a.bytes, self.a_bytes), (b, self.b.bytes, self.b_bytes)):
            if b"".join(map(known.__getitem__, ids)) != want:
                return None
            ids = np.array(ids, np.int64)
            out.append((ids, np.searchsorted(np.cumsum(sizes[ids]), edges, "right")))
        (a, chunk_a), (b, chunk_b) = out
        return a, b, chunk_a, chunk_b, np.arange(len(chunks))

    def _encoded_alone(self, chunks: list[bytes]):
        """The same for each chunk by itself; of those whose bytes differ only their number is known."""
        texts = [c.decode("utf-8", "replace") for c in chunks]
        a_ids, b_ids = self.a.encode(texts), self.b.encode(texts)
        same = []
        for i, (chunk, a, b) in enumerate(zip(chunks, a_ids, b_ids, strict=True)):
            want = b" " + chunk
            if b"".join(map(self.a.bytes.__getitem__, a)) == want == b"".join(map(self.b.bytes.__getitem__, b)):
                same.append(i)
        out = [chunks]
        for ids in (a_ids, b_ids):
            out.append(np.array([x for i in same for x in ids[i]], np.int64))
        for ids in (a_ids, b_ids):
            out.append(np.concatenate([[0], np.cumsum([len(ids[i]) for i in same])]).astype(np.int64))
        return (*out, np.array(same, np.int64))

    def _align(self, a: np.ndarray, b: np.ndarray, chunk_a: np.ndarray):
        """Links, their ends within their chunk, links and groups of each chunk, and the groups' text.

        `a` and `b` are the ids of many chunks in order, `chunk_a` the first one of each chunk in `a`.
        """
        n = len(a)
        a_end, b_end = np.cumsum(self.a_bytes[a]), np.cumsum(self.b_bytes[b])
        label = last_of_group(a_end, b_end)
        # A group's tokens follow one another on either side.
        a_opens, b_opens = (np.diff(x, prepend=-1) != 0 for x in (label[:n], label[n:]))
        a_group, b_group = np.cumsum(a_opens) - 1, np.cumsum(b_opens) - 1
        # Tokens as they are written: of each group A's, then B's.
        place = np.concatenate([2 * a_group, 2 * b_group + 1])
        order = np.argsort(place, kind="stable")
        closes = np.append(np.concatenate([a_opens[1:], [True], b_opens[1:]]), True)
        written_as = (np.concatenate([a, b + len(self.a_bytes)]) * 2 + closes)[order].tolist()
        pieces = list(map(self.letters.__getitem__, written_as))
        chunk_g = np.append(a_group[chunk_a[:-1]], a_group[-1] + 1)
        cut = np.searchsorted(place[order], 2 * chunk_g).tolist()
        texts = ["".join(pieces[p:q])[:-1] for p, q in zip(cut[:-1], cut[1:], strict=True)]
        # Links: tokens of either side that end together.
        both = np.intersect1d(a_end, b_end, assume_unique=True)
        linked_a, linked_b = np.searchsorted(a_end, both), np.searchsorted(b_end, both)
        edge = np.concatenate([[0], a_end[chunk_a[1:] - 1]])
        n_links = np.diff(np.searchsorted(both, edge, "right"))
        return (
            (a[linked_a] << 32) | b[linked_b],
            both - np.repeat(edge[:-1], n_links),
            n_links,
            np.diff(chunk_g),
            texts,
        )

    def links(self, found: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The links' `values` of the chunks in order."""
        sizes = self.at[found + 1] - self.at[found]
        total = np.concatenate([[0], np.cumsum(sizes)])
        return values[np.arange(total[-1]) + np.repeat(self.at[found] - total[:-1], sizes)]


def _worker_aligner(a_path: str, b_path: str) -> Aligner:
    """The aligner of this Python worker: chunks it has met serve its later tasks, too."""
    state = vars(sys.modules.setdefault("solstrand_aligners", types.ModuleType("solstrand_aligners")))
    name = f"{a_path}\0{b_path}"
    if name not in state:
        state[name] = Aligner(a_path, b_path)
    return state[name]


class _Text:
    """What is known of a text so far, part by part."""

    def __init__(self, keep: bool):
        self.sha = hashlib.sha256()
        self.counts = np.zeros(3, np.int64)
        self.whole = True
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.groups: list[str] | None = [] if keep else None
        self.ends: list[np.ndarray] = []
        self.offset = 0

    def add(self, aligner: Aligner, chunks: list[bytes]) -> None:
        found = np.fromiter(map(aligner.place.__getitem__, chunks), np.int64, len(chunks))
        counts = aligner.counts[found]
        if not self.whole or (counts[:, 0] < 0).any():
            self.whole = False
            return
        text = ";".join(map(aligner.groups.__getitem__, found.tolist()))
        if self.counts[2]:
            self.sha.update(b";")
        self.sha.update(text.encode())
        self.counts += counts.sum(0)
        pairs, times = np.unique(aligner.links(found, aligner.pairs), return_counts=True)
        self.pairs.append(pairs)
        self.times.append(times)
        if self.groups is not None:
            self.groups.append(text)
            widths = np.array([len(c) + 1 for c in chunks], np.int64)
            before = self.offset + np.cumsum(widths) - widths
            sizes = aligner.at[found + 1] - aligner.at[found]
            self.ends.append(np.repeat(before, sizes) + aligner.links(found, aligner.ends))
            self.offset += int(widths.sum())

    def row(self, row: int, doc_id: int | None) -> dict:
        if not self.whole or not self.counts[2]:
            self.counts[:], self.pairs, self.times = 0, [], []
        pairs = np.concatenate([*self.pairs, np.zeros(0, np.int64)])
        times = np.concatenate([*self.times, np.zeros(0, np.int64)])
        if len(self.pairs) > 1:
            pairs, at = np.unique(pairs, return_inverse=True)
            times = np.bincount(at, times, len(pairs)).astype(np.int64)
        out = {
            "row": row,
            "doc_id": doc_id,
            "n_a": int(self.counts[0]),
            "n_b": int(self.counts[1]),
            "n_groups": int(self.counts[2]),
            "n_links": int(times.sum()),
            "groups_sha256": self.sha.hexdigest() if self.counts[2] else "",
            "pairs": pairs,
            "times": times.astype(np.int32),
        }
        if self.groups is not None:
            out["groups"] = ";".join(self.groups) if self.counts[2] else ""
            out["ends"] = np.concatenate(self.ends) if self.counts[2] else np.zeros(0, np.int64)
        return out


_COLUMNS = {
    "row": (pa.int64(), "long"),
    "doc_id": (pa.int64(), "long"),
    "n_a": (pa.int64(), "long"),
    "n_b": (pa.int64(), "long"),
    "n_groups": (pa.int64(), "long"),
    "n_links": (pa.int64(), "long"),
    "groups_sha256": (pa.string(), "string"),
    "pairs": (pa.list_(pa.int64()), "array<long>"),
    "times": (pa.list_(pa.int32()), "array<int>"),
    "groups": (pa.string(), "string"),
    "ends": (pa.list_(pa.int64()), "array<long>"),
}


def alignments(docs: DataFrame, a_path: str, b_path: str, keep: bool = True) -> DataFrame:
    """A row for each document: what its tokens, groups and links are.

    `docs` needs `doc_id` (integer or NULL) and `text`.  `row` tells rows apart and holds for one
    run only: store the result before it is read twice.  `n_a`, `n_b`, `n_groups`, `n_links` are
    counts; `pairs` are distinct linked ids (A's id * 2^32 + B's) and `times` how often each is linked.
    With `keep` there are `groups` (`a1,a2|b1;a3|b2`, ids in decimal) and `ends`, the byte offsets in
    space + text behind each group.  NULL and empty texts, and those whose bytes a tokenizer changes,
    have no tokens: zeros, empty lists and empty strings.
    """
    names = list(_COLUMNS)[: None if keep else -2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _worker_aligner(a_path, b_path)
        number = TaskContext.get().partitionId() << 33
        for batch in slices(batches, "text"):
            texts = [t.as_py() or b"" for t in batch.column("text").cast(pa.binary())]
            rows = []
            if len(texts) == 1 and len(texts[0]) > 2 * SLICE:
                one = _Text(keep)
                for piece in pieces_of(texts[0]):
                    _reset_if_full(aligner)
                    chunks = chunks_of(piece)
                    aligner.learn(set(chunks))
                    one.add(aligner, chunks)
                states = [one]
            else:
                _reset_if_full(aligner)
                cut = [chunks_of(t) if t else [] for t in texts]
                aligner.learn({c for chunks in cut for c in chunks})
                states = []
                for chunks in cut:
                    states.append(_Text(keep))
                    if chunks:
                        states[-1].add(aligner, chunks)
            for state, doc_id in zip(states, batch.column("doc_id").to_pylist(), strict=True):
                rows.append(state.row(number, doc_id))
                number += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[n] for r in rows], _COLUMNS[n][0]) for n in names], names=names
            )

    slim = docs.select(col("doc_id").cast("long").alias("doc_id"), col("text").alias("text"))
    return slim.mapInArrow(run, ", ".join(f"{n} {_COLUMNS[n][1]}" for n in names))


def _reset_if_full(aligner: Aligner) -> None:
    if len(aligner.groups) > CACHE or aligner.size > CACHE_BYTES:
        aligner.forget()


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): how many links hold each id pair, and whether none of its B id's pairs has more."""
    links = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("at"))
    counts = written(
        links.groupBy(F.col("at.pairs").alias("pair")).agg(F.sum("at.times").alias("n")), "pairs"
    )
    b = F.col("pair").bitwiseAND(F.lit(_LOW))
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    joined = counts.join(most, b == F.col("b"))
    return joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


class _Known(NamedTuple):
    pair: np.ndarray  # in order
    n: np.ndarray
    best: np.ndarray


def _looked_up(known: _Known):
    """Sums over the links whose pair is known; the other pairs go on as lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("pairs")
            pairs = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            times = batch.column("times").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            edges = lists.offsets.to_numpy().astype(np.int64)
            edges = edges - edges[0]
            at = np.minimum(np.searchsorted(known.pair, pairs), max(len(known.pair) - 1, 0))
            hit = known.pair[at] == pairs if len(known.pair) else np.zeros(len(pairs), bool)
            n, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
            n[hit] = known.n[at[hit]]
            best[hit] = known.best[at[hit]]

            def per_row(values: np.ndarray, edges=edges) -> np.ndarray:
                total = np.concatenate([[0], np.cumsum(values)])
                return total[edges[1:]] - total[edges[:-1]]

            rest = pa.array(np.concatenate([[0], np.cumsum(~hit)])[edges].astype(np.int32))
            out = {name: batch.column(name) for name in _DIGEST}
            out["n_best"] = pa.array(per_row(best * times))
            out["count_sum"] = pa.array(per_row(n * times))
            out["pairs"] = pa.ListArray.from_arrays(rest, pa.array(pairs[~hit]))
            out["times"] = pa.ListArray.from_arrays(rest, pa.array(times[~hit]))
            yield pa.RecordBatch.from_pydict(out)

    return run


_DIGEST = ["row", *list(_COLUMNS)[1:7]]


def alignment_digest(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    aligned = written(alignments(docs, a_path, b_path, keep=False), "aligned")
    pairs = written(pair_counts(aligned), "pair-counts")
    total = pairs.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") >= COMMON * total
    table = pairs.filter(often).orderBy("pair").toArrow()
    known = _Known(*(table.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "n", "best")))
    ddl = ", ".join(f"{n} {_COLUMNS[n][1]}" for n in _DIGEST)
    scored = written(
        aligned.mapInArrow(
            _looked_up(known), f"{ddl}, n_best long, count_sum long, pairs array<long>, times array<long>"
        ),
        "scored",
    )
    rare = scored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("at")).select(
        "row", F.col("at.pairs").alias("pair"), F.col("at.times").alias("times")
    )
    more = (
        rare.join(pairs.filter(~often), "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("n") * F.col("times")).alias("more_sum"),
        )
    )
    return scored.join(more, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
