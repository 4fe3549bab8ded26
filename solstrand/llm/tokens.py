"""Token ids in directly addressable files.

Format.  A block holds the ids of consecutive documents.  Ids are split into chunks of `CHUNK` bits,
lowest first.  Level 0 has the first chunk of every id and a bitmap that says whose id goes on;
level 1 has the second chunk of those, and so on.  The chunk of id i in the next level lies at the
number of set bits before i, which a rank directory (set bits before each 512-bit line, as unsigned
32-bit numbers) gives with one line to count.  So any id is read from a few bytes, without decoding
its neighbours.  Numbers are little-endian.  A block is one row of a Parquet table in the shared
folder: any store Spark writes to will do, and a lost task writes its blocks again.
"""

from __future__ import annotations

import re
import sys
import types
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from solstrand.llm.common import col
from solstrand.llm.words import buffers, byte_table, slices, span_hashes
from solstrand.sinks.scratch import scratch_path

CHUNK = 8
LINE = 512
BLOCK_IDS = 1 << 20
CACHE = 1 << 20
_U = np.uint64

BLOCKS = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_starts", pa.list_(pa.int64())),
        ("chunks", pa.list_(pa.binary())),
        ("bitmaps", pa.list_(pa.binary())),
        ("ranks", pa.list_(pa.binary())),
    ]
)
BLOCKS_DDL = (
    "part int, block int, n_ids long, doc_ids array<long>, doc_starts array<long>,"
    " chunks array<binary>, bitmaps array<binary>, ranks array<binary>"
)


class Levels(NamedTuple):
    chunks: list[np.ndarray]  # uint8 per level
    bitmaps: list[np.ndarray]  # uint8, eight flags each, lowest bit first
    ranks: list[np.ndarray]  # uint32, set bits before each line


def encode_levels(ids: np.ndarray) -> Levels:
    out = Levels([], [], [])
    rest = np.asarray(ids, np.uint32)
    while True:
        out.chunks.append((rest & 0xFF).astype(np.uint8))
        rest = rest >> CHUNK
        more = rest > 0
        flags = np.packbits(more, bitorder="little")
        lines = np.add.reduceat(more, np.arange(0, len(more), LINE)) if len(more) else np.zeros(0, int)
        out.bitmaps.append(flags)
        out.ranks.append((np.cumsum(lines) - lines).astype("<u4"))
        rest = rest[more]
        if not len(rest):
            return out


def lookup(levels: Levels, at: np.ndarray) -> np.ndarray:
    """The ids at the given places; only the lines they lie in are counted."""
    at = np.asarray(at, np.int64)
    out = np.zeros(len(at), np.uint32)
    todo = np.arange(len(at))
    for depth, (chunk, flags, ranks) in enumerate(zip(*levels, strict=True)):
        out[todo] |= chunk[at].astype(np.uint32) << np.uint32(CHUNK * depth)
        more = (flags[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
        todo, at = todo[more], at[more]
        if not len(todo):
            break
        # Set bits before each place: those of earlier lines, and of earlier bytes in its own line.
        line = at // LINE
        window = line[:, None] * (LINE // 8) + np.arange(LINE // 8)
        inside = np.where(window < (at >> 3)[:, None], flags[np.minimum(window, len(flags) - 1)], 0)
        tail = flags[at >> 3] & ((1 << (at & 7)) - 1).astype(np.uint8)
        at = ranks[line] + np.bitwise_count(inside).sum(1, dtype=np.int64) + np.bitwise_count(tail)
    return out


def decode_levels(levels: Levels, a: int, b: int) -> np.ndarray:
    """Ids a to b - 1: one rank look-up per level, then a run of each level."""
    out = np.zeros(b - a, np.uint32)
    todo = np.arange(b - a)
    for depth, (chunk, flags, ranks) in enumerate(zip(*levels, strict=True)):
        out[todo] |= chunk[a:b].astype(np.uint32) << np.uint32(CHUNK * depth)
        if a >= b:
            break
        first = a // LINE * LINE
        bits = np.unpackbits(flags[first // 8 : (b + 7) // 8], bitorder="little")[: b - first]
        start = int(ranks[first // LINE]) + int(bits[: a - first].sum())
        more = bits[a - first :] > 0
        todo = todo[more]
        a, b = start, start + len(todo)
        if not len(todo):
            break
    return out


class _Encoder:
    """Ids of whole texts, from the ids of their distinct chunks.

    Byte-level BPE never merges across a space that a printing character follows: the space
    opens a new pre-token.  Nor does it merge an ASCII letter with the ASCII mark behind it.  Texts are
    cut at such spaces and marks, each distinct chunk is encoded once
    by the tokenizer, and the texts' ids are put together again.  Where the next byte could start
    white space outside ASCII the text is not cut.  The literal of an added token (`<|endoftext|>`) in
    a text is a chunk by itself, since the tokenizer takes such literals out before anything else.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError("an added token that looks at its neighbours cannot be cut out of a text")
        # The longest of those that begin at the first place wins.
        names = sorted((t.content.encode() for t in added if t.content), key=len, reverse=True)
        self.literals = re.compile(b"|".join(map(re.escape, names))) if names else None
        # A literal with a space could arise between chunks that are put into one text.
        self.join = not any(b" " in name for name in names)
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, _U)  # chunk hashes in order
        self.place = np.zeros(0, np.int64)  # row of each in `starts`
        self.starts = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, at: np.ndarray, codes: np.ndarray, opened: np.ndarray, chunks: list[str]) -> None:
        """Encodes new chunks; those opened by a space in one text, since they meet at cuts anyway."""
        opened = opened & self.join
        joined, alone = np.flatnonzero(opened), np.flatnonzero(~opened)
        text = "".join([chunks[i] for i in joined.tolist()])
        widths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        got = self.tokenizer.encode(text, add_special_tokens=False)
        ids = np.array(got.ids, np.uint32)
        begin = np.array(got.offsets, np.int64).reshape(-1, 2)[:, 0]
        edges = np.searchsorted(begin, np.concatenate([[0], np.cumsum(widths[joined])]))
        rest = [
            e.ids
            for e in self.tokenizer.encode_batch([chunks[i] for i in alone.tolist()], add_special_tokens=False)
        ]
        sizes = np.concatenate([np.diff(edges), np.fromiter(map(len, rest), np.int64, len(rest))])
        n = len(self.starts) - 1
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, ids, np.array([i for x in rest for i in x], np.uint32)])
        places = np.empty(len(chunks), np.int64)
        places[np.concatenate([joined, alone])] = np.arange(n, n + len(chunks))
        self.known = np.insert(self.known, at, codes)
        self.place = np.insert(self.place, at, places)

    def encode(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, and the row boundaries in them."""
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        # Printing bytes after which no white space can begin; C2, E1, E2 and E3 may open some.
        opens = byte_table(bytes(b for b in range(0x21, 0x100) if b not in (0x7F, 0xC2, 0xE1, 0xE2, 0xE3)))
        letter = byte_table(bytes(range(65, 91)) + bytes(range(97, 123)))
        mark = byte_table(bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum()))
        cut = np.zeros(len(raw), bool)
        cut[:-1] = (raw[:-1] == 0x20) & opens[raw[1:]]
        by_space = cut.copy()
        cut[1:] |= letter[raw[:-1]] & mark[raw[1:]]
        cut[bounds[:-1][bounds[:-1] < len(raw)]] = True
        data = raw.tobytes()
        if self.literals and self.literals.search(data):
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                for found in self.literals.finditer(data, a, b):
                    cut[found.start() : found.end()] = by_space[found.start() : found.end()] = False
                    cut[found.start()] = True
                    cut[found.end() : found.end() + 1] = True
        start = np.flatnonzero(cut)
        cut_by_space = by_space[start]
        end = np.append(start[1:], len(raw))
        codes = span_hashes(raw, start, end)
        unique, first, which = np.unique(codes, return_index=True, return_inverse=True)
        if len(self.known) > CACHE:
            self.forget()
        at = np.searchsorted(self.known, unique)
        new = np.ones(len(unique), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != unique[inside]
        if new.any():
            spans = first[new]
            self._learn(
                at[new],
                unique[new],
                (raw[start[spans]] == 0x20) & cut_by_space[spans],
                [data[a:b].decode("utf-8", "replace") for a, b in zip(start[spans], end[spans], strict=True)],
            )
        place = self.place[np.searchsorted(self.known, unique)][which]
        size = (self.starts[place + 1] - self.starts[place]).astype(np.int64)
        total = np.concatenate([[0], np.cumsum(size)])
        source = np.arange(total[-1]) + np.repeat(self.starts[place] - total[:-1], size)
        return self.ids[source], total[np.searchsorted(start, bounds)]


def _worker_encoder(path: str) -> _Encoder:
    """The encoder of this Python worker process: chunks it has met serve its later tasks too."""
    state = vars(sys.modules.setdefault("solstrand_worker_state", types.ModuleType("solstrand_worker_state")))
    if path not in state:
        state[path] = _Encoder(path)
    return state[path]


def _pack(part: int, block: int, docs: list[int | None], starts: list[int], ids: np.ndarray) -> dict:
    levels = encode_levels(ids)
    return {
        "part": part,
        "block": block,
        "n_ids": len(ids),
        "doc_ids": docs,
        "doc_starts": starts,
        "chunks": [x.tobytes() for x in levels.chunks],
        "bitmaps": [x.tobytes() for x in levels.bitmaps],
        "ranks": [x.tobytes() for x in levels.ranks],
    }


def _encoder_of(tokenizer: str, end_id: int):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, block = _worker_encoder(tokenizer), TaskContext.get().partitionId(), 0
        docs: list = []
        starts: list = []
        parts: list = []
        size = 0
        for batch in slices(batches, "text"):
            raw, bounds = buffers(batch.column("text"))
            ids, at = encoder.encode(raw, bounds)
            sizes = np.diff(at)
            n = len(sizes)
            # Room for the end id behind each document.
            places = at[:-1] + np.arange(n)
            out = np.full(len(ids) + n, end_id, np.uint32)
            out[np.arange(len(ids)) + np.repeat(np.arange(n), sizes)] = ids
            docs += batch.column("doc_id").to_pylist()
            starts += (places + size).tolist()
            parts.append(out)
            size += len(out)
            if size >= BLOCK_IDS:
                row = _pack(part, block, docs, starts, np.concatenate(parts))
                yield pa.RecordBatch.from_pylist([row], BLOCKS)
                docs, starts, parts, size, block = [], [], [], 0, block + 1
        if docs:
            row = _pack(part, block, docs, starts, np.concatenate(parts))
            yield pa.RecordBatch.from_pylist([row], BLOCKS)

    return encoded


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2) -> None:
    """Writes the ids of all documents, ordered by `doc_id`, as blocks into `folder`.

    `docs` needs `doc_id` and `text`; a NULL text is empty and gives the end id alone.  Documents
    without id come first; equal ids are ordered by their text's checksum.  Each range of ids is
    one task, and the range number is the block's `part`.
    """
    slim = docs.select(col("doc_id").alias("doc_id"), F.coalesce(col("text"), F.lit("")).alias("text"))
    tie = F.crc32(F.encode("text", "UTF-8"))
    (
        slim.withColumn("tie", tie)
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), "tie")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
        .select("doc_id", "text")
        .mapInArrow(_encoder_of(tokenizer, end_id), BLOCKS_DDL)
        .write.parquet(folder)
    )


def levels_of(row: dict) -> Levels:
    return Levels(
        [np.frombuffer(x, np.uint8) for x in row["chunks"]],
        [np.frombuffer(x, np.uint8) for x in row["bitmaps"]],
        [np.frombuffer(x, "<u4") for x in row["ranks"]],
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
            levels = levels_of(row)
            ends = [*row["doc_starts"][1:], row["n_ids"]]
            spans = list(zip(row["doc_starts"], ends, strict=True))
            crcs = [zlib.crc32(decode_levels(levels, a, b).astype("<u4").tobytes()) for a, b in spans]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([row["part"]] * len(spans), pa.int32()),
                    "block": pa.array([row["block"]] * len(spans), pa.int32()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "local": pa.array(row["doc_starts"], pa.int64()),
                    "n_tokens": pa.array([b - a for a, b in spans], pa.int64()),
                    "ids_crc32": pa.array(crcs, pa.int64()),
                }
            )


def read_digest(blocks: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from the blocks.

    The blocks' starts are running sums of their sizes: first within a part, then over the parts,
    of which there is one per task that wrote.
    """
    sizes = blocks.select("part", "block", "n_ids")
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sizes.withColumn("in_part", F.coalesce(F.sum("n_ids").over(within), F.lit(0)))
        .join(parts.select("part", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before")), "part")
        .select("part", "block", (F.col("before") + F.col("in_part")).alias("first"))
    )
    found = blocks.mapInArrow(
        _digests, "part int, block int, doc_id long, local long, n_tokens long, ids_crc32 long"
    )
    return found.join(starts, ["part", "block"]).select(
        "doc_id", (F.col("first") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_at(blocks: DataFrame, places: DataFrame) -> DataFrame:
    """(part, block, place, id) for wanted places: random access through the rank directories."""
    wanted = places.groupBy("part", "block").agg(F.collect_set("place").alias("places"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = np.array(sorted(row["places"]), np.int64)
                ids = lookup(levels_of(row), at)
                n = len(at)
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([row["part"]] * n, pa.int32()),
                        "block": pa.array([row["block"]] * n, pa.int32()),
                        "place": pa.array(at),
                        "id": pa.array(ids.astype(np.int64)),
                    }
                )

    joined = blocks.select("part", "block", "chunks", "bitmaps", "ranks").join(wanted, ["part", "block"])
    return joined.mapInArrow(read, "part int, block int, place long, id long")


def document_ids(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Writes the ids of `docs` into the shared folder and returns their digest read from there."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-ids")
    write_ids(docs, folder, tokenizer, end_id)
    return read_digest(spark.read.schema(BLOCKS_DDL).parquet(folder))
