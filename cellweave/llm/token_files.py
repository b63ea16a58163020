"""Token files: Simple-8b words in blocks, written in ascending document order and read back.

A 64-bit word holds a 4-bit selector and as many ids as fit at its width, so decoding a block is
a few shifts over whole arrays. Values of 60 bits and more are kept in the block's list of escapes.

File: magic; blocks; documents (id and token count, 8 bytes each); index (offset, words, escapes,
ids per block); footer (documents' offset, documents, blocks, magic). A block: words, then
escapes as (position, value). All integers are little-endian and 8 bytes wide.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files, tokens
from .packing import bases
from .shared import need, scratch, slices, stored

MAGIC = b"IDS8B\x00\x00\x01"
# Fixed values of the Simple-8b format: ids per word and bits per id, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
LIMITS = np.array([1 << int(b) for b in BITS[1:]], np.uint64)
ESCAPE = np.uint64(1 << 60)
#: Ids in a block, and ids after which a file is closed.
BLOCK_IDS, FILE_IDS = 1 << 16, 1 << 23


def kinds_of(ids: np.ndarray) -> np.ndarray:
    """The narrowest selector, from 1 up, whose width holds each value; 0 for zeros."""
    return np.where(ids == 0, 0, 1 + np.searchsorted(LIMITS, ids, side="right")).astype(np.int8)


KINDS = kinds_of(np.arange(1 << 16, dtype=np.uint64))


def pack_words(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, escapes) of any unsigned 64-bit values; the last word may be filled up with zeros."""
    ids = ids.astype(np.uint64)
    at = np.flatnonzero(ids >= ESCAPE)
    escapes = np.stack([at.astype(np.uint64), ids[at]], 1)
    if len(at):
        ids = ids.copy()
        ids[at] = 0
    n = len(ids)
    kind = np.zeros(n + 240, np.int8)
    kind[:n] = KINDS[ids] if n and ids.max() < len(KINDS) else kinds_of(ids)
    chosen = np.full(n, 15, np.int8)
    most, held = kind, 1
    for selector in range(14, -1, -1):
        count = int(COUNTS[selector])
        most = np.maximum(most[: len(most) - (count - held)], most[count - held :])
        held = count
        np.copyto(chosen, selector, where=most[:n] <= (selector if selector > 1 else 0), casting="unsafe")
    steps, at, starts = COUNTS[chosen].tolist(), 0, []
    while at < n:
        starts.append(at)
        at += steps[at]
    starts = np.array(starts, np.int64)
    selectors = chosen[starts] if n else np.zeros(0, np.int8)
    padded = np.r_[ids, np.zeros(240, np.uint64)]
    words = selectors.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(selectors[selectors > 1]):
        rows = np.flatnonzero(selectors == selector)
        shifts = (np.arange(COUNTS[selector]) * BITS[selector]).astype(np.uint64)
        words[rows] |= np.bitwise_or.reduce(padded[starts[rows][:, None] + np.arange(COUNTS[selector])] << shifts, axis=1)
    return words, escapes


def unpack_words(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    selectors = (words >> np.uint64(60)).astype(np.int64)
    starts = np.cumsum(COUNTS[selectors]) - COUNTS[selectors]
    out = np.zeros(n + 240, np.uint64)
    for selector in np.unique(selectors[selectors > 1]):
        rows = np.flatnonzero(selectors == selector)
        shifts = (np.arange(COUNTS[selector]) * BITS[selector]).astype(np.uint64)
        out[starts[rows][:, None] + np.arange(COUNTS[selector])] = (words[rows][:, None] >> shifts) & np.uint64((1 << int(BITS[selector])) - 1)
    out[escapes[:, 0].astype(np.int64)] = escapes[:, 1]
    return out[:n]


class Writer:
    """One file at a time; ``close`` gives its row of the manifest."""

    def __init__(self, folder: str, part: int, nth: int):
        self.path, self.stream = files.create(folder, f"tokens-{part:06d}-{nth:04d}.s8b")
        self.stream.write(MAGIC)
        self.at, self.index, self.docs, self.held, self.held_n, self.ids = len(MAGIC), [], [], [], 0, 0
        self.part, self.nth = part, nth

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.held.append(ids)
        self.held_n += len(ids)
        if self.held_n >= BLOCK_IDS:
            self._blocks(False)

    def _blocks(self, all_of_it: bool) -> None:
        flat = np.concatenate(self.held) if self.held else np.zeros(0, "<u4")
        while len(flat) >= BLOCK_IDS or (all_of_it and len(flat)):
            block, flat = flat[:BLOCK_IDS], flat[BLOCK_IDS:]
            words, escapes = pack_words(block)
            self.stream.write(words.astype("<u8").tobytes() + escapes.astype("<u8").tobytes())
            self.index.append((self.at, len(words), len(escapes), len(block)))
            self.at += 8 * len(words) + 16 * len(escapes)
            self.ids += len(block)
        self.held, self.held_n = [flat], len(flat)

    def close(self) -> tuple:
        self._blocks(True)
        self.stream.write(np.array(self.docs, "<i8").tobytes() + np.array(self.index, "<i8").tobytes())
        self.stream.write(np.array([self.at, len(self.docs), len(self.index)], "<i8").tobytes() + MAGIC)
        self.stream.close()
        return self.path, self.part, self.nth, self.ids, len(self.docs)


def read_file(path: str) -> Iterator[tuple[int, int, np.ndarray]]:
    """(doc_id, ids before it in the file, ids) of each document, block by block."""
    with files.reopen(path) as stream:
        size = stream.size()
        foot = stream.read_at(32, size - 32)
        if foot[24:] != MAGIC or stream.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{path} is no token file")
        docs_at, n_docs, n_blocks = np.frombuffer(foot, "<i8", 3).tolist()
        if docs_at + 16 * n_docs + 32 * n_blocks + 32 != size:
            raise ValueError(f"{path} is cut short")
        docs = np.frombuffer(stream.read_at(16 * n_docs, docs_at), "<i8").reshape(-1, 2).tolist()
        index = np.frombuffer(stream.read_at(32 * n_blocks, docs_at + 16 * n_docs), "<i8").reshape(-1, 4).tolist()
        held, before, blocks = np.zeros(0, np.uint64), 0, iter(index)
        for doc_id, n in docs:
            more = [held]
            have = len(held)
            while have < n:
                at, n_words, n_escapes, n_ids = next(blocks)
                raw = np.frombuffer(stream.read_at(8 * n_words + 16 * n_escapes, at), "<u8")
                more.append(unpack_words(raw[:n_words], raw[n_words:].reshape(-1, 2), n_ids))
                have += n_ids
            held = np.concatenate(more) if len(more) > 1 else held
            yield doc_id, before, held[:n]
            held, before = held[n:], before + n


def write_tokens(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes all ids in ascending doc_id order; returns the stored manifest: path, part, nth, n_ids, n_docs.

    Null texts are empty and give the end id alone. Equal doc_ids follow one another in any order;
    null doc_ids are refused. An empty table gives no file.
    """
    need(docs, doc_id, text)
    vocabulary = vocabulary or tokens.vocabulary_path()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, nth, writer = tokens.encoder(vocabulary), TaskContext.get().partitionId(), 0, None
        rows = []
        for batch in slices(batches, limit=tokens.SLICE):
            flat, bounds = tokens.with_end(*encoder.encode(batch.column(1)), end_id)
            for doc, ids in zip(batch.column(0).to_pylist(), np.split(flat, bounds[1:-1])):
                if doc is None:
                    raise ValueError("a document has no doc_id")
                writer = writer or Writer(folder, part, nth)
                writer.add(doc, ids)
                if writer.ids >= FILE_IDS:
                    rows.append(writer.close())
                    writer, nth = None, nth + 1
        if writer:
            rows.append(writer.close())
        if rows:
            yield pa.record_batch([pa.array(x) for x in zip(*rows)], ["path", "part", "nth", "n_ids", "n_docs"])

    ordered = docs.select(doc_id, text).repartitionByRange(doc_id).sortWithinPartitions(doc_id)
    return stored(ordered.mapInArrow(run, "path string, part long, nth long, n_ids long, n_docs long"), "manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files that the manifest names.

    The base of each file is broadcast: one row for some millions of ids.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = [(doc, base + before, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for doc, before, ids in read_file(path)]
                yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*rows)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    spark: SparkSession = manifest.sparkSession
    placed = manifest.join(F.broadcast(bases(manifest, ["part", "nth"], "n_ids")), ["part", "nth"])
    spread = placed.select("path", "base").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, **options) -> DataFrame:
    """Round trip through the files: what ``read_tokens`` finds in what ``write_tokens`` wrote."""
    return read_tokens(write_tokens(docs, scratch(docs.sparkSession, "tokens"), **options))
