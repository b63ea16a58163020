"""Words of many texts as codes of a dictionary, and lossless filters over hashed keys.

``Words`` splits the bytes of one Arrow slice in numpy; Arrow tells the distinct words, so equal codes
mean equal bytes. ``Filter`` is a Bloom filter of bounded size: it may let keys pass that were not put in, but
stops none that was, so what follows it counts exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rolling

#: Text of one numpy step: it holds at most 2^20 words, so codes of pairs and triples fit a long.
STEP_BYTES = 1 << 21
#: Bits of a filter for each key, at most (16 MB, the bound of its broadcast), and the seed of key hashes.
KEY_BITS, MOST_BITS, SEED = 16, 1 << 27, 42
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table_of(*bounds: tuple[int, int]) -> np.ndarray:
    """Which of 256 bytes lie within one of the bounds, ends included."""
    found = np.zeros(256, bool)
    for a, b in bounds:
        found[a : b + 1] = True
    return found


class Words:
    """The runs of bytes that are no gaps, in turn.

    start, end: their bounds in data; first: each text's first word; text: each word's text; codes: each word's
    place among the distinct ones, names; raw: the words' bytes in turn, of which the i-th has bounds[i] to bounds[i + 1].
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray):
        self.data, self.offsets = data, offsets
        self.start, self.end, self.first = rolling.words_of(data, offsets, gaps)
        bounds = np.zeros(len(self.start) + 1, np.int64)
        np.cumsum(self.end - self.start, out=bounds[1:])
        raw = np.ascontiguousarray(data[~gaps[data]])
        listed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.start), [None, pa.py_buffer(bounds), pa.py_buffer(raw)]).dictionary_encode()
        self.raw, self.bounds = raw, bounds
        self.codes, self.names = listed.indices.to_numpy().astype(np.int64), listed.dictionary
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))


def texts_in_steps(column: pa.Array, cuts: np.ndarray, spare: np.ndarray, overlap: int = 0, step: int = STEP_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, offsets, words shown before) of the column's texts, lower-cased A to Z; one long text comes in steps.

    A step ends after a byte of ``cuts``, else of ``spare``; after the latter, the next step shows the last
    ``overlap`` words again. A run without either is not cut.
    """
    data, offsets = rolling.buffer_of(column)
    data = LOWER[data]
    if len(offsets) != 2 or len(data) <= step:
        yield data, offsets, 0
        return
    a, shown = 0, 0
    while a < len(data):
        size = step
        while True:  # the part must hold more words than the next one shows again
            b, whole = _cut(data, a, size, cuts, spare)
            begins = None if whole or not overlap else rolling.words_of(data[a:b], np.array([0, b - a]), cuts | spare)[0]
            if begins is None or len(begins) > overlap:
                break
            size *= 2
        yield data[a:b], np.array([0, b - a]), shown
        a, shown = (b, 0) if begins is None else (a + int(begins[-overlap]), overlap)


def _cut(data: np.ndarray, a: int, size: int, cuts: np.ndarray, spare: np.ndarray) -> tuple[int, bool]:
    """Where a part of about ``size`` bytes from a on ends, and whether no word after it belongs to those before."""
    if len(data) - a <= size:
        return len(data), True
    for table in (cuts, spare):
        at = np.flatnonzero(table[data[a + size // 2 : a + size]])
        if len(at):
            return a + size // 2 + int(at[-1]) + 1, table is cuts
    for c in range(a + size, len(data), size):
        at = np.flatnonzero((cuts | spare)[data[c : c + size]])
        if len(at):
            return c + int(at[0]) + 1, bool(cuts[data[c + int(at[0])]])
    return len(data), True


def hashes(names: list[bytes], seed: int = SEED) -> np.ndarray:
    """XXH64 of each name."""
    return np.fromiter((xxhash.xxh64_intdigest(x, seed) for x in names), np.uint64, len(names))


class Filter:
    """Two bits for each key's 64-bit hash; an empty one lets all pass."""

    def __init__(self, bits: int = 0, words: np.ndarray | None = None):
        self.bits, self.words = bits, words

    def passes(self, keys: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.ones(len(keys), bool)
        found = np.ones(len(keys), bool)
        for half in (keys, keys >> np.uint64(32)):
            at = half & np.uint64(self.bits - 1)
            found &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return found


def filter_of(keys: DataFrame, n: int, column: str = "h") -> Filter:
    """The filter of n hashes (long): its words are united in Spark; the driver gets MOST_BITS at most."""
    bits = 64
    while bits < min(KEY_BITS * n, MOST_BITS):
        bits *= 2
    half = lambda h: h.bitwiseAND(F.lit(bits - 1))
    at = F.explode(F.array(half(F.col(column)), half(F.shiftrightunsigned(column, 32))))
    place = keys.select(at.alias("at")).select(F.shiftright("at", 6).alias("word"), F.col("at").bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    table = place.groupBy("word").agg(F.bit_or(one).alias("mask")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[table["word"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
    return Filter(bits, words)
