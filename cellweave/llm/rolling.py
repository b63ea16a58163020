"""Numpy kernels over the bytes of many texts at once: words, polynomial hashes, window minima.

All hashes are polynomials modulo 2^64 over randomised symbols, so a hash of any stretch comes
from two prefix sums. ``Texts`` is the concatenation of the texts of one Arrow slice.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Odd bases of the polynomials (of bytes, of words) and the multipliers of the finaliser.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
MIX_A, MIX_B = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * MIX_A
    x = (x ^ (x >> U(27))) * MIX_B
    return x ^ (x >> U(31))


SYMBOL = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True


@lru_cache(8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up, down = np.full(size, base, U), np.full(size, inverse, U)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i for i up to n at least."""
    return _powers(base, 1 << max(20, int(n).bit_length()))


class Prefix:
    """Hashes of any stretch of a sequence of 64-bit symbols."""

    def __init__(self, symbols: np.ndarray, base: int):
        up, self.down = powers(base, len(symbols) + 1)
        self.sums = np.zeros(len(symbols) + 1, U)
        np.cumsum(symbols * up[: len(symbols)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(U))

    def grams(self, k: int) -> np.ndarray:
        """Hashes of every stretch of k symbols, by start."""
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:n]) * self.down[:n]) if n > 0 else np.zeros(0, U)


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8)[at[0] : at[-1]] if held is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return data, at - at[0]


def words_of(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte bounds of each run of bytes that are no gaps, and each text's first word."""
    solid = np.zeros(len(data) + 1, bool)
    solid[:-1] = ~gaps[data]
    begins = solid[:-1].copy()
    begins[1:] &= ~solid[:-2]
    inner = offsets[1:-1]
    begins[inner[inner < len(data)]] = solid[:-1][inner[inner < len(data)]]  # a text's first byte never continues a word
    ends = solid[:-1] & ~solid[1:]
    last = inner[(inner > 0)] - 1
    ends[last] = solid[:-1][last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets)


def sliding(op: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """op over x[i : i + width] for every i that has them all."""
    step = 1
    while 2 * step <= width:
        x = op(x[:-step], x[step:])
        step *= 2
    rest = width - step
    return op(x[: len(x) - rest], x[rest:]) if rest else x


class Runs:
    """Runs of neighbouring windows that share the least gram: where equal windows must meet.

    Window: ``length`` symbols of one text. Its anchor: the least hash among its grams of ``gram``
    symbols, which depends on the window alone, so equal windows have equal anchors. A run: the
    longest stretch of windows with one anchor, cut at ``most``. Arrays: start (symbol), size
    (windows), text, anchor and twice (two equal grams that were least somewhere lie in the run, so
    its own windows may repeat).
    """

    def __init__(self, prefix: Prefix, first: np.ndarray, length: int, gram: int, most: int = 256):
        n, width = int(first[-1]), length - gram + 1
        counts = np.maximum(np.diff(first) - length + 1, 0)
        self.start = self.size = self.text = np.zeros(0, np.int64)
        self.anchor = np.zeros(0, U)
        self.twice = np.zeros(0, bool)
        if not counts.any():
            return
        grams = prefix.grams(gram)
        least = sliding(np.minimum, grams, width)
        valid = np.zeros(n + 1, np.int32)
        np.add.at(valid, first[:-1][counts > 0], 1)
        np.add.at(valid, (first[:-1] + counts)[counts > 0], -1)
        valid = np.cumsum(valid)[: len(least)] > 0
        fresh = valid.copy()
        fresh[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
        start = np.flatnonzero(fresh)
        stop = np.flatnonzero(valid & ~np.r_[valid[1:] & (least[1:] == least[:-1]), False]) + 1
        size = stop - start
        if (size > most).any():
            parts = -(-size // most)
            nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            start, stop = np.repeat(start, parts) + nth * most, np.repeat(stop, parts)
            size = np.minimum(stop - start, most)
        self.start, self.size = start, size
        self.text = np.searchsorted(first, start, side="right") - 1
        self.anchor = least[start]
        shown = np.where(valid, least, U(0))
        highest = sliding(np.maximum, np.r_[np.zeros(width - 1, U), shown, np.zeros(width - 1, U)], width)[: len(grams)]
        at = np.flatnonzero((grams == highest) & (highest > 0))
        near = np.flatnonzero((grams[at[1:]] == grams[at[:-1]]) & (at[1:] - at[:-1] <= width)) if len(at) > 1 else np.zeros(0, np.int64)
        left, right = np.r_[at[near], n + length], np.r_[at[near + 1] if len(near) else near, 2 * n + 4 * length]
        which = np.searchsorted(left[:-1], start)
        self.twice = right[which] <= start + size - 1 + width - 1


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All of start[i] .. start[i] + size[i] - 1, in turn."""
    total = int(size.sum())
    return np.arange(total) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches as maximal ones, in order; touching ones join."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.r_[True, start[1:] > end[:-1]]
    return start[new], end[np.r_[np.flatnonzero(new)[1:] - 1, len(end) - 1]]
