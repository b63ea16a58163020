"""Where equal windows of many texts must meet: runs of windows by their least gram.

Every window of a text belongs to one run of neighbouring windows with the same anchor, the least
hash among the window's grams (see ``rolling.Runs``). Equal windows have equal anchors, so only
runs whose anchor occurs again can hold a repeated window. About one row goes out for each half of
a window's length, none for each window. Runs of equal content are one row with a weight from then on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rolling
from .shared import free, slices
from .words import Words

#: Symbols of one long text that are hashed at a time.
LONG = 1 << 20


@dataclass
class Stretch:
    """Symbols of texts: prefix sums of their hashes, first symbol of each text, symbols before in a text that comes in stretches.

    raw, item: bytes of each symbol (a word's hash); own, bounds: the bytes of the words themselves.
    """

    prefix: rolling.Prefix
    first: np.ndarray
    raw: bytes
    item: int
    before: int
    own: bytes = b""
    bounds: np.ndarray | None = None


def stretches(column: pa.Array, unit: str, length: int, most: int | None = None) -> Iterator[Stretch]:
    """The texts as bytes or words. A word's symbol is the XXH3 of its bytes.

    A text of over ``most`` symbols that comes alone is cut into stretches that share length - 1 symbols, so each window
    lies in one; all other columns are one stretch.
    """
    most = most or LONG
    data, offsets = rolling.buffer_of(column)
    alone = len(offsets) == 2 and len(data) > most
    if unit == "byte":
        for a in range(0, len(data) - length + 1, most) if alone else [0]:
            part = data[a : a + most + length - 1] if alone else data
            yield Stretch(rolling.Prefix(rolling.SYMBOL[part], rolling.BYTE_BASE), np.array([0, len(part)]) if alone else offsets, part.tobytes(), 1, a)
        return
    held = Words(data, offsets, rolling.SPACE)
    symbols = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in held.names.to_pylist()), np.uint64, len(held.names))[held.codes]
    n, step = len(symbols), max(most // 8, 1)
    for a in range(0, n - length + 1, step) if alone else [0]:
        b = min(n, a + step + length - 1) if alone else n
        lo, hi = int(held.bounds[a]), int(held.bounds[b])
        yield Stretch(rolling.Prefix(symbols[a:b], rolling.WORD_BASE), np.array([0, b - a]) if alone else held.first, symbols[a:b].tobytes(), 8, a, held.raw[lo:hi].tobytes(), held.bounds[a : b + 1] - lo)


def runs(texts: DataFrame, unit: str, length: int, gram: int, keys: list[str], text: str, content: bool = True) -> DataFrame:
    """keys (longs), start, size, anchor, twice and, if asked for, content (XXH3 of the run's symbols) of all runs of all texts.

    Texts shorter than a window have none.
    """
    names = [*keys, "start", "size", "anchor", "twice", *(["content"] if content else [])]
    kinds = {"size": "int", "twice": "boolean"}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, len(keys)):
            mine = [c.cast("int64").to_numpy(zero_copy_only=False) for c in batch.columns[: len(keys)]]
            for at in stretches(batch.column(len(keys)), unit, length):
                found = rolling.Runs(at.prefix, at.first, length, gram)
                made = [*(x[found.text] for x in mine), found.start - at.first[found.text] + at.before, found.size.astype(np.int32), found.anchor.view(np.int64), found.twice]
                if content:
                    bounds = zip((found.start * at.item).tolist(), ((found.start + found.size + length - 1) * at.item).tolist())
                    made.append(np.array([xxhash.xxh3_64_intdigest(at.raw[a:b]) for a, b in bounds], np.uint64).view(np.int64))
                yield pa.record_batch([pa.array(x) for x in made], names)

    return texts.select(*keys, text).mapInArrow(run, ", ".join(f"{x} {kinds.get(x, 'long')}" for x in names))


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text, and the key (a, b) of a row's text: its doc_id, 0 for null, and the XXH64 of the text.

    Rows with one key have one text, so what holds for the text of one holds for all, whatever their ids are.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return plain.withColumns({"a": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "b": F.xxhash64("text")})


def with_lists(texts: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """doc_id, text, and the row's list column ``parts`` (array of structs), by a join on the key (a, b)."""
    return texts.join(lists, ["a", "b"], how).select("doc_id", "text", "parts")


def columns_of(parts: pa.ListArray, *names: str) -> tuple[np.ndarray, ...]:
    """(row of each entry, then its fields) of a column of lists of structs; null lists are empty."""
    lengths = parts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = parts.flatten()
    return np.repeat(np.arange(len(parts)), lengths), *(flat.field(n).to_numpy(zero_copy_only=False) for n in names)


def window_rows(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """anchor, content, hot, doc_id, hi, nth, window, check of each window of the wanted runs (a, b, start, size, anchor, content, hot, hi).

    Symbols are words. window: the polynomial (Rabin-Karp) hash of its words, from two prefix sums; check: the low half of the XXH3 of
    the words' own bytes; nth: its place in the run.
    """
    lists = wanted.groupBy("a", "b").agg(F.collect_list(F.struct("start", "size", "anchor", "content", "hot", "hi")).alias("parts"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            row, start, size, anchor, content, hot, hi = columns_of(batch.column(2), "start", "size", "anchor", "content", "hot", "hi")
            size = size.astype(np.int64)
            owner, nth = np.repeat(np.arange(len(row)), size), rolling.ranges(np.zeros(len(size), np.int64), size)
            for part in stretches(batch.column(1), "word", length):
                at = (start + part.first[row])[owner] + nth - part.before
                here = np.flatnonzero((at >= 0) & (at < int(part.first[-1]) - length + 1))
                at, mine = at[here], owner[here]
                check = np.array([xxhash.xxh3_64_intdigest(part.own[a:b]) for a, b in zip(part.bounds[at].tolist(), part.bounds[at + length].tolist())], np.uint64)
                check = check.astype(np.uint32).view(np.int32)
                made = [anchor[mine], content[mine], hot[mine].astype(bool), ids[row[mine]], hi[mine], nth[here], part.prefix.of(at, at + length).view(np.int64), check]
                yield pa.record_batch([pa.array(x) for x in made], ["anchor", "content", "hot", "doc_id", "hi", "nth", "window", "check"])

    return with_lists(texts, lists, "inner").mapInArrow(run, "anchor long, content long, hot boolean, doc_id long, hi long, nth long, window long, check int")


class Cut:
    """Texts with stretches taken out. spans: start and stop in symbols of all texts, owner: their text."""

    def __init__(self, column: pa.Array, parts: pa.ListArray, unit: str):
        data, offsets = rolling.buffer_of(column)
        lengths = None
        self.first = offsets
        if unit == "word":
            begin, end, self.first = rolling.words_of(data, offsets)
            lengths = end - begin + 1
            data = np.r_[data, np.uint8(32)][rolling.ranges(begin, lengths)] if len(begin) else data[:0]
            data[np.cumsum(lengths) - 1] = 32
        first = self.first
        row, start, stop = columns_of(parts, "start", "stop")
        start, stop = rolling.merged(start + first[row], stop + first[row]) if len(row) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        if len(start):  # spans of two neighbouring texts that touch are two
            inner = np.unique(first[1:-1])
            which = np.searchsorted(start, inner, side="right") - 1
            cut = inner[(which >= 0) & (start[which] < inner) & (inner < stop[which])]
            start, stop = np.sort(np.r_[start, cut]), np.sort(np.r_[stop, cut])
        self.start, self.stop = start, stop
        self.owner = np.searchsorted(first, start, side="right") - 1
        gone = np.zeros(int(first[-1]) + 1, np.int32)
        np.add.at(gone, start, 1)
        np.add.at(gone, stop, -1)
        gone = np.cumsum(gone)[:-1] > 0
        total = np.r_[0, np.cumsum(gone)]
        self.removed = total[first[1:]] - total[first[:-1]]
        left = data[~gone if lengths is None else ~np.repeat(gone, lengths)].tobytes()
        sizes = np.r_[0, np.cumsum(~gone if lengths is None else np.where(gone, 0, lengths))][first].tolist()
        self.kept = [left[a:b] for a, b in zip(sizes[:-1], sizes[1:])]
        if unit == "word":
            self.kept = [x[:-1] for x in self.kept]


def listed(spans: DataFrame, name: str) -> DataFrame:
    """a, b and the spans (start, stop) of each key, each once: copies of a text under one key have the same."""
    return spans.groupBy("a", "b").agg(F.collect_set(F.struct("start", "stop")).alias(name))


def kept_of(docs: DataFrame, spans: DataFrame, unit: str, doc_id: str, text: str) -> DataFrame:
    """doc_id, n (symbols), n_removed, n_spans (maximal ones), kept_sha256 and spans (array of start
    and stop, in symbols) of every row, when its spans (a, b, start, stop in symbols) are
    taken out; the digest is that of what is left, words joined by one space.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            cut = Cut(batch.column(1), batch.column(2), unit)
            n_spans = np.bincount(cut.owner, minlength=batch.num_rows)
            pairs = pa.StructArray.from_arrays([pa.array(x - cut.first[cut.owner], pa.int64()) for x in (cut.start, cut.stop)], ["start", "stop"])
            made = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n_spans)].astype(np.int32)), pairs)
            digests = [hashlib.sha256(x).hexdigest() for x in cut.kept]
            yield pa.record_batch([batch.column(0).cast("int64"), pa.array(np.diff(cut.first)), pa.array(cut.removed), pa.array(n_spans), pa.array(digests), made], ["doc_id", "n", "n_removed", "n_spans", "kept_sha256", "spans"])

    schema = "doc_id long, n long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,stop:long>>"
    return with_lists(keyed(docs, doc_id, text), listed(spans, "parts"), "left").mapInArrow(run, schema)


def rewritten(docs: DataFrame, spans: DataFrame, unit: str, doc_id: str, text: str) -> DataFrame:
    """docs with every text without its spans (a, b, start, stop). Characters of which a span takes a part go as a whole."""
    held, a, b = free(docs, "parts"), free(docs, "a"), free(docs, "b")
    lists = listed(spans, held).withColumnsRenamed({"a": a, "b": b})
    names, at = docs.columns, docs.columns.index(text)
    dealt = docs.withColumns({a: F.coalesce(F.col(doc_id).cast("long"), F.lit(0)), b: F.xxhash64(text)})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            kept = [x.decode("utf-8", "ignore") for x in Cut(batch.column(at), batch.column(len(names)), unit).kept]
            columns = [pa.array(kept, pa.string()) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.record_batch(columns, names)

    return dealt.join(lists, [a, b], "left").select(*names, held).mapInArrow(run, docs.schema)
