"""Packing token sequences: concatenate all documents and cut at fixed widths.

Two passes. The first encodes each document once and stores its ids with the count of ids before
it in its partition. Sums of the partition totals then place every partition in one global
sequence, and the second pass cuts each document at the multiples of the width that it crosses:
every cut leaves a piece on either side. Nothing is shuffled but one total a partition.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .shared import need, slices, stored

ENCODED = "part int, before long, doc_id long, n_tokens long, wide boolean, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def encoded(docs: DataFrame, vocabulary: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of each document with end_id appended, two bytes each where they fit; null texts are empty.

    ``before`` counts the ids of the partition's earlier rows. Not stored: store it before use.
    """
    need(docs, doc_id, text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = tokens.encoder(vocabulary), TaskContext.get().partitionId(), 0
        for batch in slices(batches, limit=tokens.SLICE):
            flat, bounds = tokens.with_end(*encoder.encode(batch.column(1)), end_id)
            sizes = np.diff(bounds)
            wide = bool(flat.max() >> 16)
            width, data = (4, flat.tobytes()) if wide else (2, flat.astype("<u2").tobytes())
            held = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer((bounds * width).astype("<i4").tobytes()), pa.py_buffer(data)])
            n = len(sizes)
            yield pa.record_batch([pa.array(np.full(n, part, "i4")), pa.array(before + bounds[:-1]), batch.column(0).cast("int64"), pa.array(sizes), pa.array(np.full(n, wide)), held], ["part", "before", "doc_id", "n_tokens", "wide", "ids"])
            before += int(bounds[-1])

    return docs.select(doc_id, text).mapInArrow(run, ENCODED)


def bases(table: DataFrame, order: list[str], size: str) -> DataFrame:
    """order columns, base: the sum of ``size`` over everything before, one row a partition or file."""
    totals = table.groupBy(*order).agg(F.sum(size).alias("_total"))
    return totals.select(*order, F.coalesce(F.sum("_total").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))


def cut(table: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3, 1 << 20):
            rows = []
            for doc, n, wide, ids, at in zip(*(batch.column(i).to_pylist() for i in range(5))):
                ids = np.frombuffer(ids, "<u4" if wide else "<u2").astype("<u4")
                for cutoff in range(at // width, (at + n - 1) // width + 1):
                    lo, hi = max(at, cutoff * width), min(at + n, cutoff * width + width)
                    piece = ids[lo - at : hi - at].tobytes()
                    rows.append((doc, lo - at, hi - lo, zlib.crc32(piece), n, cutoff, lo - cutoff * width, piece))
            kinds = [pa.int64()] * 7 + [pa.binary()]
            yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], PIECES.replace(" long", "").replace(" binary", "").split(", "))

    return table.select("doc_id", "n_tokens", "wide", "ids", F.col("at")).mapInArrow(run, PIECES)


def pack(docs: DataFrame, vocabulary: str | None = None, width: int = 2048, end_id: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of documents in sequences of ``width`` ids; only the last sequence can be shorter.

    One row per piece: doc_id, start (ids of the document before it), length, ids_crc32,
    doc_tokens (with the end id), sequence_id, offset in the sequence, ids (little-endian unsigned
    32-bit). Null or empty texts give the end id alone; repeated rows are packed once each; a null
    doc_id stays null; an empty table gives no rows; other columns are ignored. The base of each
    input partition is broadcast: one row of 12 bytes for each.
    """
    table = stored(encoded(docs, vocabulary or tokens.vocabulary_path(), end_id, doc_id, text), "encoded")
    placed = table.join(F.broadcast(bases(table, ["part"], "n_tokens")), "part").withColumn("at", F.col("base") + F.col("before"))
    return cut(placed, width)
