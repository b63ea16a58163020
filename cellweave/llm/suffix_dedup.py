"""Suffix-array dedup of long byte strings by bucket-pointer refinement.

Runs of windows that may repeat (see ``repeats``) are dealt to tasks by anchor, so equal windows
meet. Runs of equal content go once, with the number of copies as weight. Each task sorts the suffixes of
its runs: initial buckets hold equal q-grams, a bucket is refined by sorting its suffixes on the
bucket pointers at the offset that they share already, and the refined pointers are read by the buckets that
come later in the same pass. A window repeats if the windows beside it in the order that
have the same bytes weigh more than one. Anchors with more text than a task should sort are dealt anew, by grams
nearer to the whole window, level by level, until their groups are small; the last level has a group for
each window, so this ends.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats, rolling
from .shared import hot_join, hot_keys, need, slices, stored

#: Text that a task sorts at once, and an anchor may have; bytes of a first bucket; parts of a pass.
SORT_BYTES, GRAM, PARTS = 1 << 20, 8, 4


def grams_of(data: np.ndarray) -> np.ndarray:
    """The GRAM bytes from each place on as one number that sorts like them; zeros follow the end."""
    n = len(data)
    padded = np.r_[data, np.zeros(GRAM, np.uint8)]
    gram = np.zeros(n, np.uint64)
    for j in range(GRAM):
        gram = gram << np.uint64(8) | padded[j : j + n]
    return gram


def suffix_order(data: np.ndarray, depth: int, parts: int = PARTS, passes: list | None = None) -> np.ndarray:
    """The suffixes of data in the order of their first ``depth`` bytes, at least.

    A bucket's pointer is the place of its first suffix. All suffixes of a bucket share ``deep``
    bytes; sorted on the pointers that many bytes on, those that still agree share as many more as the
    bucket they point to. A pass goes through the open buckets in ``parts`` turns, and each turn reads the pointers
    that the turns before it have refined. ``passes`` gets the number of open suffixes at the start of each pass.
    """
    n = len(data)
    gram = grams_of(data)
    order = np.argsort(gram, kind="stable")
    place = np.arange(n)
    pointer = np.empty(n, np.int64)
    pointer[order] = np.maximum.accumulate(np.where(np.r_[True, gram[order][1:] != gram[order][:-1]][:n], place, 0))
    del gram
    deep = np.full(n, GRAM, np.int64)  # by pointer

    def open_places() -> np.ndarray:
        held = pointer[order]
        same = held[1:] == held[:-1]
        crowded = (np.r_[same, False] | np.r_[False, same])[:n]
        return np.flatnonzero(crowded & (deep[held] < depth))

    def refine(places: np.ndarray) -> None:
        members = order[places]
        bucket = pointer[members]
        ahead = members + deep[bucket]
        inside = ahead < n
        later = np.where(inside, pointer[np.minimum(ahead, n - 1)], -1)
        key = bucket * (n + 1) + later + 1
        sort = np.argsort(key, kind="stable")
        members, key, bucket, later = members[sort], key[sort], bucket[sort], later[sort]
        fresh = np.r_[True, key[1:] != key[:-1]]
        refined = np.maximum.accumulate(np.where(fresh, places, 0))
        known = np.where(later >= 0, deep[bucket] + deep[np.maximum(later, 0)], depth)
        order[places] = members
        pointer[members] = refined
        deep[refined[fresh]] = known[fresh]

    while len(places := open_places()):
        if passes is not None:
            passes.append(len(places))
        starts = np.flatnonzero(np.r_[True, np.diff(pointer[order[places]]) != 0])
        cuts = np.unique(starts[np.searchsorted(starts, np.arange(1, parts) * len(places) // parts, side="right") - 1])
        for turn in np.split(places, cuts[cuts > 0]):
            refine(turn)
    return order


def repeated_windows(texts: list[bytes], sizes: np.ndarray, weights: np.ndarray, length: int) -> np.ndarray:
    """For all windows of all texts in turn (sizes[i] windows start in texts[i]): do equal ones weigh over one?

    Neighbours in the order of the suffixes are held against each other byte by byte.
    """
    lengths = np.array([len(x) for x in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    at = rolling.ranges(np.cumsum(lengths) - lengths, sizes)
    number = np.full(len(data), -1)
    number[at] = np.arange(len(at))
    order = suffix_order(data, length)
    order = order[number[order] >= 0]
    gram = grams_of(data)
    alike = np.arange(len(order) - 1)
    for offset in sorted({*range(0, length - GRAM + 1, GRAM), length - GRAM} if length >= GRAM else ()):
        alike = alike[gram[order[alike] + offset] == gram[order[alike + 1] + offset]]
    if length < GRAM:
        for offset in range(length):
            alike = alike[data[order[alike] + offset] == data[order[alike + 1] + offset]]
    new = np.ones(len(order), bool)
    new[alike + 1] = False
    group = np.cumsum(new) - 1
    window = number[order]
    weight = np.bincount(group, weights=np.repeat(weights, sizes)[window])
    again = np.zeros(len(at), bool)
    again[window] = weight[group] > 1
    return again


def run_bytes(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """anchor, content, copies, data: the bytes of the wanted runs (a, b, start, size, anchor, content, copies) of texts (a, b, text)."""
    lists = wanted.groupBy("a", "b").agg(F.collect_list(F.struct("start", "size", "anchor", "content", "copies")).alias("parts"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            data, offsets = rolling.buffer_of(batch.column(0))
            row, start, size, anchor, content, copies = repeats.columns_of(batch.column(1), "start", "size", "anchor", "content", "copies")
            raw, at = data.tobytes(), start + offsets[row]
            ends = (at + size + length - 1).tolist()
            for i in range(0, len(row), 4096):
                j = slice(i, i + 4096)
                held = [raw[x:y] for x, y in zip(at[j].tolist(), ends[j])]
                yield pa.record_batch([pa.array(anchor[j]), pa.array(content[j]), pa.array(copies[j]), pa.array(held, pa.binary())], ["anchor", "content", "copies", "data"])

    found = texts.select("a", "b", "text").join(lists, ["a", "b"])
    return found.select("text", "parts").mapInArrow(run, "anchor long, content long, copies long, data binary")


def compare(rows: DataFrame, length: int) -> DataFrame:
    """anchor, content, lo, hi: repeated stretches of runs, relative to the run; rows are sorted by anchor in each task."""

    def settle(held: list[tuple]) -> pa.RecordBatch:
        sizes = np.array([len(r[3]) - length + 1 for r in held])
        again = repeated_windows([r[3] for r in held], sizes, np.array([r[2] for r in held]), length)
        at = np.flatnonzero(again)
        owner = np.repeat(np.arange(len(held)), sizes)[at]
        new = np.r_[True, (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])][: len(at)]
        last = np.r_[new[1:], True][: len(at)]
        begin = (np.cumsum(sizes) - sizes)[owner]
        anchor, content = (np.array([r[i] for r in held], np.int64)[owner[new]] for i in (0, 1))
        return pa.record_batch([pa.array(anchor), pa.array(content), pa.array((at - begin)[new]), pa.array((at - begin)[last] + length)], ["anchor", "content", "lo", "hi"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, anchor = [], 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != anchor and n > SORT_BYTES:
                    yield settle(held)
                    held, n = [], 0
                held.append(row)
                n, anchor = n + len(row[3]), row[0]
        if held:
            yield settle(held)

    return rows.mapInArrow(run, "anchor long, content long, lo long, hi long")


def spans_of(texts: DataFrame, length: int, gram: int, most: int) -> DataFrame:
    """a, b, start, stop: repeated stretches of weighted texts (a, b, weight, text), whose key is (a, b)."""
    keys = ["a", "b", "weight"]
    anchors = repeats.runs(texts, "byte", length, gram, keys, "text", content=False).groupBy("anchor").agg(F.sum("weight").alias("weights"), F.count("*").alias("n"), F.max("twice").alias("twice"))
    shared = stored(anchors.where("weights > 1 or twice").select("anchor", "n"), "anchors")
    hot = hot_keys(shared, "anchor")
    flagged = lambda df: df.join(hot, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    found = flagged(repeats.runs(texts, "byte", length, gram, keys, "text").drop("twice"))
    again = stored(hot_join(found, flagged(shared.select("anchor")), ["anchor"], ["a", "b", "start"]), "runs")
    contents = again.groupBy("anchor", "content").agg(F.sum("weight").alias("copies"), F.first("hot").alias("hot"), F.min(F.struct("a", "b", "start", "size")).alias("one"))
    contents = stored(contents.select("anchor", "content", "copies", "hot", "one.*"), "contents")
    bytes_ = contents.groupBy("anchor").agg(F.sum(F.col("size") + length - 1).alias("bytes"), F.count("*").alias("runs"))
    crowded = stored(bytes_.where((F.col("bytes") > most) & (F.col("runs") > 1)).select("anchor"), "crowded") if gram < length else None
    width = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = contents
    if crowded is not None and crowded.head(1):
        few = contents.join(crowded, "anchor", "left_anti")
        texts_ = run_bytes(texts, contents.join(crowded, "anchor", "left_semi"), length)
        next_ = stored(texts_.select(F.col("anchor").alias("a"), F.col("content").alias("b"), F.col("copies").alias("weight"), F.col("data").alias("text")), "crowd")
        parts = spans_of(next_, length, gram + -(-(length - gram) // 2), most).select(F.col("a").alias("anchor"), F.col("b").alias("content"), F.col("start").alias("lo"), F.col("stop").alias("hi"))
    dealt = run_bytes(texts, few, length).repartition(width, "anchor").sortWithinPartitions("anchor")
    verdicts = compare(dealt, length)
    if few is not contents:
        verdicts = verdicts.unionByName(parts)
    spans = hot_join(again, flagged(stored(verdicts, "verdicts")), ["anchor", "content"], ["a", "b", "start"])
    return spans.select("a", "b", (F.col("start") + F.col("lo")).alias("start"), (F.col("start") + F.col("hi")).alias("stop"))


def repeated_spans(docs: DataFrame, length: int = 200, doc_id: str = "doc_id", text: str = "text", most: int = SORT_BYTES) -> DataFrame:
    """a, b, start, stop: bytes of strings of ``length`` that also start anywhere else, same document included; (a, b): see ``repeats.keyed``.

    Spans overlap. Rows with null or repeated doc_ids are rows like any other: each has the spans of its own text.
    ``most``: text of different runs that one anchor may have before it is dealt anew. Null and empty texts,
    and an empty table, give none; texts of over ``repeats.LONG`` bytes are hashed by stretches.
    """
    need(docs, doc_id, text)
    texts = repeats.keyed(docs, doc_id, text).select("a", "b", F.lit(1).cast("long").alias("weight"), "text")
    return spans_of(texts, length, length // 2, most)


def remove_repeats(docs: DataFrame, length: int = 200, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n, n_removed, n_spans, kept_sha256, spans (in bytes).

    Every copy of a repeated string goes. Null and empty texts have no bytes and the digest of
    nothing; texts under ``length`` bytes stay whole; an empty table gives no rows; other columns
    are ignored.
    """
    return repeats.kept_of(docs, repeated_spans(docs, length, doc_id, text), "byte", doc_id, text)


def strip_repeats(docs: DataFrame, length: int = 200, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs, all columns, with the repeated bytes taken out of the text; null texts become empty."""
    return repeats.rewritten(docs, repeated_spans(docs, length, doc_id, text), "byte", doc_id, text)


#: The query in SQL.
SQL = r"""
WITH b AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS g FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 199)) AS i FROM b)
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS n FROM windows) WHERE n > 1
), islands AS (
  SELECT doc_id, min(i) AS a, max(i) + 200 AS z FROM (
    SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM (
      SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS fresh FROM again)
  ) GROUP BY doc_id, k
), pieces AS (
  SELECT doc_id, z AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS z FROM islands
  UNION ALL SELECT doc_id, 0, min(a) FROM islands GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(z, length(h) // 2) - a)), '' ORDER BY a) AS t FROM pieces JOIN b USING (doc_id) GROUP BY doc_id
), counts AS (
  SELECT doc_id, sum(z - a)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans FROM islands GROUP BY doc_id
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(t, CASE WHEN n_removed IS NULL THEN h ELSE '' END))) AS kept_sha256
FROM b LEFT JOIN kept USING (doc_id) LEFT JOIN counts USING (doc_id)
"""
