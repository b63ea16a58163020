"""Substring dedup: Rabin-Karp hashes of fixed-length word windows, counted in Spark.

Prefix sums give the hash of any stretch of words. Windows whose anchor is in one document only (see
``repeats``) stand alone and need no count; all others are hashed one by one and counted, those of runs with
equal content once, with the least doc_id of the copies. Repeated windows merge into maximal intervals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats
from .shared import hot_join, hot_keys, need, stored


def repeated_spans(docs: DataFrame, length: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """a, b, start, stop: words of windows whose sequence also starts in a document with a smaller doc_id; (a, b): see ``repeats.keyed``.

    Spans overlap. Rows with a null doc_id have no order and give none; rows with one doc_id are one document to each
    other, but each has its own text's spans. Windows are equal if their anchor, Rabin-Karp hash and 32 bits of the XXH3 of their words' bytes
    agree: none is left out. The first two rest on the XXH3 of each word, the third on the bytes alone. A text of
    any length is hashed whole, by stretches of ``repeats.LONG`` symbols.
    """
    need(docs, doc_id, text)
    texts = repeats.keyed(docs, doc_id, text).where("doc_id is not null")
    made = lambda content: repeats.runs(texts, "word", length, length // 2, ["a", "b"], "text", content).drop("twice")
    shared = stored(made(False).groupBy("anchor").agg(F.min("a").alias("_lo"), F.max("a").alias("_hi"), F.count("*").alias("n")).where("_lo < _hi").select("anchor", "n"), "anchors")
    hot = hot_keys(shared, "anchor")
    flagged = lambda df: df.join(hot, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    again = stored(hot_join(flagged(made(True)), flagged(shared.select("anchor")), ["anchor"], ["a", "b", "start"]), "runs")
    contents = again.groupBy("anchor", "content").agg(F.first("hot").alias("hot"), F.max("a").alias("hi"), F.min(F.struct("a", "b", "start", "size")).alias("one"))
    contents = stored(contents.select("anchor", "content", "hot", "hi", "one.*"), "contents")
    windows = stored(repeats.window_rows(texts, contents, length), "windows")
    same = ["anchor", "window", "check"]
    least = windows.groupBy(*same).agg(F.min("doc_id").alias("least"), F.max("hi").alias("last"), F.first("hot").alias("hot")).where("least < last").drop("last")
    late = hot_join(windows, stored(least, "least"), same, ["content", "nth"]).where("hi > least")
    nth, whole = F.sort_array(F.collect_list("nth")), F.col("size") == F.col("to") - F.col("from") + 1
    runs = late.groupBy("anchor", "content", "hot", "least").agg(F.min("nth").alias("from"), F.max("nth").alias("to"), F.count("*").alias("size"), nth.alias("nth"))
    ends = F.when(whole, F.array(F.struct(F.col("from").alias("lo"), F.col("to").alias("hi")))).otherwise(F.transform("nth", lambda i: F.struct(i.alias("lo"), i.alias("hi"))))
    verdicts = stored(runs.select("anchor", "content", "hot", "least", F.explode(ends).alias("part")).select("anchor", "content", "hot", "least", "part.*"), "verdicts")
    spans = hot_join(again, verdicts, ["anchor", "content"], ["a", "b", "start"]).where("a > least")
    return spans.select("a", "b", (F.col("start") + F.col("lo")).alias("start"), (F.col("start") + F.col("hi") + length).alias("stop"))


def remove_repeats(docs: DataFrame, length: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n, n_removed, n_spans, kept_sha256, spans (in words).

    The first document by doc_id keeps a passage. Null, empty and blank texts have no words and
    the digest of nothing; texts under ``length`` words stay whole; an empty table gives no rows.
    """
    return repeats.kept_of(docs, repeated_spans(docs, length, doc_id, text), "word", doc_id, text)


def strip_repeats(docs: DataFrame, length: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs, all columns, with the repeated words taken out of the text; null texts become empty."""
    return repeats.rewritten(docs, repeated_spans(docs, length, doc_id, text), "word", doc_id, text)


#: The query in SQL.
SQL = r"""
WITH b AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM b)
), late AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS lo FROM windows) WHERE lo < doc_id
), gone AS (
  SELECT DISTINCT doc_id, i + k AS j FROM late, range(0, 50) AS r(k)
), kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS t, count(*) AS n
  FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS j, unnest(w) AS x FROM b) ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM b LEFT JOIN kept USING (doc_id)
"""
