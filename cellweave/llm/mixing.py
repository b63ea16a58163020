"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Within its source each document expects the same copies, target / size. Their running sum, with
one random offset for the source, crosses an integer once for each copy that the mix takes. The
running sum needs no task that holds a source: documents are counted by source and small bucket,
the counts are summed along the buckets, and rows are numbered within a bucket alone. Buckets
follow the size, so documents of nearly equal size share the rounding and the words taken come
close to the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import need, set_aside

#: Parts of a bucket; more let more tasks share a hot source.
SALTS = 64


def n_words(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def salt_of(doc_id: str) -> Column:
    """Part of a bucket, by a hash of an id of any type; null ids are one part."""
    return F.pmod(F.conv(F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long"), F.lit(SALTS))


def targets(sizes: DataFrame, weights: list[int], most: int = 3) -> DataFrame:
    """source, source_size, target: all sizes shared by weight, no source above ``most`` times its own.

    sizes: source, source_size. Sources by code point, null last, take the weights in turn. What a
    source cannot use is reshared by weight: with sources in order of cap / weight, the first
    whose share of what is left fits it ends the capping.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*map(F.lit, weights))
    table = sizes.withColumn("w", F.element_at(turn, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).cast("long")).withColumn("cap", most * F.col("source_size"))
    by_need = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    everything = by_need.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    table = table.select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        (F.sum("cap").over(by_need.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap")).alias("used"),
        F.sum("w").over(by_need.rowsBetween(0, Window.unboundedFollowing)).alias("rest"),
    )
    share = (F.col("total") - F.col("used")) / F.col("rest")
    fits = (F.col("total") - F.col("used")) * F.col("w") <= F.col("cap") * F.col("rest")
    level = F.first(F.when(fits, F.struct((F.col("total") - F.col("used")).alias("left"), F.col("rest"))), ignorenulls=True).over(everything)
    capped = F.coalesce(F.max(fits.cast("int")).over(by_need.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)) == 0
    table = table.withColumn("level", level).withColumn("capped", capped).withColumn("share", share)
    return table.select("source", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise((F.col("w") * F.col("level.left")) / F.col("level.rest")).alias("target"))


def mix(docs: DataFrame, weights: list[int] | None = None, most: int = 3, seed: int = 7, doc_id: str = "doc_id", source: str = "source", size: str = "size") -> DataFrame:
    """docs with source_size, target, copies: how often the mix takes each row.

    docs must have a column of sizes (see ``n_words``); null sizes count 0. Rows with null source
    are one source. Sources without words get target 0 and no copies. Repeated rows count each;
    reruns agree because the offset hangs on the seed and the source alone. An empty table gives
    no rows. No other column of docs is read, and all are returned, those called like a result or a helper with an underscore in front.
    """
    need(docs, doc_id, source, size)
    docs, now = set_aside(docs, "source_size", "target", "copies", "_bucket", "_salt", "_key", "_nth", "_base", "_rate", "_offset")
    doc_id, source, size = now[doc_id], now[source], now[size]
    weights = weights or [1, 2, 3]
    amount = F.coalesce(F.col(size), F.lit(0)).cast("long")
    rows = docs.withColumns({"_bucket": F.floor(F.sqrt(amount)), "_salt": salt_of(doc_id), "_key": F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("null"))})
    counts = rows.groupBy("_key", "_bucket", "_salt").agg(F.count("*").alias("_n"), F.sum(amount).alias("_words"), F.first(source).alias("_source"))
    along = Window.partitionBy("_key").orderBy("_bucket", "_salt")
    places = counts.select("_key", "_bucket", "_salt", (F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_base"))
    sizes = counts.groupBy("_key").agg(F.sum("_words").alias("source_size"), F.first("_source").alias("source"))
    goal = targets(sizes, weights, most).withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))).drop("source")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("_key"))), 1, 8), 16, 10).cast("long") / F.lit(4294967296)
    goal = goal.withColumn("_rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)).withColumn("_offset", offset)
    within = Window.partitionBy("_key", "_bucket", "_salt").orderBy(amount, doc_id)
    placed = rows.withColumn("_nth", F.row_number().over(within)).join(places.join(goal, "_key"), ["_key", "_bucket", "_salt"])
    upto = lambda rank: F.floor(rank * F.col("_rate") + F.col("_offset"))
    rank = F.col("_base") + F.col("_nth")
    return placed.withColumn("copies", upto(rank) - upto(rank - 1)).select(*docs.columns, "source_size", "target", "copies")


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), named AS (
  SELECT *, coalesce('=' || source, 'null') AS k FROM sized
), sources AS (
  SELECT k, min(source) AS source, sum(size)::BIGINT AS source_size FROM named GROUP BY k
), weighted AS (
  SELECT *, 3 * source_size AS cap, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM sources
), ordered AS (
  SELECT *, sum(source_size) OVER ()::BIGINT AS total,
    (sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS UNBOUNDED PRECEDING) - cap)::BIGINT AS used,
    (sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS rest,
    row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS nth
  FROM weighted
), level AS (
  SELECT nth, total - used AS remains, rest FROM ordered WHERE (total - used) * w <= cap * rest ORDER BY nth LIMIT 1
), goals AS (
  SELECT k, source_size, CASE WHEN o.nth < l.nth THEN cap::DOUBLE ELSE (w * l.remains) / l.rest END AS target
  FROM ordered o CROSS JOIN level l
), rated AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
    ('0x' || md5('7:' || k)[1:8])::BIGINT / 4294967296 AS shift
  FROM goals
), ranked AS (
  SELECT doc_id, size, k, row_number() OVER (PARTITION BY k ORDER BY floor(sqrt(size)), ('0x' || md5(doc_id::VARCHAR)[1:8])::BIGINT % 64, size, doc_id) AS nth FROM named
)
SELECT doc_id, size, source_size, target,
  (size * (floor(nth * rate + shift) - floor((nth - 1) * rate + shift)))::BIGINT AS taken
FROM ranked JOIN rated USING (k)
"""
