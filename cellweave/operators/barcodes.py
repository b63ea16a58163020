"""Cell barcodes: ranking, the knee that separates cells from noise, and matching with errors."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ..functions.sequences import infix_distance, search
from .intervals import merge, overlaps_closed
from .partitioning import part_of, stored

#: Ranks beyond which no barcode is held for a cell, the first prefix that votes, and barcodes needed.
MOST, FIRST_PREFIX, LEAST = 50_000, 1000, 10


def umi_counts(reads: DataFrame, bc: str = "bc", umi: str = "umi") -> DataFrame:
    return reads.groupBy(bc).agg(F.countDistinct(umi).alias("umi_count"))


def contents(reads: DataFrame, columns: list[str], bc: str = "bc") -> DataFrame:
    """bc, _rows, and for each column the number of its different values, nulls left out.

    A value counts at the first of its rows, so rows are not repeated for each column, as several distinct counts in one aggregate would.
    """
    each = reads.groupBy(bc, *columns).agg(F.count("*").alias("_n"))
    nth = {f"_nth_{c}": F.row_number().over(Window.partitionBy(bc, c).orderBy(*columns)) for c in columns}
    counts = [F.count(F.when((F.col(f"_nth_{c}") == 1) & F.col(c).isNotNull(), 1)).alias(c) for c in columns]
    return each.withColumns(nth).groupBy(bc).agg(F.sum("_n").alias("_rows"), *counts)


def ranked(counts: DataFrame, bc: str = "bc", count: str = "umi_count") -> DataFrame:
    """counts with rank, 1 for the most; ties by barcode.

    Equal counts are parted by the barcodes' first letters (or the number's high part), and rows are
    numbered within a part alone, after the rows of all parts before it: not even the barcodes with one
    molecule, most of a run, are sorted in one task.
    """
    dealt = counts.withColumn("_part", part_of(counts, bc))
    sizes = dealt.groupBy(count, "_part").agg(F.count("*").alias("_n"))
    above = sizes.select(count, "_part", (F.sum("_n").over(Window.orderBy(F.desc(count), "_part")) - F.col("_n")).alias("_above"))
    nth = F.row_number().over(Window.partitionBy(count, "_part").orderBy(bc))
    return dealt.withColumn("_nth", nth).join(above, [count, "_part"]).select(*counts.columns, (F.col("_above") + F.col("_nth")).alias("rank"))


def cumulative(ranks: DataFrame, count: str = "umi_count", most: int = MOST) -> DataFrame:
    """Running sum over the ranks of barcodes with two molecules at least; ``most`` rows at most."""
    head = ranks.where((F.col("rank") <= most) & (F.col(count) >= 2))
    return head.withColumn("total", F.sum(count).over(Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)))


def difference_curve(sums: DataFrame) -> DataFrame:
    """Both axes scaled to 0..1; diff is how far the curve lies above the diagonal."""
    whole = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    scaled = lambda c: (F.col(c) - F.min(c).over(whole)) / F.nullif(F.max(c).over(whole) - F.min(c).over(whole), F.lit(0))
    return sums.select("*", scaled("rank").alias("x"), scaled("total").alias("y")).withColumn("diff", F.col("y") - F.col("x"))


def knee_of(totals: np.ndarray, sensitivity: float = 1.0) -> int | None:
    """Knee of a concave rising curve: the first maximum of the difference curve that it falls away from."""
    n = len(totals)
    if n < 3 or totals[-1] == totals[0]:
        return None
    x = np.linspace(0, 1, n)
    diff = (totals - totals[0]) / (totals[-1] - totals[0]) - x
    rise, at = np.diff(diff), np.arange(n)
    peak, dip = np.zeros(n, bool), np.zeros(n, bool)
    peak[1:-1], dip[1:-1] = (rise[:-1] >= 0) & (rise[1:] <= 0), (rise[:-1] <= 0) & (rise[1:] >= 0)
    # The last peak before each place, and the bar: a little below the peak, or 0 behind a dip since.
    top = np.maximum.accumulate(np.where(peak, at, -1))
    dipped = np.maximum.accumulate(np.where(dip & ~peak, at, -1)) > top
    bar = np.where(dipped, 0.0, diff[top] - sensitivity / (n - 1))
    below = np.flatnonzero((top >= 0) & (diff < bar))
    return int(top[below[0]]) + 1 if len(below) else None


def prefixes_vote(n: int) -> bool:
    """Whether the prefixes of n sums can outvote the whole curve, which votes for all sizes from n to MOST."""
    return n - FIRST_PREFIX > MOST - n


def cell_count(totals: np.ndarray, votes: Counter | None = None) -> int:
    """The knee most prefixes agree on; every prefix beyond the end is the whole curve. votes: those of the prefixes, if known."""
    n = len(totals)
    if n < LEAST:
        raise ValueError(f"{n} barcodes are too few to find a knee")
    if votes is None:
        votes = Counter(knee_of(totals[:size]) for size in (range(FIRST_PREFIX, n) if prefixes_vote(n) else ()))
    votes[knee_of(totals)] += MOST - max(n, FIRST_PREFIX)
    votes.pop(None, None)
    if not votes:
        raise ValueError("the curve has no knee")
    return votes.most_common(1)[0][0]


def cells_by_knee(ranks: DataFrame, count: str = "umi_count") -> DataFrame:
    """The barcodes up to the knee. The driver gets the running sums, MOST numbers at most; Spark deals out their prefixes."""
    totals = np.array([r.total for r in cumulative(ranks, count).orderBy("rank").select("total").collect()], float)
    return ranks.where(F.col("rank") <= cell_count(totals, votes_of_prefixes(ranks.sparkSession, totals)))


def votes_of_prefixes(spark: SparkSession, totals: np.ndarray) -> Counter:
    """Prefixes by knee, in the order in which each knee comes first."""
    if not prefixes_vote(len(totals)):
        return Counter()

    @F.pandas_udf("long")
    def knee(sizes: pd.Series) -> pd.Series:
        return pd.Series([knee_of(totals[:size]) for size in sizes], dtype="Int64")

    sizes = spark.range(FIRST_PREFIX, len(totals), numPartitions=64)
    found = sizes.select("id", knee("id").alias("knee")).groupBy("knee").agg(F.count("*").alias("n"), F.min("id").alias("first")).orderBy("first").collect()
    return Counter({r.knee: r.n for r in found})


def pieces(column: str, parts: int, length: int) -> list[tuple[int, int]]:
    bounds = [length * i // parts for i in range(parts + 1)]
    return list(zip(bounds[:-1], bounds[1:]))


def close_pairs(observed: DataFrame, references: DataFrame, bc: str = "bc", ref: str = "ref", length: int = 16, most: int = 2) -> DataFrame:
    """bc, ref, ed of all references within ``most`` edits, by infix distance, of each distinct barcode.

    Cut into most + 1 pieces, a barcode within ``most`` edits has one piece intact, and that piece
    stands in the reference within ``most`` places of its own; so pieces are joined to substrings and
    only those pairs are compared.
    """
    seen = observed.select(bc).distinct().where(F.length(bc) >= most + 1)
    cuts = pieces(bc, most + 1, length)
    keys = seen.select(bc, F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.substring(bc, a + 1, b - a).alias("s")) for i, (a, b) in enumerate(cuts)])).alias("p"))
    spots = [F.struct(F.lit(i).alias("i"), F.substring(ref, o + 1, b - a).alias("s")) for i, (a, b) in enumerate(cuts) for o in range(max(0, a - most), min(length - (b - a), a + most) + 1)]
    table = references.select(ref, F.explode(F.array(*spots)).alias("p")).distinct()
    pairs = keys.join(table, "p").select(bc, ref).distinct()
    return pairs.withColumn("ed", infix_distance(bc, ref, most)).where("ed is not null")


def nearest(observed: DataFrame, references: DataFrame, bc: str = "bc", ref: str = "ref", length: int = 16, most: int = 2) -> DataFrame:
    """bc, ref, ed of the references at the least infix distance, up to ``most``, of each distinct barcode: see ``close_pairs``.

    References are a ranked list of at most MOST barcodes.
    """
    close = close_pairs(observed, references, bc, ref, length, most)
    least = close.groupBy(bc).agg(F.min("ed").alias("_least"))
    return close.join(least, bc).where("ed = _least").drop("_least")


def recut(bu: str, ref: str, umi_len: int, most: int) -> str | None:
    """The tag behind the first best place of the reference in the read's bases, if it is whole."""
    distance, end = search(ref, bu, most)
    tag = bu[end : end + umi_len] if distance >= 0 else ""
    return tag if len(tag) == umi_len else None


def assign(reads: DataFrame, references: DataFrame, bc: str = "bc", umi: str = "umi", bu: str = "bu", ref: str = "ref", length: int = 16, umi_len: int = 12, most: int = 2) -> DataFrame:
    """reads of known cells with cell, cell_umi, ed: exact matches as read, others if one reference survives.

    Whether one survives is found once for each distinct barcode and bases, so repeated reads each stay, and
    columns of any type pass through. References that occur twice count once.
    """
    known = references.select(F.col(ref).alias("cell")).distinct()

    @F.pandas_udf("string")
    def tag(bases, refs):
        return bases.combine(refs, lambda a, b: recut(a or "", b, umi_len, most))

    exact = reads.join(known, F.col(bc) == F.col("cell"), "inner").select(*reads.columns, "cell", F.col(umi).alias("cell_umi"), F.lit(0).alias("ed"))
    others = reads.join(known.withColumnRenamed("cell", bc), bc, "left_anti")
    seen = others.select(bc, bu).distinct()
    near = seen.join(nearest(others, references, bc, ref, length, most), bc).withColumn("cell_umi", tag(bu, ref)).where("cell_umi is not null")
    unique = near.groupBy(bc, bu).agg(F.count("*").alias("_n"), F.min(ref).alias("cell"), F.min("cell_umi").alias("cell_umi"), F.min("ed").cast(IntegerType()).alias("ed")).where("_n = 1").drop("_n")
    return exact.unionByName(others.join(unique, [bc, bu]).select(*exact.columns))


def umi_sketches(reads: DataFrame, bc: str = "bc", umi: str = "umi", bits: int = 12) -> DataFrame:
    """bc, sketch: an approximate set of each barcode's tags, to be stored for a run or chunk and merged later without its reads."""
    return reads.groupBy(bc).agg(F.hll_sketch_agg(F.col(umi).cast("string"), F.lit(bits)).alias("sketch"))


def merged_counts(sketches: DataFrame, bc: str = "bc") -> DataFrame:
    """bc, umi_count: about the number of different tags over all sketches of a barcode; a tag in several chunks counts once."""
    return sketches.groupBy(bc).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("umi_count"))


def candidates_merged(reads: DataFrame, ranks: DataFrame, knee: int, length: int = 16, most: int = 2) -> DataFrame:
    """bc, rank, root, is_ref: candidate barcodes that are errors of a richer one, merged in the order of their ranks.

    reads: bc, umi, chrom, start, stop (both ends held); ranks: bc, rank. The first half of the knee's barcodes stay. Each later one is held against the
    references ahead of it: of those at the least infix distance, up to ``most``, the one that shares a tag with overlapping places
    takes it in, if there is just one; else it stays, as a reference if its rank lies within one and a half knees. Rounds settle all
    barcodes of which every close one ahead is settled, until none is open.
    """
    names = ranks.select("bc", F.col("rank").cast("long").alias("rank"))
    close = close_pairs(names.select("bc"), names.select(F.col("bc").alias("ref")), length=length, most=most).where("bc <> ref")
    close = close.join(names.withColumnRenamed("rank", "behind"), "bc").join(names.select(F.col("bc").alias("ref"), F.col("rank").alias("ahead")), "ref").where("ahead < behind")
    close = stored(close.select("bc", "ref", "behind", "ahead", "ed"), "close")
    tags = merge(reads.where("start is not null and stop is not null"), more=["bc", "umi"])  # two tags share a place if stretches of theirs do
    one = close.join(tags, "bc").join(tags.toDF("ref", "umi", "chrom", "_lo", "_hi"), ["ref", "umi", "chrom"]).where(overlaps_closed("start", "stop", "_lo", "_hi"))
    links = stored(close.join(one.select("behind", "ahead").distinct().withColumn("shared", F.lit(True)), ["behind", "ahead"], "left").select("behind", "ahead", "ed", F.coalesce("shared", F.lit(False)).alias("shared")), "links")
    own = F.col("rank").alias("root")
    settled = stored(names.where(F.col("rank") <= knee // 2).select("rank", own, F.lit(True).alias("is_ref")), "settled")
    open_ = stored(names.where(F.col("rank") > knee // 2).select("rank"), "open")
    while open_.head(1):
        known = links.join(open_.withColumnRenamed("rank", "behind"), "behind", "left_semi").join(settled.select(F.col("rank").alias("ahead"), "is_ref"), "ahead", "left")
        held = F.collect_list(F.when(F.col("is_ref"), F.struct("ed", "shared", "ahead"))).alias("held")  # some hundreds lie within two edits
        state = open_.join(known.groupBy(F.col("behind").alias("rank")).agg(F.count(F.when(F.col("is_ref").isNull(), 1)).alias("waits"), held), "rank", "left")
        ready = state.where("coalesce(waits, 0) = 0").withColumn("_least", F.array_min(F.transform("held", lambda x: x["ed"])))
        hits = F.filter("held", lambda x: (x["ed"] == F.col("_least")) & x["shared"])
        ready = ready.withColumn("root", F.when(F.size(hits) == 1, F.get(hits, F.lit(0))["ahead"]).otherwise(F.col("rank")))
        ready = ready.select("rank", "root", ((F.col("root") == F.col("rank")) & (F.col("rank") <= int(knee * 1.5))).alias("is_ref"))
        settled = stored(settled.union(ready), "settled")
        open_ = stored(open_.join(settled, "rank", "left_anti"), "open")
    return settled.join(names, "rank").join(names.select(F.col("bc").alias("_name"), F.col("rank").alias("root")), "root").select("bc", "rank", F.col("_name").alias("root"), "is_ref")
