"""Tables of places laid out for region scans: a folder for each chromosome, rows sorted by start, statistics that prune.

A scan of a region opens the folder of its chromosome alone, and of its files only the row groups whose starts and stops may
overlap. Rows carry the 16 kb bin of their start, so joins by place have a key of equality.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import intervals

#: Bits of a place within its bin, and bytes of a row group.
BIN_BITS, GROUP_BYTES = 14, 8 << 20


def write_places(rows: DataFrame, path: str, chrom: str = "chrom", start: str = "start", group_bytes: int = GROUP_BYTES) -> None:
    """rows by chromosome and start, dealt by ranges of both, so that a crowded chromosome has many files; null chromosomes have a folder of their own."""
    binned = rows.withColumn("bin", F.shiftright(start, BIN_BITS))
    dealt = binned.repartitionByRange(chrom, start).sortWithinPartitions(chrom, start)
    dealt.write.option("parquet.block.size", group_bytes).option("parquet.page.size", 1 << 16).partitionBy(chrom).parquet(path)


def places(spark: SparkSession, path: str, region: str | None = None, chrom: str = "chrom", start: str = "start", stop: str = "stop", closed: bool = False) -> DataFrame:
    """The rows of a region (``chrom`` or ``chrom:start-stop``), all without one.

    Rows [start, stop) overlap a half-open region; where ``closed``, rows and region hold their last place too. The filters are plain comparisons of columns, so they reach
    folders and row groups.
    """
    from .tables import region as parsed

    rows = spark.read.option("recursiveFileLookup", "false").parquet(path)
    name, lo, hi = parsed(region)
    if name is None:
        return rows
    rows = rows.where(F.col(chrom).cast("string") == name)
    if lo is None:
        return rows
    last = hi if closed else hi - 1
    return rows.where((F.col("bin") <= (last >> BIN_BITS)) & (intervals.overlaps_closed(start, stop, lo, hi) if closed else intervals.overlaps(start, stop, lo, hi)))


def in_regions(rows: DataFrame, regions: DataFrame, chrom: str = "chrom", start: str = "start", stop: str = "stop") -> DataFrame:
    """rows ⋈ regions (chrom, lo, hi, half-open): overlaps, each pair once, through shared bins.

    A pair meets in every bin that both touch and counts in the first of them.
    """
    spread = lambda df, a, b: df.withColumn("_bin", F.explode(F.sequence(F.shiftright(a, BIN_BITS), F.shiftright(F.greatest(F.col(b) - 1, F.col(a)), BIN_BITS))))
    left, right = spread(rows, start, stop), spread(regions, "lo", "hi")
    first = F.shiftright(F.greatest(F.col(start), F.col("lo")), BIN_BITS)
    return left.join(right, [chrom, "_bin"]).where((F.col(start) < F.col("hi")) & (F.col(stop) > F.col("lo")) & (F.col("_bin") == first)).drop("_bin")
