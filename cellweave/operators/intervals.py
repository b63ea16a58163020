"""Genomic intervals: merging what overlaps, and joins of points with ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _islands(rows: DataFrame, keys: list[str], start: str, stop: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(start, stop)
    so_far = F.max(stop).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = rows.select(*keys, start, stop, F.when(so_far.isNull() | (F.col(start) > so_far), 1).otherwise(0).alias("_new"))
    numbered = marked.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(stop).alias(stop)).drop("_island")


def merge(rows: DataFrame, chrom: str = "chrom", start: str = "start", stop: str = "stop", bin_size: int = 100_000, more: list[str] | None = None) -> DataFrame:
    """Maximal stretches per chromosome, and per value of ``more`` columns; intervals that touch join. Of equal starts only the furthest stop counts,
    before anything is sorted, so a crowded place is no large group; bins of starts are merged next,
    so the last pass over a chromosome sees stretches and not reads."""
    keys = [*(more or []), chrom]
    furthest = rows.groupBy(*keys, start).agg(F.max(stop).alias(stop))
    binned = furthest.withColumn("_bin", F.floor(F.col(start) / bin_size))
    return _islands(_islands(binned, [*keys, "_bin"], start, stop), keys, start, stop)


def points_in_ranges(points: DataFrame, ranges: DataFrame, chrom: str = "chrom", pos: str = "pos", start: str = "lo", stop: str = "hi", bin_size: int = 1000) -> DataFrame:
    """points ⋈ ranges, start <= pos <= stop on one chromosome, through bins of equal keys."""
    wide = ranges.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / bin_size), F.floor(F.col(stop) / bin_size))))
    return points.withColumn("_bin", F.floor(F.col(pos) / bin_size)).join(wide, [chrom, "_bin"]).where(f"{pos} between {start} and {stop}").drop("_bin")


def overlaps(start: str, stop: str, lo: int, hi: int) -> Column:
    """A half-open read overlaps a half-open region."""
    return (F.col(start) < hi) & (F.col(stop) > lo)


def overlaps_closed(start: str, stop: str, lo: int | str, hi: int | str) -> Column:
    """Two stretches that both hold their last place overlap; bounds are numbers or columns."""
    bound = lambda x: F.col(x) if isinstance(x, str) else F.lit(x)
    return (F.col(start) <= bound(hi)) & (F.col(stop) >= bound(lo))
