"""Phased variants in genes, and their traits through catalog ranges and linkage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .intervals import points_in_ranges

PROMOTER, NEAR = 500, 1_000_000

#: The parent terms that count as disease, the leading ones first.
DISEASES = ["Cancer", "Immune system disorder", "Neurological disorder", "Cardiovascular disease", "Digestive system disorder", "Metabolic disorder", "Response to drug", "Other disease"]


def gene_hull(annotation: DataFrame, gene: str = "gene", chrom: str = "chrom", start: str = "start", stop: str = "stop", wanted: DataFrame | None = None, more: list[str] | None = None, last: str | None = None) -> DataFrame:
    """gene, chrom, start, stop and the columns ``more`` (strand) of each gene: its first start and last stop.

    chrom and ``more`` are those of the row with the largest ``last`` (the line), where that column is given, else the largest.
    wanted: a table of genes (column gene), if not all are.
    """
    rows = annotation if wanted is None else annotation.join(wanted.select(F.col("gene").alias(gene)).distinct(), gene, "left_semi")
    one = lambda c: (F.max_by(c, last) if last else F.max(c)).alias("chrom" if c == chrom else c)
    return rows.groupBy(gene).agg(one(chrom), F.min(start).alias("start"), F.max(stop).alias("stop"), *map(one, more or []))


def diseases(rows: DataFrame, parent: str = "parent", terms: list[str] | None = None) -> DataFrame:
    """Rows whose parent term is a disease; for ``leading``, DISEASES is the order."""
    return rows.where(F.col(parent).isin(terms or DISEASES))


def with_promoter(genes: DataFrame, strand: str = "strand", size: int = PROMOTER) -> DataFrame:
    """genes with lo and hi: the promoter lies before the start on +, after the end on -."""
    return genes.withColumns({"lo": F.col("start") - F.when(F.col(strand) == "+", size).otherwise(0), "hi": F.col("stop") + F.when(F.col(strand) == "-", size).otherwise(0)})


def snps_in_genes(snps: DataFrame, genes: DataFrame, bin_size: int = 1000) -> DataFrame:
    return points_in_ranges(snps, with_promoter(genes), bin_size=bin_size)


def genotype(call: str | Column) -> Column:
    """Allele of a phased heterozygous call, null for all others."""
    call = F.col(call) if isinstance(call, str) else call
    return F.when(call == "1|0", "H1").when(call == "0|1", "H2")


def snp_list(rows: DataFrame, column: str = "snps") -> DataFrame:
    """One row for each id of a list that may be joined by comma, dash or x."""
    ids = F.split(F.regexp_replace(F.regexp_replace(F.col(column), r"\s+", ""), "[-x]", ","), ",")
    return rows.withColumn("snp", F.explode(F.filter(ids, lambda s: s != "")))


def catalog_near(genes: DataFrame, catalog: DataFrame, near: int = NEAR, bin_size: int = NEAR) -> DataFrame:
    """genes ⋈ catalog: same chromosome, position within ``near`` of the gene, gene named in mapped."""
    wide = genes.withColumns({"lo": F.col("start") - near, "hi": F.col("stop") + near})
    return points_in_ranges(catalog, wide, bin_size=bin_size).where(F.expr("contains(mapped, gene)"))


def linked(donor: DataFrame, listed: DataFrame, ld: DataFrame, least: float = 0.8) -> DataFrame:
    """donor, listed: distinct pairs in linkage, in either order of the table (snp_a, snp_b, r2)."""
    strong = ld.where(F.col("r2") > least)
    both = strong.select(F.col("snp_a").alias("donor"), F.col("snp_b").alias("listed")).union(strong.select("snp_b", "snp_a"))
    return both.distinct().join(donor.select(F.col("snp").alias("donor")).distinct(), "donor", "left_semi").join(listed.select(F.col("snp").alias("listed")).distinct(), "listed", "left_semi")


def linkage_matrix(snps: DataFrame, ld: DataFrame, gene: str = "gene") -> DataFrame:
    """gene, snp_a <= snp_b, r2: the largest over populations within a gene; 1 on the diagonal."""
    own = snps.select(gene, "snp").distinct()
    pairs = ld.where("r2 > 0 and snp_a <> snp_b").select(F.least("snp_a", "snp_b").alias("snp_a"), F.greatest("snp_a", "snp_b").alias("snp_b"), "r2").groupBy("snp_a", "snp_b").agg(F.max("r2").alias("r2"))
    inside = pairs.join(own.withColumnRenamed("snp", "snp_a"), "snp_a").join(own.withColumnRenamed("snp", "snp_b"), ["snp_b", gene])
    return inside.select(gene, "snp_a", "snp_b", "r2").union(own.select(gene, F.col("snp").alias("snp_a"), F.col("snp").alias("snp_b"), F.lit(1.0).alias("r2")))


def linkage_squares(snps: DataFrame, ld: DataFrame, gene: str = "gene") -> DataFrame:
    """gene, nth, snp, names, values: the dense rows of each gene's symmetric matrix of linkage, in the order of position and id.

    snps: gene, snp, pos. names: the gene's variants, of which values holds the linkage, 0 where none is known; nth counts from 1. A gene holds
    some thousands of variants, each row as many numbers.
    """
    own = snps.groupBy(gene, "snp").agg(F.min("pos").alias("_pos"))
    names = own.groupBy(gene).agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "snp"))), lambda x: x["snp"]).alias("names"))
    half = linkage_matrix(snps, ld, gene)
    other = half.where("snp_a <> snp_b").select(gene, F.col("snp_b").alias("snp_a"), F.col("snp_a").alias("snp_b"), "r2")
    rows = half.unionByName(other).groupBy(gene, F.col("snp_a").alias("snp")).agg(F.map_from_entries(F.collect_list(F.struct("snp_b", "r2"))).alias("_to"))
    dense = F.transform("names", lambda n: F.coalesce(F.try_element_at(F.col("_to"), n), F.lit(0.0)))
    return rows.join(names, gene).select(gene, F.array_position("names", F.col("snp")).alias("nth"), "snp", "names", dense.alias("values"))


def leading(rows: DataFrame, keys: list[str], trait: str = "trait", parent: str = "parent", p: str = "p", order: list[str] | None = None) -> DataFrame:
    """keys, trait, p (its least), leading: the trait whose parent stands first in order, then by p and name."""
    best = rows.groupBy(*keys, trait, parent).agg(F.min(p).alias(p))
    place = F.coalesce(F.array_position(F.array(*map(F.lit, order or [])), F.col(parent)), F.lit(0)) if order else F.lit(0)
    place = F.when(place == 0, 1 << 30).otherwise(place)
    return best.groupBy(*keys).agg(F.min_by(trait, F.struct(place, p, trait)).alias("leading"), F.countDistinct(trait).alias("n_traits"), F.min(p).alias("least_p"))


def trait_matrix(rows: DataFrame, gene: str, trait: str, traits: list[str]) -> DataFrame:
    """One row a gene, one column a trait: does it have the trait."""
    return rows.groupBy(gene).pivot(trait, traits).agg(F.lit(True)).na.fill(False)


def named_by_position(snps: DataFrame, known: DataFrame) -> DataFrame:
    """snps with a missing id taken from the table of positions (rsid, chrom, pos)."""
    ids = known.groupBy("chrom", "pos").agg(F.min("rsid").alias("_rsid"))
    return snps.join(ids, ["chrom", "pos"], "left").withColumn("snp", F.coalesce("snp", "_rsid")).drop("_rsid")


def near_any(listed: DataFrame, donors: DataFrame, distance: int) -> DataFrame:
    """Listed variants within ``distance`` of some donor on the same chromosome."""
    spans = donors.select("chrom", (F.col("pos") - distance).alias("lo"), (F.col("pos") + distance).alias("hi"))
    return points_in_ranges(listed, spans, bin_size=max(1, distance)).select(*listed.columns).distinct()
