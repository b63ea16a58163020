"""Differential splicing between clusters, and between the alleles of one cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats

FDR, DELTA, P = 0.05, 0.05, 0.05


def cluster_pairs(clusters: DataFrame, cluster: str = "cluster") -> DataFrame:
    """cluster1 < cluster2. Clusters are cell types: some tens."""
    names = clusters.select(F.col(cluster)).distinct()
    right = names.select(F.col(cluster).alias("cluster2"))
    return names.select(F.col(cluster).alias("cluster1")).join(F.broadcast(right), F.col("cluster1") < F.col("cluster2"))


def pair_counts(counts: DataFrame, least: int = 10, kept: int = 2, cluster: str = "cluster", gene: str = "gene", trans: str = "trans", value: str = "value") -> DataFrame:
    """cluster1, cluster2, gene, trans, n1, n2: transcripts with enough in one of the two, genes with enough of them."""
    by = [gene, trans]
    one = counts.select(*by, F.col(cluster).alias("cluster1"), F.col(value).alias("n1"))
    two = counts.select(*by, F.col(cluster).alias("cluster2"), F.col(value).alias("n2"))
    pairs = cluster_pairs(counts, cluster)
    sides = counts.select(*by).distinct().join(F.broadcast(pairs))
    wide = sides.join(one, [*by, "cluster1"], "left").join(two, [*by, "cluster2"], "left").fillna(0, ["n1", "n2"]).where((F.col("n1") >= least) | (F.col("n2") >= least))
    n = F.count("*").over(Window.partitionBy("cluster1", "cluster2", gene))
    return wide.withColumn("_n", n).where(F.col("_n") >= kept).drop("_n").select("cluster1", "cluster2", gene, trans, "n1", "n2")


def differential(counts: DataFrame, least: int = 10, kept: int = 2, fdr: float = FDR, delta: float = DELTA) -> DataFrame:
    """cluster1, cluster2, gene, statistic, df, delta, p, fdr, significant; FDR within each pair."""
    table = stats.chi2(pair_counts(counts, least, kept), ["cluster1", "cluster2", "gene"], "trans", "n1", "n2")
    tested = stats.bh(table.withColumn("p", stats.chi2_p("statistic", "df")), "p", ["cluster1", "cluster2"], ["gene"])
    return tested.withColumn("significant", F.coalesce(~F.isnan("fdr") & (F.col("fdr") <= fdr) & (F.col("delta") > delta), F.lit(False)))


def each_against_rest(pairs: DataFrame, keys: list[str], trans: str = "trans", left: str = "n1", right: str = "n2") -> DataFrame:
    """Fisher's exact test of each transcript against the gene's others; counts are truncated."""
    by = Window.partitionBy(*keys)
    rows = pairs.withColumns({"_l": F.sum(left).over(by) - F.col(left), "_r": F.sum(right).over(by) - F.col(right)})
    return rows.withColumn("p", stats.fisher_p(left, right, "_l", "_r")).drop("_l", "_r")


def significant_transcripts(counts: DataFrame, least: int = 10, kept: int = 2, fdr: float = FDR, delta: float = DELTA, p: float = P) -> DataFrame:
    genes = differential(counts, least, kept, fdr, delta).where("significant").select("cluster1", "cluster2", "gene", "fdr", "delta")
    rows = pair_counts(counts, least, kept).join(genes, ["cluster1", "cluster2", "gene"])
    return each_against_rest(rows, ["cluster1", "cluster2", "gene"]).where(F.col("p") <= p)


def majority(reads: DataFrame, keys: list[str], hap: str = "hap") -> DataFrame:
    """keys, hap: the allele that more reads vote for; none on a tie."""
    one, two = (F.count(F.when(F.col(hap) == h, 1)) for h in ("H1", "H2"))
    votes = reads.groupBy(*keys).agg(one.alias("h1"), two.alias("h2"))
    return votes.withColumn("hap", F.expr("case when h1 > h2 then 'H1' when h2 > h1 then 'H2' else 'none' end"))


def molecules_voted(found: DataFrame, haps: DataFrame) -> DataFrame:
    """Molecules (with a list ``reads``) with hap, the allele that most of their reads vote for, ``none`` on a tie or without votes.

    haps: qname, hap, a read once. Molecules that are equal stay apart.
    """
    rows = found.withColumn("_row", F.monotonically_increasing_id()).withColumn("_qname", F.explode_outer("reads"))
    each = rows.join(haps.select(F.col("qname").alias("_qname"), F.col("hap").alias("_hap")), "_qname", "left")
    one, two = (F.count(F.when(F.col("_hap") == h, 1)) for h in ("H1", "H2"))
    votes = each.groupBy("_row").agg(*(F.first(c).alias(c) for c in found.columns), one.alias("_one"), two.alias("_two"))
    return votes.select(*found.columns, F.expr("case when _one > _two then 'H1' when _two > _one then 'H2' else 'none' end").alias("hap"))


def allele_counts(rows: DataFrame, keys: list[str], hap: str = "hap") -> DataFrame:
    """keys, h1, h2, unphased, total."""
    n = lambda test, name: F.count(F.when(test, 1)).alias(name)
    return rows.groupBy(*keys).agg(n(F.col(hap) == "H1", "h1"), n(F.col(hap) == "H2", "h2"), n(~F.coalesce(F.col(hap).isin("H1", "H2"), F.lit(False)), "unphased"), F.count("*").alias("total"))


def phased(counts: DataFrame, gene: list[str], least: int = 5, trans_ratio: float = 0.7, gene_ratio: float = 0.7, gene_least: int = 20, kept: int = 2) -> DataFrame:
    """The transcripts that pass: several in the gene; enough of one allele and phased share each;
    then several left, the whole gene's phased share, and the phased count of those left."""
    by = Window.partitionBy(*gene)
    rows = counts.withColumns({"_n": F.count("*").over(by), "_phased": F.sum(F.col("h1") + F.col("h2")).over(by), "_total": F.sum("total").over(by)}).where(F.col("_n") >= kept)
    rows = rows.where((F.greatest("h1", "h2") >= least) & ((F.col("h1") + F.col("h2")) / F.col("total") >= trans_ratio))
    rows = rows.withColumns({"_left": F.count("*").over(by), "_sum": F.sum(F.col("h1") + F.col("h2")).over(by)})
    return rows.where((F.col("_left") >= kept) & (F.col("_phased") / F.col("_total") >= gene_ratio) & (F.col("_sum") >= gene_least)).drop("_n", "_phased", "_total", "_left", "_sum")


def allele_specific(counts: DataFrame, fdr: float = FDR, delta: float = DELTA) -> DataFrame:
    """cluster, gene, statistic, df, delta, p, fdr, significant; FDR over all clusters together."""
    table = stats.chi2(phased(counts, ["cluster", "gene"]), ["cluster", "gene"], "trans", "h1", "h2")
    tested = stats.bh(table.withColumn("p", stats.chi2_p("statistic", "df")), "p", [], ["cluster", "gene"])
    return tested.withColumn("significant", F.coalesce(~F.isnan("fdr") & (F.col("fdr") <= fdr) & (F.col("delta") > delta), F.lit(False)))


def expression_eligible(counts: DataFrame, least: int = 20, ratio: float = 0.7) -> DataFrame:
    return counts.where((F.col("total") >= least) & ((F.col("h1") + F.col("h2")) / F.col("total") >= ratio))


def allele_expression(counts: DataFrame, fdr: float = FDR) -> DataFrame:
    """Genes whose alleles differ by a one-sided test; each row has its own cluster's counts."""
    rows = expression_eligible(counts).withColumn("p", stats.binomial_p(F.greatest("h1", "h2"), F.col("h1") + F.col("h2")))
    tested = stats.bh(rows, "p", [], ["cluster", "gene"])
    return tested.withColumns({"ratio1": F.col("h1") / (F.col("h1") + F.col("h2")), "significant": F.col("fdr") <= fdr})


def bulk_allele_expression(counts: DataFrame, least: int = 20, one_sided: float = 0.8, ratio: float = 0.8) -> DataFrame:
    phased_ = F.col("h1") + F.col("h2")
    return counts.where((phased_ >= least) & (F.greatest("h1", "h2") / phased_ >= one_sided) & (phased_ / F.col("total") >= ratio))


def bulk_transcripts(counts: DataFrame, keys: list[str], least: int = 10, trans_ratio: float = 0.8, gene_ratio: float = 0.8, gene_least: int = 20, kept: int = 2) -> DataFrame:
    """The transcripts of each sample's genes with ``passed`` and the gene's ``label``; keys: sample and gene.

    A transcript passes with ``least`` reads of one allele and enough of its reads phased. Genes with fewer than
    ``kept`` transcripts or ``gene_least`` reads are LowExp, those with too few phased reads among all of theirs Unphased, those
    with fewer than ``kept`` transcripts left NoSplice; the label of all others is null: they are to be tested.
    """
    by = Window.partitionBy(*keys)
    passed = (F.greatest("h1", "h2") >= least) & ((F.col("h1") + F.col("h2")) / F.col("total") >= trans_ratio)
    sums = {"_n": F.count("*"), "_phased": F.sum(F.col("h1") + F.col("h2")), "_total": F.sum("total"), "_left": F.count(F.when(F.col("passed"), 1))}
    rows = counts.withColumn("passed", passed).withColumns({name: value.over(by) for name, value in sums.items()})
    low = (F.col("_n") < kept) | (F.col("_total") < gene_least)
    label = F.when(low, "LowExp").when(F.col("_phased") / F.col("_total") < gene_ratio, "Unphased").when(F.col("_left") < kept, "NoSplice")
    return rows.withColumn("label", label).drop(*sums)


def bulk_genes(counts: DataFrame, keys: list[str], fdr: float = FDR, delta: float = DELTA, **limits) -> DataFrame:
    """keys, statistic, df, delta, p, fdr, label of each sample's genes: why one is not tested, else True or False.

    FDR over the genes of all samples together; a delta of just ``delta`` passes. Genes whose p is no number stay LowExp, the label of
    whatever has no other.
    """
    rows = bulk_transcripts(counts, keys, **limits)
    table = stats.chi2(rows.where("label is null and passed"), keys, "trans", "h1", "h2")
    tested = stats.bh(table.withColumn("p", stats.chi2_p("statistic", "df")), "p", [], keys)
    verdict = F.when(F.isnan("fdr"), "LowExp").when((F.col("fdr") <= fdr) & (F.col("delta") >= delta), "True").otherwise("False")
    untested = rows.where("label is not null").groupBy(*keys).agg(F.first("label").alias("label"))
    return tested.withColumn("label", verdict).unionByName(untested, allowMissingColumns=True)


def bulk_significant(counts: DataFrame, keys: list[str], fdr: float = FDR, delta: float = DELTA, p: float = P, **limits) -> DataFrame:
    """keys, trans, h1, h2, p, ratio1, ratio2, hap, fdr: the transcripts of True genes that lean to one allele (hap)."""
    genes = bulk_genes(counts, keys, fdr, delta, **limits).where("label = 'True'").select(*keys, "fdr")
    rows = bulk_transcripts(counts, keys, **limits).where("label is null and passed").join(genes, keys)
    share = lambda c: F.coalesce(F.expr(f"{c} / nullif(sum({c}) over (partition by {', '.join(keys)}), 0)"), F.lit(0.0))
    found = each_against_rest(rows.withColumns({"ratio1": share("h1"), "ratio2": share("h2")}), keys, left="h1", right="h2")
    leaning = found.where((F.abs(F.col("ratio1") - F.col("ratio2")) >= delta) & (F.col("p") <= p))
    return leaning.withColumn("hap", F.when(F.col("ratio1") > F.col("ratio2"), "H1").otherwise("H2")).select(*keys, "trans", "h1", "h2", "p", "ratio1", "ratio2", "hap", "fdr")
