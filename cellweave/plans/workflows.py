"""Whole analyses, from files to results, as one plan each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sequences, stats
from ..operators import barcodes, intervals, molecules, quant, splicing, variants
from ..sources import tables


def extract_reads(alignments: DataFrame, skip_chimeric: bool = False) -> DataFrame:
    """qname, chrom, start, end, bc, umi, bu, is_perfect, ts_tag of the alignments that are kept."""
    kept = alignments.select("*", *molecules.read_filter("flag", F.col("sa").isNotNull(), skip_chimeric)).where("not skip")
    bases = kept.withColumn("reverse", sequences.is_reverse()).withColumn("bases", sequences.candidate())
    tags = sequences.tags(bases.select("qname", "chrom", "start", F.col("stop").alias("end"), F.col("ts").alias("ts_tag"), "bases"), "bases")
    return tags.where("bc <> ''").drop("bases")


def reference_barcodes(reads: DataFrame, count: int | None = None, bc_len: int = 16, umi_len: int = 12) -> DataFrame:
    """bc, umi_count, rank of the cells: the ``count`` richest, or those up to the knee."""
    perfect = reads.where(F.col("is_perfect") & (F.length("bc") == bc_len) & (F.length("umi") == umi_len))
    ranks = barcodes.ranked(barcodes.umi_counts(perfect))
    return ranks.where(F.col("rank") <= count) if count else barcodes.cells_by_knee(ranks)


def assign_reads(reads: DataFrame, cells: DataFrame, compatible: DataFrame, genes: DataFrame, by_region: bool = False, most: int = 1) -> DataFrame:
    """bc, umi, trans, reads, genes: molecules of known cells, clustered by cell or by cell and region."""
    return molecules_of(barcodes.assign(reads, cells.select(F.col("bc").alias("ref"))), reads, compatible, genes, by_region, most)


def molecules_of(known: DataFrame, reads: DataFrame, compatible: DataFrame, genes: DataFrame, by_region: bool = False, most: int = 1) -> DataFrame:
    """The molecules of reads with cells (``barcodes.assign``); regions are merged from all ``reads``, so a read lies in one."""
    keyed = known.join(compatible.select("qname", "trans"), "qname", "left")
    keys = ["cell"]
    if by_region:
        regions = intervals.merge(reads.select("chrom", "start", "end"), stop="end")
        spans = regions.select("chrom", F.col("start").alias("lo"), F.col("end").alias("hi"), F.concat_ws(":", "chrom", "start").alias("region"))
        keyed, keys = intervals.points_in_ranges(keyed, spans, pos="start", bin_size=100_000), ["region", "cell"]
    rows = keyed.select(*keys, F.col("cell_umi").alias("umi"), "qname", "trans", "is_perfect", F.concat_ws(":", "chrom", F.lpad(F.col("start").cast("string"), 12, "0"), "qname").alias("pos"))
    found = molecules.molecules(rows, keys, most=most).withColumnRenamed("cell", "bc")
    return molecules.bc_umi_table(found, genes)


def quantify(found: DataFrame, cells: DataFrame | None = None, categories: str | None = None, haps: DataFrame | None = None) -> DataFrame:
    """gene, cluster, bc, trans, abundance of the molecules of one gene; cells: bc, cluster. With haps (qname, hap) also hap.

    Reads that fail ``categories`` go before alleles are voted on; shares are fitted over all alleles together and
    split among them.
    """
    rows = molecules.keep_elements(found, ["reads", "categories", "splices"], categories) if categories else found
    rows = rows.where("size(genes) = 1 and genes[0] <> 'NA' and not array_contains(trans, 'NA')").withColumn("gene", F.col("genes")[0])
    rows = rows.join(cells, "bc") if cells is not None else rows.withColumn("cluster", F.lit("cluster_0"))
    extra = ["bc"]
    if haps is not None:
        rows, extra = splicing.molecules_voted(rows.select("gene", "cluster", "bc", "trans", "reads"), haps), ["bc", "hap"]
    return quant.abundance(rows.select("gene", "cluster", "trans", *extra), extra=extra)


def allele_table(found: DataFrame, haps: DataFrame, cells: DataFrame, by_read: bool = False) -> DataFrame:
    """cluster, gene, trans, h1, h2, unphased, total of molecules (or reads) of one gene and transcript.

    A molecule without reads (of the wanted kind) counts as unphased; by reads it does not count.
    """
    single = found.where("size(trans) = 1 and size(genes) = 1").select("bc", "umi", F.col("trans")[0].alias("trans"), F.col("genes")[0].alias("gene"), "reads").where("trans <> 'NA'").join(cells, "bc")
    spread = F.explode if by_read else F.explode_outer
    each = single.select("*", spread("reads").alias("qname")).join(haps, "qname", "left")
    keys = ["bc", "umi", "cluster", "gene", "trans"]
    votes = each if by_read else splicing.majority(each, [*keys, "reads"]).drop("h1", "h2")
    return splicing.allele_counts(votes, ["cluster", "gene", "trans"])


def traits_of_genes(genes: DataFrame, snps: DataFrame, catalog: DataFrame, ld: DataFrame, least: float = 0.8) -> DataFrame:
    """gene, donor snp, listed snp, trait, parent, p: variants in genes linked to catalog entries near them."""
    own = variants.snps_in_genes(snps.where("hap is not null"), genes).select("gene", F.col("snp").alias("donor"))
    near = variants.catalog_near(genes, catalog).select("gene", F.col("snp").alias("listed"), "trait", "parent", "p")
    pairs = variants.linked(own.select(F.col("donor").alias("snp")), near.select(F.col("listed").alias("snp")), ld, least)
    same = own.select("donor").distinct().withColumn("listed", F.col("donor"))
    return own.join(pairs.union(same).distinct(), "donor").join(near, ["gene", "listed"])


def split_compatibility(compatible: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows of the read-isoform table once for each chromosome of their transcripts; null where none is known."""
    place = compatible.select("*", F.explode_outer("trans").alias("_t")).join(spans.select(F.col("trans").alias("_t"), "chrom"), "_t", "left")
    rows = place.select(*compatible.columns, "chrom").distinct()
    known = F.count("chrom").over(Window.partitionBy("qname"))
    return rows.withColumn("_k", known).where("chrom is not null or _k = 0").drop("_k")


def write_matrices(found: DataFrame, folder: str, names: DataFrame, cells: DataFrame | None = None, haps: DataFrame | None = None, categories: str | None = None) -> None:
    """Gene and transcript matrices of molecules, in folders ``gene`` and ``transcript``, or one pair for each allele.

    names: gene, gene_name, trans. haps: qname, hap; then a molecule counts for the allele that most of its reads vote for, or none,
    and all alleles share one fit, computed once.
    """
    found = quantify(found, cells, categories, haps)
    if haps is None:
        tables_ = {"": found}
    else:
        found = found.persist()
        tables_ = {f"_haplotype_{h}": found.where(F.col("hap") == h) for h in ("H1", "H2", "none")}
    for suffix, rows in tables_.items():
        genes = rows.groupBy("gene", "bc").agg(F.sum("abundance").alias("value"))
        trans = rows.groupBy("trans", "bc").agg(F.sum("abundance").alias("value"))
        tables.write_10x(quant.sparse(genes), f"{folder}/gene{suffix}", names=names.select(F.col("gene").alias("feature"), F.col("gene_name").alias("name")))
        tables.write_10x(quant.sparse(trans, "trans"), f"{folder}/transcript{suffix}", "trans")
        tables.write_gene_to_trans(names.join(rows.select("trans").distinct(), "trans", "left_semi"), f"{folder}/transcript{suffix}")
    found.unpersist()


def joined(rows: DataFrame, keys: list[str], columns: list[str], order: str = "trans") -> DataFrame:
    """keys, and each column's values joined by commas in the order of ``order``."""
    items = F.array_sort(F.collect_list(F.struct(order, *(c for c in columns if c != order))))
    listed = lambda c: F.array_join(F.transform(F.col(f"_z.{c}"), lambda x: x.cast("string")), ",").alias(c)
    return rows.groupBy(*keys).agg(items.alias("_z")).select(*keys, *map(listed, columns))


def cell_type_splicing(matrix: DataFrame, names: DataFrame, cells: DataFrame, wanted: DataFrame | None = None, least: int = 10, kept: int = 2, all_transcripts: bool = False) -> tuple[DataFrame, DataFrame]:
    """(genes, transcripts): what is spliced otherwise in two cell types, with the columns of the result tables.

    matrix: feature (transcript), bc, value; names: trans, gene, gene_name; cells: bc, cluster. ``wanted`` genes are picked after the
    false discovery rate is found over all.
    """
    rows = matrix.withColumnRenamed("feature", "trans").join(names, "trans").join(cells, "bc")
    counts = rows.groupBy("cluster", "gene", "trans").agg(F.sum("value").alias("value"))
    genes = splicing.differential(counts, least, kept).where("significant")
    if wanted is not None:
        genes = genes.join(wanted.select("gene").distinct(), "gene", "left_semi")
    keys = ["cluster1", "cluster2", "gene"]
    titles = names.groupBy("gene").agg(F.min("gene_name").alias("gene_name"))
    by = Window.partitionBy(*keys)
    pairs = splicing.each_against_rest(splicing.pair_counts(counts, least, kept), keys).join(genes.select(*keys, F.col("fdr"), F.col("delta").alias("max_delta")), keys).join(titles, "gene")
    pairs = pairs.withColumns({"ratio1": F.col("n1") / F.sum("n1").over(by), "ratio2": F.col("n2") / F.sum("n2").over(by)})
    lists = joined(pairs, [*keys, "gene_name", "fdr", "max_delta"], ["trans", "n1", "n2", "ratio1", "ratio2"])
    head = ["gene", "gene_name", "fdr", "max_delta", "trans", "n1", "n2", "ratio1", "ratio2", "cluster1", "cluster2"]
    each = pairs.withColumn("delta", F.abs(F.col("ratio1") - F.col("ratio2")))
    each = each if all_transcripts else each.where(F.col("p") <= splicing.P)
    tail = ["gene", "gene_name", "trans", "fdr", "p", "delta", "n1", "n2", "ratio1", "ratio2", "cluster1", "cluster2"]
    return lists.select(*head).toDF(*tables.SPLICED_GENES), each.select(*tail).toDF(*tables.SPLICED_TRANSCRIPTS)


def splicing_from_files(spark, matrix: str, clusters: str, prefix: str, wanted: str | None = None, **options) -> None:
    """From a written transcript matrix and a list of cells to both result tables."""
    names = tables.gene_to_trans(spark, f"{matrix}/gene_to_trans.tsv*")
    values = tables.matrix_10x(spark, matrix).select("feature", "bc", "value")
    genes, trans = cell_type_splicing(values, names, tables.clusters(spark, clusters), tables.gene_list(spark, wanted) if wanted else None, **options)
    tables.write_tsv(genes, f"{prefix}_cell_specific_spliced_genes.tsv")
    tables.write_tsv(trans, f"{prefix}_cell_specific_spliced_transcripts.tsv")


def gene_names(found: DataFrame) -> DataFrame:
    """gene, gene_name of the molecules of one gene; of several names the least."""
    single = found.where("size(genes) = 1").select(F.col("genes")[0].alias("gene"), F.get("names", F.lit(0)).alias("gene_name"))
    return single.groupBy("gene").agg(F.min("gene_name").alias("gene_name"))


def shares(rows: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """rows with each column's share in the sum over keys, 0 where that is 0; columns: name of the share by column."""
    by = Window.partitionBy(*keys)
    return rows.withColumns({name: F.coalesce(F.try_divide(F.col(c), F.sum(c).over(by)), F.lit(0.0)) for c, name in columns.items()})


def allele_splicing(counts: DataFrame, names: DataFrame, all_genes: bool = False, all_transcripts: bool = False, **limits) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(genes, transcripts, verdicts): what the two alleles splice otherwise in a cell type, with the columns of the result tables.

    counts: cluster, gene, trans, h1, h2, unphased, total; names: gene, gene_name; limits: those of ``splicing.phased``. Transcripts are
    tested in significant genes. verdicts: cluster, gene, gene_name, trans, significant (the gene's; null without an FDR), allele (the
    one with the larger share of a significant transcript, else null).
    """
    keys = ["cluster", "gene"]
    kept = splicing.phased(counts, keys, **limits)
    table = stats.chi2(kept, keys, "trans", "h1", "h2")
    tested = stats.bh(table.withColumn("p", stats.chi2_p("statistic", "df")), "p", [], keys)
    verdict = F.when(~F.isnan("fdr"), (F.col("fdr") <= splicing.FDR) & (F.col("delta") > splicing.DELTA)).alias("significant")
    rows = shares(kept, keys, {"h1": "ratio1", "h2": "ratio2"}).join(tested.select(*keys, "fdr", verdict), keys).join(names, "gene", "left")
    genes = rows if all_genes else rows.where("significant")
    lists = joined(genes, ["cluster", "gene", "gene_name", "fdr"], ["trans", "h1", "h2", "ratio1", "ratio2"])
    each = splicing.each_against_rest(rows.where("significant"), keys, left="h1", right="h2")
    apart = (F.abs(F.col("ratio1") - F.col("ratio2")) > splicing.DELTA) & F.coalesce(F.col("p") <= splicing.P, F.lit(False))
    each = each.withColumn("allele", F.when(apart, F.when(F.col("ratio1") > F.col("ratio2"), "H1").otherwise("H2")))
    shown = each if all_transcripts else each.where("allele is not null")
    verdicts = rows.join(each.select(*keys, "trans", "allele"), [*keys, "trans"], "left").select("cluster", "gene", "gene_name", "trans", "significant", "allele")
    head = ["cluster", "gene", "gene_name", "fdr", "trans", "h1", "h2", "ratio1", "ratio2"]
    tail = ["cluster", "trans", "p", "gene", "gene_name", "fdr", "h1", "h2", "ratio1", "ratio2"]
    return lists.select(*head).toDF(*tables.ALLELE_SPLICED_GENES), shown.select(*tail).toDF(*tables.ALLELE_SPLICED_TRANSCRIPTS), verdicts


def verdict_matrices(verdicts: DataFrame, cell_types: list[str]) -> tuple[DataFrame, DataFrame]:
    """(genes, transcripts): one row each, one column a cell type, of the verdicts of ``allele_splicing``.

    A gene is True, False or Unknown (not tested there). A transcript has its allele, False (tested, alike) or None, and is
    listed if it has an allele somewhere.
    """
    said = F.when(F.col("significant"), "True").otherwise("False")
    genes = verdicts.where("significant is not null").groupBy("gene_name", F.col("gene").alias("gene_id")).pivot("cluster", cell_types).agg(F.first(said)).na.fill("Unknown", cell_types)
    found = F.coalesce("allele", F.lit("False"))
    rows = verdicts.where("significant").groupBy(F.col("trans").alias("transcript_id"), "gene_name", F.col("gene").alias("gene_id")).pivot("cluster", cell_types).agg(F.first(found))
    somewhere = F.greatest(*(F.coalesce(F.col(f"`{c}`").isin("H1", "H2"), F.lit(False)).cast("int") for c in cell_types), F.lit(0)) > 0
    return genes, rows.where(somewhere).na.fill("None", cell_types)


def allele_expression(counts: DataFrame, names: DataFrame) -> DataFrame:
    """Genes of which one allele is expressed more in a cell type, with the columns of the result table; the false discovery rate is over all."""
    keys = ["cluster", "gene"]
    sums = counts.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ("h1", "h2", "unphased", "total")))
    found = splicing.allele_expression(sums).where("significant").withColumn("_n", F.col("h1") + F.col("h2") + F.col("unphased"))
    parts = ("h1", "h2", "unphased")
    totals = F.concat_ws(",", *(F.col(c).cast("string") for c in parts)).alias("totals")
    ratios = F.concat_ws(",", *((F.col(c) / F.col("_n")).cast("string") for c in parts)).alias("ratios")
    rows = shares(counts, keys, {"h1": "ratio1", "h2": "ratio2", "unphased": "ratio3"}).join(found.select(*keys, "fdr", totals, ratios), keys).join(names, "gene", "left")
    head = ["cluster", "gene", "gene_name", "fdr"]
    lists = ["trans", *parts, "ratio1", "ratio2", "ratio3"]
    return joined(rows, [*head, "totals", "ratios"], lists).select(*head, *lists, "totals", "ratios").toDF(*tables.ALLELE_EXPRESSED_GENES)


def alleles_from_files(spark, molecules_: str, clusters: str, haplotypes: str, prefix: str, by_read: bool = False, categories: list[str] | None = None, verdicts: bool = False, **options) -> None:
    """From a molecule table, a list of cells and one of reads with alleles to the tables of splicing and of expression.

    categories: the kinds of reads that vote; verdicts: also the matrices of all genes and transcripts by cell type.
    """
    found = tables.molecules_tsv(spark, molecules_)
    if categories:
        wanted = ", ".join(f"'{c}'" for c in categories)
        found = molecules.keep_elements(found, ["reads", "categories"], f"x.categories in ({wanted})", drop_empty=False)
    cells = tables.clusters(spark, clusters)
    names = gene_names(found)
    counts = allele_table(found, tables.haplotypes(spark, haplotypes), cells, by_read)
    genes, trans, said = allele_splicing(counts, names, **options)
    tables.write_tsv(genes, f"{prefix}_allele_specific_spliced_genes.tsv")
    tables.write_tsv(trans, f"{prefix}_allele_specific_spliced_transcripts.tsv")
    tables.write_tsv(allele_expression(counts, names), f"{prefix}_allele_specific_expressed_genes.tsv")
    if verdicts:
        kinds = [r.cluster for r in cells.select("cluster").distinct().orderBy("cluster").collect()]  # cell types: some tens
        for name, rows in zip(("genes", "transcripts"), verdict_matrices(said, kinds)):
            tables.write_tsv(rows, f"{prefix}_all_{name}_stat.tsv")


def expression_by_cluster(values: DataFrame, cells: DataFrame, keys: list[str]) -> dict[str, DataFrame]:
    """Tables cnt, cpm and pct with one row for the keys and one column a cluster; 0 where there is nothing.

    values: feature, keys and bc, value; cells: bc, cluster. cpm is of all counts of the cluster, pct the share of its cells.
    """
    kinds = [r.cluster for r in cells.select("cluster").distinct().orderBy("cluster").collect()]  # cell types: some tens
    sizes = cells.groupBy("cluster").agg(F.count("*").alias("n_cells"))
    each = values.groupBy("feature", "bc").agg(F.sum("value").alias("value")).join(cells, "bc")
    long = quant.by_cluster(each, sizes, feature="feature").join(values.select("feature", *keys).distinct(), "feature")
    wide = lambda c: long.groupBy(*keys).pivot("cluster", kinds).agg(F.sum(c)).na.fill(0.0, kinds)
    return {"cnt": wide("total"), "cpm": wide("cpm"), "pct": wide("pct")}


def expression_from_files(spark, matrix: str, clusters: str, prefix: str, transcripts: bool = False) -> None:
    """From a written matrix and a list of cells to tables of counts, counts a million and shares of cells by cluster.

    A transcript matrix, with its table of genes beside it, gives those of genes and of transcripts (without shares), a gene matrix
    those of genes by name.
    """
    cells = tables.clusters(spark, clusters)
    values = tables.matrix_10x(spark, matrix)
    if not transcripts:
        made = {"gene": expression_by_cluster(values.select("feature", F.col("name").alias("gene_name"), "bc", "value"), cells, ["gene_name"])}
    else:
        rows = values.select(F.col("feature").alias("transcript_id"), "bc", "value").join(tables.gene_to_trans(spark, f"{matrix}/gene_to_trans.tsv*").withColumnsRenamed({"trans": "transcript_id", "gene": "gene_id"}), "transcript_id")
        one = rows.withColumn("feature", F.col("gene_id"))
        two = expression_by_cluster(rows.withColumn("feature", F.col("transcript_id")), cells, ["gene_id", "gene_name", "transcript_id"])
        made = {"gene": expression_by_cluster(one, cells, ["gene_id", "gene_name"]), "trans": {k: two[k] for k in ("cnt", "cpm")}}
    for kind, by in made.items():
        for name, table in by.items():
            tables.write_tsv(table, f"{prefix}.clu_wise_{kind}_{name}.tsv")


def artifacts(alignments: DataFrame, found: DataFrame, sample: str, five: str, three: str, poly: str = "T" * 15, most_poly: int = 3) -> DataFrame:
    """sample, qname, kind, distances of each mapped read: what its ends hold, and whether it is in a molecule.

    five, three: the primers before and behind a transcript, found with 3 edits in 10. distances: those of the five primer, the T run
    and the three primer, then those of the complement, -1 where not found. Reads without bases have empty ends.
    """
    mapped = alignments.where(F.col("flag").bitwiseAND(molecules.UNMAPPED) == 0)
    ends = mapped.select("qname", sequences.head_bases("seq", "cigar").alias("_head"), sequences.tail_bases("seq", "cigar").alias("_tail"))
    ends = ends.withColumns({"_rh": sequences.revcomp("_head"), "_rt": sequences.revcomp("_tail")})
    most5, most3 = int(0.3 * len(five)), int(0.3 * len(three))
    sought = {"_5": (five, "_head", most5), "_p": (poly, "_head", most_poly), "_3": (three, "_tail", most5), "_5r": (five, "_rt", most5), "_pr": (poly, "_rt", most_poly), "_3r": (three, "_rh", most3)}
    rows = ends.withColumns({c: sequences.located(q, most)(F.col(at)) for c, (q, at, most) in sought.items()})
    rows = rows.withColumns({"_a": F.col("_p").isNotNull(), "_b": F.col("_pr").isNotNull()})
    known = found.select(F.explode("reads").alias("qname")).distinct().withColumn("_bc", F.lit(True))
    kind = F.concat(sequences.read_class("_5", "_3", "_5r", "_3r", "_a", "_b"), F.when(F.col("_bc"), "-with BC").otherwise("-no BC"))
    distances = F.concat_ws(",", *(F.coalesce(c, F.lit(-1)).cast("string") for c in sought))
    return rows.join(known, "qname", "left").select(F.lit(sample).alias("sample"), "qname", kind.alias("kind"), distances.alias("distances"))


def artifacts_from_files(spark, alignments: str, molecules_: str, sample: str, prefix: str, five: str, three: str) -> None:
    """Detail of each read and counts of each kind, without headers."""
    detail = artifacts(tables.sam(spark, alignments), tables.molecules_tsv(spark, molecules_), sample, five, three)
    counts = detail.groupBy("sample", "kind").agg(F.count("*").alias("n"))
    for name, rows in (("detail", detail), ("summary", counts)):
        rows.write.option("sep", "\t").csv(f"{prefix}_{name}.tsv")


def trait_tables(linked: DataFrame, snps: DataFrame, names: DataFrame, traits: list[str] | None = None) -> dict[str, DataFrame]:
    """Tables traits, parents (one row a gene, one column a name) and variants of the rows of ``traits_of_genes``.

    linked: gene (name), listed, trait, parent, p; snps: snp, hap of the donor; names: gene (name), gene_id. Only rows of the parents
    in ``traits`` count (by default those of diseases); they also rank a variant's leading trait.
    """
    order = variants.DISEASES if traits is None else traits
    rows = linked.where(F.col("parent").isin(order)).join(names, "gene").select(F.col("gene").alias("gene_name"), "gene_id", F.col("listed").alias("snp"), "trait", "parent", "p")

    def wide(column: str) -> DataFrame:
        heads = [r[0] for r in rows.select(column).distinct().orderBy(column).collect()]  # names of traits: some hundreds at most
        return rows.groupBy("gene_name", "gene_id").pivot(column, heads).agg(F.lit(True)).na.fill(False, heads)

    keys = ["gene_name", "gene_id", "snp"]
    leading = variants.leading(rows, keys, order=order).join(rows.groupBy(*keys, F.col("trait").alias("leading")).agg(F.min_by("parent", F.array_position(F.array(*map(F.lit, order)), F.col("parent"))).alias("parent")), [*keys, "leading"])
    donor = snps.groupBy("snp").agg(F.min("hap").alias("hap"))
    detail = leading.join(donor, "snp", "left").select("gene_name", "gene_id", "snp", F.col("hap").isNotNull(), F.coalesce("hap", F.lit("NA")), "leading", "parent").toDF(*tables.LISTED_VARIANTS)
    return {"traits": wide("trait"), "parents": wide("parent"), "variants": detail}
