"""Whole commands, from files to files: the barcode call, alignments rewritten, bulk samples by allele, traits of genes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import barcodes, molecules, splicing, variants
from ..operators.partitioning import stored
from ..sources import alignments as bam
from ..sources import tables
from ..sources.joined import write_lines
from . import workflows

PROGRAM = "cellweave"
#: The tags of an assigned read, and the names of the result tables of bulk samples.
TAGS = {"CB": ("Z", "bc"), "UB": ("Z", "umi"), "BE": ("i", "ed"), "TC": ("Z", "category"), "TI": ("Z", "trans"), "GI": ("Z", "genes"), "GN": ("Z", "names")}
BULK_GENES = ["sample", "gene_id", "gene_name", "gene_fdr", "transcripts", "hap1_counts", "hap2_counts", "hap1_ratios", "hap2_ratios"]
BULK_TRANSCRIPTS = ["sample", "transcript_id", "transcript_p", "gene_id", "gene_name", "gene_fdr", "hap1_count", "hap2_count", "hap1_ratio", "hap2_ratio"]
BULK_EXPRESSED = ["sample", "gene_id", "gene_name", "transcripts", "hap1_counts", "hap2_counts", "non_hap_counts", "hap1_ratios", "hap2_ratios", "non_hap_ratios", "total_cnts", "total_ratios"]
LINKAGE_HEAD = ["haplotype", "chrom", "pos", "type", "gwas_trait", "gwas_trait_efo_term", "gwas_pvalue"]


def alignments_of(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of a BAM file or folder, or of SAM text, told apart by the name."""
    return tables.sam(spark, path) if path.rstrip("/").split(".")[-1] in ("sam", "gz", "txt") else bam.bam(spark, path)


def sorted_alignments(rows: DataFrame, header: str) -> DataFrame:
    """Rows in the order of the header's references and the start, unplaced ones last, by ranges."""
    known = list(bam.references_of(header))
    place = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for i, n in enumerate(known) for x in (n, i))), F.col("chrom")), F.lit(len(known))) if known else F.lit(0)
    dealt = rows.withColumn("_place", place)
    return dealt.repartitionByRange("_place", "start", "line").sortWithinPartitions("_place", "start", "line").drop("_place")


def merge_alignments(spark: SparkSession, paths: list[str], out: str, kind: str = "bam") -> None:
    """Alignments of several files as one sorted file, behind the header of the first."""
    header = bam.read_header(paths[0])
    rows = [alignments_of(spark, p).select("chrom", "start", "line") for p in paths]
    whole = rows[0]
    for more in rows[1:]:
        whole = whole.unionByName(more)
    bam.write_alignments(sorted_alignments(whole, header), out, header, program=PROGRAM, command="merge", kind=kind)


def split_by_cluster(spark: SparkSession, path: str, clusters: str, out: str, kind: str = "bam") -> None:
    """One file for each cluster in the folder ``out``, of the alignments whose CB tag is a listed cell."""
    rows = alignments_of(spark, path).withColumn("bc", F.try_element_at("tags", F.lit("CB"))).where("bc is not null")
    each = rows.join(tables.clusters(spark, clusters), "bc").select("chrom", "start", "line", "cluster")
    header = bam.read_header(path)
    bam.write_alignments(sorted_alignments(each, header), out, header, by="cluster", program=PROGRAM, command="split by cluster", kind=kind)


def split_chimeric(spark: SparkSession, path: str, out: str, kind: str = "bam") -> None:
    """Mapped alignments as one file, supplementary ones as reads with names of their own; see ``molecules.rename_chimeric``."""
    rows = alignments_of(spark, path).select("qname", "flag", "line", F.monotonically_increasing_id().alias("place"))
    named = molecules.rename_chimeric(stored(rows, "alignments"))
    rest = F.array_join(F.slice(F.split("line", "\t"), 3, 1 << 20), "\t")
    lines = named.select("place", F.concat_ws("\t", "qname", F.col("flag").cast("string"), rest).alias("line"))
    bam.write_alignments(lines.repartitionByRange("place").sortWithinPartitions("place"), out, bam.read_header(path), program=PROGRAM, command="split chimeric", kind=kind)


def named_genes(annotation: DataFrame) -> DataFrame:
    """trans, gene: the gene's id and name with a tab between, of transcripts."""
    return tables.transcripts(annotation).select("trans", F.concat_ws("\t", "gene", "gene_name").alias("gene"))


def per_read(found: DataFrame) -> DataFrame:
    """found with a row for each of its reads (qname) and its place in the list (_i); _row tells molecules apart."""
    return found.withColumn("_row", F.monotonically_increasing_id()).select("*", F.posexplode("reads").alias("_i", "qname"))


def summary_of(name: str, rows: DataFrame) -> tuple[DataFrame, Observation]:
    """rows, and the counts of their four kinds and of edit distances that are known once rows are written."""
    seen = Observation(name)
    n = lambda test, label: F.count(F.when(test, 1)).alias(label)
    exact = F.col("ed") == 0
    kinds = [n(F.col("is_perfect") & exact, "perfect_exact"), n(F.col("is_perfect") & ~exact, "perfect_corrected"), n(~F.col("is_perfect") & exact, "imperfect_exact"), n(~F.col("is_perfect") & ~exact, "imperfect_corrected")]
    return rows.observe(seen, F.count(F.lit(1)).alias("assigned"), *kinds, *(n(F.col("ed") == i, f"distance_{i}") for i in range(3))), seen


def call_barcodes(spark: SparkSession, path: str, compatible: str, annotation: str, out: str, barcode_list: str | None = None, count: int | None = None, clusters: str | None = None, by_region: bool = False, skip_chimeric: bool = False, most: int = 1, kind: str = "bam") -> dict[str, int]:
    """From alignments, a read-isoform table and an annotation to cells, molecules, tagged alignments and matrices in ``out``.

    Without ``barcode_list`` the cells are found among the reads: ranks and the plain list in rank order are written too.
    Returns, and writes as summary.tsv, the counts of reads; they come from the passes that write the results, not from scans of their own.
    """
    header = bam.read_header(path)
    counted = Observation("alignments")
    rows = alignments_of(spark, path).observe(counted, F.count(F.when(F.col("flag").bitwiseAND(molecules.UNMAPPED) == 0, 1)).alias("mapped"))
    reads = stored(workflows.extract_reads(rows, skip_chimeric), "reads")
    if barcode_list:
        cells = tables.barcode_list(spark, barcode_list)
    else:
        cells = workflows.reference_barcodes(reads, count)
        tables.write_barcodes(cells, f"{out}/high_qual_bc.rank.tsv")
        cells = stored(cells, "cells")
        write_lines(cells.repartitionByRange("rank").sortWithinPartitions("rank").select("bc"), f"{out}/ref_bc.tsv")
    genes = stored(named_genes(tables.gtf(spark, annotation)), "genes")
    isoforms = stored(tables.compatibility_tsv(spark, compatible, genes).dropDuplicates(["qname"]), "isoforms")
    known = stored(barcodes.assign(reads, cells.select(F.col("bc").alias("ref"))), "assigned")
    found = workflows.molecules_of(known, reads, isoforms, genes, by_region, most)
    part = lambda i: F.transform("genes", lambda g: F.coalesce(F.get(F.split(g, "\t"), F.lit(i)), F.lit("NA")))
    found = stored(found.withColumns({"names": part(1), "genes": part(0)}), "molecules")
    each = per_read(found).join(isoforms.select("qname", "category"), "qname", "left").join(known.select("qname", "ed", "is_perfect", "ts_tag").dropDuplicates(["qname"]), "qname")
    each = stored(each.withColumns({"category": F.coalesce("category", F.lit("NA")), "splice": F.when(F.col("ts_tag").isNotNull(), "Y").otherwise("N")}), "tagged")
    lists = F.array_sort(F.collect_list(F.struct("_i", "qname", "category", "splice")))
    table = each.groupBy("_row", "bc", "umi", "trans", "genes", "names").agg(lists.alias("_z"))
    table = table.select("bc", "umi", "trans", "genes", "names", F.col("_z.qname").alias("reads"), F.col("_z.category").alias("categories"), F.col("_z.splice").alias("splices"))
    tables.write_molecules(table, f"{out}/bc_umi.tsv")

    flat = {c: F.array_join(c, ",") for c in ("trans", "genes", "names")}
    tags = [F.concat(F.lit(f"{tag}:{t}:"), F.col(c).cast("string")) for tag, (t, c) in TAGS.items()]
    own = each.withColumns(flat).select("qname", "ed", "is_perfect", *(t.alias(f"_t{i}") for i, t in enumerate(tags)))
    primary = alignments_of(spark, path).where(F.col("flag").bitwiseAND(molecules.UNMAPPED | molecules.SECONDARY | molecules.SUPPLEMENTARY) == 0).select("qname", "chrom", "start", "line")
    plain = F.regexp_replace("line", "\t(CB|UB|BE|TC|TI|GI|GN):[^\t]*", "")
    tagged = primary.join(own, "qname").withColumn("line", F.concat_ws("\t", plain, *(f"_t{i}" for i in range(len(tags)))))
    tagged, seen = summary_of("assigned", sorted_alignments(tagged, header))  # behind the shuffle: ranges are found by a pass of their own
    bam.write_alignments(tagged, f"{out}/bc_umi.sorted.{kind}", header, program=PROGRAM, command="call", kind=kind)

    names = genes.select("trans", F.split("gene", "\t")[0].alias("gene"), F.split("gene", "\t")[1].alias("gene_name"))
    workflows.write_matrices(table, f"{out}/expression_matrix", names.select("gene", "gene_name", "trans"), tables.clusters(spark, clusters) if clusters else None)
    result = {**counted.get, **seen.get, "cells": cells.count()}
    tables.write_tsv(spark.createDataFrame(sorted(result.items()), "what string, n long").coalesce(1), f"{out}/summary.tsv")
    return result


def bulk_counts(compatible: DataFrame, transcripts: DataFrame, haps: DataFrame) -> DataFrame:
    """sample, gene, trans, h1, h2, unphased, total of the reads of one transcript. compatible: qname, sample, trans; transcripts: trans, gene."""
    single = compatible.where("size(trans) = 1").select("qname", "sample", F.col("trans")[0].alias("trans")).join(transcripts.select("trans", "gene"), "trans")
    return splicing.allele_counts(single.join(haps, "qname", "left"), ["sample", "gene", "trans"])


def bulk_alleles(spark: SparkSession, compatible: list[str], annotation: str, reference: str, haplotypes: list[str], prefix: str, **limits) -> None:
    """From read-isoform tables of samples, an annotation, a reference one (for names) and reads with alleles to the five tables of bulk samples."""
    own, more = (tables.transcripts(tables.gtf(spark, p)) for p in (annotation, reference))
    usable = "trans <> 'NA' and gene <> 'NA' and not contains(trans, ',') and not contains(gene, ',')"
    names = own.where("gene_name <> gene").select("gene", "gene_name", F.lit(0).alias("_o")).union(more.select("gene", "gene_name", F.lit(1)))
    names = names.groupBy("gene").agg(F.min_by("gene_name", F.struct("_o", "gene_name")).alias("gene_name"))
    counts = stored(bulk_counts(tables.compatibility_tsv(spark, compatible), own.where(usable), tables.haplotypes(spark, haplotypes)), "bulk")
    keys = ["sample", "gene"]
    titled = lambda df: df.join(names, "gene", "left").withColumn("gene_name", F.coalesce("gene_name", "gene"))
    verdicts = stored(splicing.bulk_genes(counts, keys, **limits), "verdicts")
    shown = splicing.bulk_transcripts(counts, keys, **{k: v for k, v in limits.items() if k not in ("fdr", "delta", "p")}).where("label is null and passed")
    rows = titled(workflows.shares(shown, keys, {"h1": "ratio1", "h2": "ratio2"}).join(verdicts.where("label = 'True'").select(*keys, "fdr"), keys))
    listed = workflows.joined(rows, [*keys, "gene_name", "fdr"], ["trans", "h1", "h2", "ratio1", "ratio2"])
    tables.write_tsv(listed.select("sample", "gene", "gene_name", "fdr", "trans", "h1", "h2", "ratio1", "ratio2").toDF(*BULK_GENES), f"{prefix}_allele_spliced_gene.tsv")
    leaning = titled(splicing.bulk_significant(counts, keys, **limits))
    tables.write_tsv(leaning.select("sample", "trans", "p", "gene", "gene_name", "fdr", "h1", "h2", "ratio1", "ratio2").toDF(*BULK_TRANSCRIPTS), f"{prefix}_allele_spliced_transcript.tsv")

    sums = counts.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ("h1", "h2", "unphased", "total")))
    parts = ("h1", "h2", "unphased")
    whole = [F.concat_ws(",", *(F.col(c).cast("string") for c in parts)).alias("totals"), F.concat_ws(",", *((F.col(c) / F.col("total")).cast("string") for c in parts)).alias("parts")]
    one_sided = splicing.bulk_allele_expression(sums).select(*keys, *whole)
    rows = titled(workflows.shares(counts, keys, {"h1": "ratio1", "h2": "ratio2", "unphased": "ratio3"}).join(one_sided, keys))
    listed = workflows.joined(rows, [*keys, "gene_name", "totals", "parts"], ["trans", *parts, "ratio1", "ratio2", "ratio3"])
    tables.write_tsv(listed.select("sample", "gene", "gene_name", "trans", *parts, "ratio1", "ratio2", "ratio3", "totals", "parts").toDF(*BULK_EXPRESSED), f"{prefix}_allele_expressed_gene.tsv")

    samples = [r[0] for r in counts.select("sample").distinct().orderBy("sample").collect()]  # samples: some hundreds
    said = verdicts.where("label <> 'LowExp'").groupBy("gene").pivot("sample", samples).agg(F.first("label")).na.fill("LowExp", samples)
    tables.write_tsv(titled(said).select("gene_name", F.col("gene").alias("gene_id"), *(f"`{s}`" for s in samples)), f"{prefix}_allele_spliced_genes_basic.tsv")
    tested = shown.join(verdicts.where("label = 'True'").select(*keys), keys, "left_semi").select(*keys, "trans").join(leaning.select(*keys, "trans", "hap"), [*keys, "trans"], "left")
    heads = tested.withColumn("hap", F.coalesce("hap", F.lit("False"))).groupBy("gene", "trans").pivot("sample", samples).agg(F.first("hap")).na.fill("None", samples)
    heads = titled(heads.join(leaning.select("gene", "trans").distinct(), ["gene", "trans"], "left_semi"))
    tables.write_tsv(heads.select(F.col("trans").alias("transcript_id"), "gene_name", F.col("gene").alias("gene_id"), *(f"`{s}`" for s in samples)), f"{prefix}_allele_spliced_transcripts_basic.tsv")


def linkage_files(snps: DataFrame, ld: DataFrame, listed: DataFrame, linked: DataFrame, folder: str) -> None:
    """A square table of linkage for each gene, in folders gene=NAME: one header, one line a variant of the donor.

    snps: gene, snp, chrom, pos, hap; listed: gene, snp, trait, parent, p (the leading ones of the gene's listed variants); linked:
    gene, snp of the donor's variants in linkage with one of those. Only genes with a listed or linked variant are written.
    """
    wanted = linked.select("gene").distinct()
    mine = snps.join(wanted, "gene", "left_semi")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("NA"))
    known = mine.groupBy("gene", "snp").agg(*(F.min(c).alias(c) for c in ("hap", "chrom", "pos")))
    known = known.join(listed, ["gene", "snp"], "left").join(linked.select("gene", "snp", F.lit(True).alias("_ld")).distinct(), ["gene", "snp"], "left")
    kind = F.when(F.col("trait").isNotNull(), "gwas").when(F.col("_ld"), "ld_with_gwas").otherwise("None")
    rows = variants.linkage_squares(mine, ld).join(known, ["gene", "snp"])
    numbers = F.array_join(F.transform("values", lambda x: x.cast("string")), "\t")
    line = F.concat_ws("\t", "snp", numbers, text("hap"), text("chrom"), text("pos"), kind, text("trait"), text("parent"), text("p"))
    head = F.concat_ws("\t", F.lit("snp_id"), F.array_join("names", "\t"), F.lit("\t".join(LINKAGE_HEAD)))
    lines = rows.select("gene", F.col("nth").alias("_o"), line.alias("value")).union(rows.where("nth = 1").select("gene", F.lit(0), head))
    lines.repartition("gene").sortWithinPartitions("gene", "_o").select("gene", "value").write.partitionBy("gene").text(folder)


def traits(spark: SparkSession, genes: str, annotation: str, vcf: str, catalog: str, linkage: str, positions: str | None, prefix: str, least: float = 0.8, sample: str | None = None) -> None:
    """From a gene list, an annotation, a donor's phased calls (``sample``, else the first one's), a trait catalog and linkage tables to the trait tables and a square for each gene."""
    lines = tables.gtf(spark, annotation).where("feature = 'gene'").withColumn("gene_name", F.coalesce("gene_name", "gene"))
    wanted = tables.gene_list(spark, genes).select(F.col("gene").alias("gene_name"))
    own = lines.join(wanted, "gene_name", "left_semi").withColumn("chrom", F.regexp_replace("chrom", "^chr", ""))
    hulls = stored(variants.gene_hull(own, "gene_name", more=["strand", "gene"]).withColumnsRenamed({"gene": "gene_id", "gene_name": "gene"}), "genes")
    calls = tables.vcf(spark, vcf, sample)
    if positions:
        calls = variants.named_by_position(calls, tables.positions(spark, positions))
    calls = stored(calls.where("snp is not null"), "calls")
    near = variants.snp_list(variants.diseases(tables.catalog(spark, catalog))).withColumn("chrom", F.regexp_replace("chrom", "^chr", "")).drop("snps")
    ld = tables.linkage(spark, [linkage] if isinstance(linkage, str) else linkage)
    linked = stored(workflows.traits_of_genes(hulls.select("gene", "chrom", "start", "stop", "strand"), calls, near, ld, least), "linked")
    names = hulls.select("gene", "gene_id")
    made = workflows.trait_tables(linked.drop("donor").distinct(), calls.select("snp", "hap"), names)
    for name, rows in (("gwas_stat", made["traits"]), ("gwas_efo_term_stat", made["parents"]), ("gwas_snps_detailed", made["variants"])):
        tables.write_tsv(rows, f"{prefix}_{name}.tsv")
    donor = variants.snps_in_genes(calls, hulls.select("gene", "chrom", "start", "stop", "strand")).select("gene", "snp", "chrom", "pos", "hap")
    best = Window.partitionBy("gene", "listed").orderBy(F.array_position(F.array(*map(F.lit, variants.DISEASES)), F.col("parent")), "p", "trait")
    listed = linked.withColumn("_k", F.row_number().over(best)).where("_k = 1").select("gene", F.col("listed").alias("snp"), "trait", "parent", "p")
    linkage_files(donor, ld, listed, linked.select("gene", F.col("donor").alias("snp")), f"{prefix}_gwas_snps_ld")
