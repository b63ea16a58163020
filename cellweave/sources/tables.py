"""Readers and writers of the text formats around single-cell reads. Gzip is read as it comes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.molecules import compatibility
from ..operators.partitioning import numbered
from .joined import write_lines

# The column names of the file formats.
READ_FIELDS = "qname string, chrom string, start int, end int, bc string, umi string, bu string, is_perfect string, ts_tag string"
MOLECULE_FIELDS = ["CellBarcode", "UMI", "ReadCount", "TranscriptID", "GeneID", "GeneName", "ReadNames", "TransCate", "SpliceTag"]
MARKED_FIELDS = ["#CellBarcode", *MOLECULE_FIELDS[1:]]
GENE_FIELDS = ["gene_id", "gene_name", "transcript"]
SPLICED_GENES = ["gene_id", "gene_name", "gene_fdr", "max_delta_ratio", "transcript_ids", "cell1_counts", "cell2_counts", "cell1_ratios", "cell2_ratios", "cell_type1", "cell_type2"]
SPLICED_TRANSCRIPTS = ["gene_id", "gene_name", "transcript_id", "gene_fdr", "transcript_pval", "delta_ratio", "count1", "count2", "ratio1", "ratio2", "cell_type1", "cell_type2"]
ALLELE_SPLICED_GENES = ["cell_type", "gene_id", "gene_name", "gene_fdr", "transcripts", "hap1_counts", "hap2_counts", "hap1_ratios", "hap2_ratios"]
ALLELE_SPLICED_TRANSCRIPTS = ["cell_type", "transcript_id", "transcript_pval", "gene_id", "gene_name", "gene_fdr", "hap1_count", "hap2_count", "hap1_ratio", "hap2_ratio"]
ALLELE_EXPRESSED_GENES = ["cell_type", "gene_id", "gene_name", "gene_fdr", "transcripts", "hap1_counts", "hap2_counts", "non_hap_counts", "hap1_ratios", "hap2_ratios", "non_hap_ratios", "total_cnts", "total_ratios"]
LISTED_VARIANTS = ["gene_name", "gene_id", "snp_id", "is_donor_snp_id", "haplotype", "gwas_trait", "gwas_trait_efo_term"]
CATALOG_FIELDS = {"CHR_ID": "chrom", "CHR_POS": "pos", "SNPS": "snps", "MAPPED_GENE": "mapped", "EFO term": "trait", "Parent term": "parent", "P-VALUE": "p"}


def lines(spark: SparkSession, path: str | list[str], comment: str = "#") -> DataFrame:
    return spark.read.text(path).where((F.length("value") > 0) & ~F.col("value").startswith(comment))


def first_of(pairs: Column) -> Column:
    """A map of an array of structs (key, value), both text; of equal keys the first counts."""
    empty = F.array().cast("array<struct<col1:string,col2:string>>")
    return F.map_from_entries(F.aggregate(pairs, empty, lambda held, x: F.when(F.exists(held, lambda y: y["col1"] == x["col1"]), held).otherwise(F.concat(held, F.array(x)))))


def derived() -> dict[str, Column]:
    """stop, sa and ts of alignments with start, cigar and tags."""
    used = F.expr("aggregate(regexp_extract_all(cigar, '(\\\\d+)[MDN=X]', 1), 0, (a, x) -> a + cast(x as int))")
    return {"stop": F.col("start") + used, "sa": F.try_element_at("tags", F.lit("SA")), "ts": F.try_element_at("tags", F.lit("ts"))}


def sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Alignments of SAM text: qname, flag, chrom, start (0-based), stop, mapq, cigar, seq, sa, ts, tags; of a tag that comes twice the first."""
    f = F.split("value", "\t")
    rows = lines(spark, path, "@").select(f.alias("f")).where(F.size("f") >= 11)
    tags = first_of(F.transform(F.slice("f", 12, 1000), lambda t: F.struct(F.substring(t, 1, 2), F.substring(t, 6, 1 << 20))))
    out = rows.select(F.col("f")[0].alias("qname"), F.col("f")[1].cast("int").alias("flag"), F.col("f")[2].alias("chrom"), (F.col("f")[3].cast("int") - 1).alias("start"), F.col("f")[4].cast("int").alias("mapq"), F.col("f")[5].alias("cigar"), F.col("f")[9].alias("seq"), tags.alias("tags"), F.array_join("f", "\t").alias("line"))
    return out.withColumns(derived())


def reads_tsv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Reads with tags, as written by ``write_reads``; rows with fewer fields are dropped."""
    f = F.split("value", "\t")
    names = [x.split() for x in READ_FIELDS.split(", ")]
    rows = lines(spark, path).select(f.alias("f")).where(F.size("f") >= len(names))
    out = rows.select(*(F.col("f")[i].cast(kind).alias(name) for i, (name, kind) in enumerate(names)))
    return out.withColumns({"is_perfect": F.col("is_perfect") == "1", "ts_tag": F.nullif("ts_tag", F.lit("."))})


def barcode_list(spark: SparkSession, path: str | list[str], length: int = 16) -> DataFrame:
    """bc, rank: each once, by its first line, of a list whose lines may go on after a dash, space or tab."""
    rows = lines(spark, path).select(F.split(F.trim("value"), r"[- \t]")[0].alias("bc"), F.monotonically_increasing_id().alias("_at")).where(F.length("bc") == length)
    return numbered(rows.groupBy("bc").agg(F.min("_at").alias("_at")), "_at", "rank").select("bc", (F.col("rank") + 1).alias("rank"))


def compatibility_tsv(spark: SparkSession, path: str | list[str], known: DataFrame | None = None) -> DataFrame:
    """qname, sample, category, trans of either kind of read-isoform table, told apart by its columns.

    Three: the first equal match is full length, else all compatible ones are partial. Four: as listed. Where
    ``known`` transcripts are given, others are taken out, and reads that are left with none.
    """
    f = F.col("f")
    rows = lines(spark, path).select(F.split("value", "\t").alias("f")).where(F.size("f").isin(3, 4) & (f[0] != "readId"))
    names = lambda c: F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: (F.trim(x) != "") & (F.trim(x) != "NA"))
    three = F.size("f") == 3
    rows = rows.withColumns({"_equal": f[1], "_all": f[2]})
    both = rows.select("f", *compatibility("_equal", "_all"))
    trans = F.when(three, F.col("trans")).otherwise(names(F.get("f", F.lit(3))))
    found = both.select(f[0].alias("qname"), F.when(~three, f[1]).alias("sample"), F.when(three, F.col("category")).otherwise(f[2]).alias("category"), trans.alias("trans"))
    found = found.where((F.size("trans") > 0) | F.col("sample").isNotNull())
    return found if known is None else among(found, known)


def among(compatible: DataFrame, known: DataFrame) -> DataFrame:
    """Rows with their transcripts that ``known`` (column trans) lists, in their order; rows left without any go."""
    lists = compatible.select("trans").distinct()
    each = lists.select(F.col("trans").alias("_all"), F.posexplode("trans").alias("_i", "_t")).join(known.select(F.col("trans").alias("_t")).distinct(), "_t", "left_semi")
    kept = each.groupBy(F.col("_all").alias("trans")).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_t"))), lambda x: x["_t"]).alias("_kept"))
    return compatible.join(kept, "trans").withColumn("trans", F.col("_kept")).select(*compatible.columns)


def gtf(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """chrom, feature, start and stop (1-based, closed), strand, gene, gene_name, trans of each line."""
    f = F.split("value", "\t")
    rows = lines(spark, path).select(f.alias("f")).where(F.size("f") >= 9)
    named = lambda key: F.nullif(F.regexp_extract(F.col("f")[8], f'{key} "([^"]*)"', 1), F.lit(""))
    return rows.select(F.col("f")[0].alias("chrom"), F.col("f")[2].alias("feature"), F.col("f")[3].cast("int").alias("start"), F.col("f")[4].cast("int").alias("stop"), F.col("f")[6].alias("strand"), named("gene_id").alias("gene"), named("gene_name").alias("gene_name"), named("transcript_id").alias("trans"))


def transcripts(annotation: DataFrame) -> DataFrame:
    """trans, gene, gene_name, chrom, start, stop; a missing name is the gene's own line's, else its id."""
    names = annotation.where("feature = 'gene'").groupBy("gene").agg(F.min("gene_name").alias("_own"))
    rows = annotation.where("feature = 'transcript' and trans is not null").join(names, "gene", "left")
    return rows.select("trans", "gene", F.coalesce("gene_name", "_own", "gene").alias("gene_name"), "chrom", "start", "stop").dropDuplicates(["trans"])


def exons(annotation: DataFrame) -> DataFrame:
    rows = annotation.where("feature = 'exon' and trans is not null")
    return rows.groupBy("trans").agg(F.min("chrom").alias("chrom"), F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("exons"))


def clusters(spark: SparkSession, path: str, default: str = "cluster_0") -> DataFrame:
    """bc without its suffix, and its cluster, the last that is listed; lists of one column are one cluster."""
    f = F.split("value", "\t")
    rows = lines(spark, path).select(F.split(f[0], "-")[0].alias("bc"), F.coalesce(F.get(f, F.lit(1)), F.lit(default)).alias("cluster"), F.monotonically_increasing_id().alias("_at"))
    return rows.groupBy("bc").agg(F.max_by("cluster", "_at").alias("cluster"))


def haplotypes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """qname, hap of the reads with an allele; of several lines of a read the last counts."""
    f = F.split("value", "\t")
    rows = lines(spark, path).select(f[0].alias("qname"), f[1].alias("hap"), F.monotonically_increasing_id().alias("_at")).where("hap <> 'none'")
    return rows.groupBy("qname").agg(F.max_by("hap", "_at").alias("hap"))


def vcf(spark: SparkSession, path: str | list[str], sample: str | None = None, regions: str | None = None) -> DataFrame:
    """snp, chrom, pos, hap of the phased heterozygous calls of a sample, the first without a name; snp is null for a dot.

    regions: ``chrom`` or ``chrom:start-stop`` (closed), told from the first two fields of a line before the others are cut. For many
    scans of one file write it by ``layout.write_places`` first.
    """
    column = 9
    if sample is not None:
        heads = [r.value for r in spark.read.text(path).where(F.col("value").startswith("#CHROM\t")).limit(1).collect()]
        names = heads[0].split("\t")[9:] if heads else []
        if sample not in names:
            raise ValueError(f"{sample!r} is no sample; there are {names}")
        column += names.index(sample)
    held = lines(spark, path)
    name, lo, hi = region(regions)
    if name is not None:
        short = lambda c: F.regexp_replace(c, "^chr", "")
        held = held.where(short(F.substring_index("value", "\t", 1)) == name.removeprefix("chr"))
        if lo is not None:
            place = F.substring_index(F.substring_index("value", "\t", 2), "\t", -1).cast("long")
            held = held.where(place.between(lo, hi))
    f = F.split("value", "\t")
    rows = held.select(f.alias("f")).where(F.size("f") > column)
    call = F.split(F.col("f")[column], ":")[0]
    hap = F.when(call == "1|0", "H1").when(call == "0|1", "H2")
    return rows.select(F.nullif(F.col("f")[2], F.lit(".")).alias("snp"), F.regexp_replace(F.col("f")[0], "^chr", "").alias("chrom"), F.col("f")[1].cast("long").alias("pos"), hap.alias("hap")).where("hap is not null")


def gene_to_trans(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """trans, gene, gene_name of the table beside a transcript matrix; of several genes of a transcript the first."""
    f = F.split(F.trim("value"), r"\s+")
    rows = lines(spark, path).select(f.alias("f"), F.monotonically_increasing_id().alias("_at")).where((F.size("f") >= 3) & (F.col("f")[0] != GENE_FIELDS[0]))
    first = rows.groupBy(F.col("f")[2].alias("trans")).agg(F.min_by("f", "_at").alias("f"))
    return first.select("trans", F.col("f")[0].alias("gene"), F.col("f")[1].alias("gene_name"))


def catalog(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """chrom, pos, snps, mapped, trait, parent, p of a trait catalog with a header; rows without a position go."""
    rows = spark.read.option("sep", "\t").option("header", True).csv(path)
    kinds = {"pos": "long", "p": "double"}
    return rows.select(*(F.expr(f"try_cast(`{c}` as {kinds.get(n, 'string')})").alias(n) for c, n in CATALOG_FIELDS.items())).where("pos is not null")


def linkage(spark: SparkSession, path: str | list[str], least: float = 0.0) -> DataFrame:
    """snp_a, snp_b, r2 of a linkage table with a header and these three columns first."""
    rows = spark.read.option("sep", "\t").option("header", True).csv(path)
    a, b, r2 = rows.columns[:3]
    return rows.select(F.col(a).alias("snp_a"), F.col(b).alias("snp_b"), F.expr(f"try_cast(`{r2}` as double)").alias("r2")).where(F.col("r2") > least)


def positions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """rsid, chrom (without chr), pos of a table of known variants with a header and these three columns first."""
    rows = spark.read.option("sep", "\t").option("header", True).csv(path)
    a, b, c = rows.columns[:3]
    return rows.select(F.col(a).alias("rsid"), F.regexp_replace(F.col(b), "^chr", "").alias("chrom"), F.expr(f"try_cast(`{c}` as long)").alias("pos")).where("pos is not null")


def region(text: str | None) -> tuple[str | None, int | None, int | None]:
    """(chromosome, start, stop) of ``chrom`` or ``chrom:start-stop``; what is not given is None."""
    if not text:
        return None, None, None
    chrom, colon, span = text.partition(":")
    if not colon:
        return chrom, None, None
    start, dash, stop = span.partition("-")
    if not (dash and start.isdigit() and stop.isdigit()):
        raise ValueError(f"{text!r} is no region: chrom or chrom:start-stop")
    return chrom, int(start), int(stop)


def gene_list(spark: SparkSession, path: str) -> DataFrame:
    """gene, from the column whose head names it, else from the first."""
    first = [r.value for r in spark.read.text(path).limit(1).collect()]
    heads = first[0].split("\t") if first else []
    known = [i for i, h in enumerate(heads) if h.upper().lstrip("#") in ("GENE", "GENE_ID", "GENEID", "GENE_NAME", "GENENAME")]
    rows = spark.read.text(path).select(F.split("value", "\t")[known[0] if known else 0].alias("gene"), "value")
    return (rows.where(F.col("value") != first[0]) if known else rows).select("gene").where("gene <> ''").distinct()


def matrix_10x(spark: SparkSession, folder: str) -> DataFrame:
    """feature, name, bc, value of a matrix folder; fails where its three files do not agree."""
    numbered = lambda name: _numbered(spark, f"{folder}/{name}.tsv*")
    features, cells = numbered("features"), numbered("barcodes")
    rows = lines(spark, f"{folder}/matrix.mtx*", "%").select(F.split("value", " ").alias("f"), F.monotonically_increasing_id().alias("_at"))
    head = rows.orderBy("_at").first()
    n_features, n_cells, n_values = (int(x) for x in head.f)
    values = rows.where(F.col("_at") != head._at).select(F.col("f")[0].cast("int").alias("i"), F.col("f")[1].cast("int").alias("j"), F.col("f")[2].cast("double").alias("value"))
    seen = values.agg(F.count("*").alias("n"), F.max("i").alias("i"), F.max("j").alias("j")).first()
    if (features.count(), cells.count(), seen.n) != (n_features, n_cells, n_values) or (seen.i or 0) > n_features or (seen.j or 0) > n_cells:
        raise ValueError(f"{folder}: the matrix states {n_features} x {n_cells} with {n_values} values; its files do not agree")
    left = features.select(F.col("nth").alias("i"), F.split("value", "\t").alias("f")).select("i", F.col("f")[0].alias("feature"), F.coalesce(F.get("f", F.lit(1)), F.col("f")[0]).alias("name"))
    right = cells.select(F.col("nth").alias("j"), F.split("value", "-")[0].alias("bc"))
    return values.join(left, "i").join(right, "j").select("feature", "name", "bc", "value")


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """value, nth: the lines of files with their number from 1, in the order of file, block and line.

    A block's lines are numbered by themselves, behind those of the blocks before it, of which there is a row each.
    """
    rows = spark.read.text(path).select("value", F.struct("_metadata.file_path", "_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    blocks = rows.groupBy("_block").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_block", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return rows.join(blocks, "_block").select("value", (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("nth"))


# Writers --------------------------------------------------------------------------------------


def write_tsv(rows: DataFrame, path: str, gzip: bool = False) -> None:
    rows.write.option("sep", "\t").option("header", True).option("compression", "gzip" if gzip else "none").csv(path)


def write_reads(reads: DataFrame, path: str) -> None:
    """Gzipped reads with tags; unknown ts tags are dots."""
    names = [x.split()[0] for x in READ_FIELDS.split(", ")]
    flat = reads.withColumns({"is_perfect": F.col("is_perfect").cast("int"), "ts_tag": F.coalesce("ts_tag", F.lit("."))})
    flat.select(F.concat_ws("\t", *names).alias("value")).write.option("compression", "gzip").text(path)


def write_molecules(found: DataFrame, path: str) -> None:
    """Molecules with bc, umi, trans, genes, names, reads, categories, splices; lists are joined by commas."""
    joined = lambda c: F.array_join(c, ",")
    columns = [F.col("bc"), F.col("umi"), F.size("reads"), *(joined(c) for c in ("trans", "genes", "names", "reads", "categories", "splices"))]
    write_tsv(found.select(*(c.alias(n) for c, n in zip(columns, MARKED_FIELDS))), path)


def write_barcodes(ranks: DataFrame, path: str) -> None:
    """Barcodes with rank and molecules (bc, rank, umi_count), in the order of their ranks."""
    rows = ranks.select(F.col("bc").alias("BC"), F.col("rank").alias("Rank"), F.col("umi_count").alias("UMICount"))
    write_tsv(rows.repartitionByRange("Rank").sortWithinPartitions("Rank"), path)


def merged_molecules(spark: SparkSession, paths: list[str], path: str) -> None:
    """Molecule tables of several runs as one, with one kind of header and every line as it stands."""
    rows = spark.read.text(paths).where(~F.split("value", "\t")[0].isin(MOLECULE_FIELDS[0], MARKED_FIELDS[0]) & (F.length("value") > 0))
    write_tsv(rows.select(*(F.split("value", "\t")[i].alias(n) for i, n in enumerate(MARKED_FIELDS))), path)


def merged_alignments(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Alignments of several files as one table, in the order of chromosome and start, unplaced ones last."""
    rows = sam(spark, paths)
    return rows.repartitionByRange(F.col("chrom") == "*", "chrom", "start").sortWithinPartitions(F.col("chrom") == "*", "chrom", "start")


def write_gene_to_trans(genes: DataFrame, folder: str) -> None:
    """genes: gene, gene_name, trans."""
    write_tsv(genes.select(*(F.col(c).alias(n) for c, n in zip(("gene", "gene_name", "trans"), GENE_FIELDS))).distinct(), f"{folder}/gene_to_trans.tsv", True)


def molecules_tsv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """bc, umi, n_reads and the lists trans, genes, names, reads, categories, splices; the header may start with a # sign."""
    rows = spark.read.option("sep", "\t").option("header", True).csv(path).withColumnRenamed(MARKED_FIELDS[0], MOLECULE_FIELDS[0])
    lists = [F.split(n, ",").alias(a) for n, a in zip(MOLECULE_FIELDS[3:], ("trans", "genes", "names", "reads", "categories", "splices"))]
    return rows.select(F.col("CellBarcode").alias("bc"), F.col("UMI").alias("umi"), F.col("ReadCount").cast("int").alias("n_reads"), *lists)


def write_10x(rows: DataFrame, folder: str, feature: str = "gene", cell: str = "bc", names: DataFrame | None = None) -> None:
    """Indexed values (feature_idx, cell_idx, feature, cell, value) as matrix, features (id and name) and barcodes, each one sorted gzipped text.

    names: feature, name; a feature without one has its id as name. Ranges of indices are sorted and written by a task each and then joined.
    """
    n = rows.agg(F.max("feature_idx").alias("i"), F.max("cell_idx").alias("j"), F.count("*").alias("n")).first()
    one = lambda df, order, name, value, head="": write_lines(df.repartitionByRange(*order).sortWithinPartitions(*order).select(value.alias("value")), f"{folder}/{name}/part-00000.txt.gz", head)
    head = f"%%MatrixMarket matrix coordinate real general\n{n.i or 0} {n.j or 0} {n.n}\n"
    one(rows, ["cell_idx", "feature_idx"], "matrix.mtx", F.concat_ws(" ", "feature_idx", "cell_idx", "value"), head)
    ids = rows.select("feature_idx", F.col(feature).cast("string").alias("feature")).distinct()
    ids = ids.withColumn("name", F.col("feature")) if names is None else ids.join(names.select("feature", "name").dropDuplicates(["feature"]), "feature", "left")
    one(ids, ["feature_idx"], "features.tsv", F.concat_ws("\t", "feature", F.coalesce("name", "feature")))
    one(rows.select("cell_idx", F.col(cell).cast("string").alias("bc")).distinct(), ["cell_idx"], "barcodes.tsv", F.col("bc"))


def write_by(rows: DataFrame, path: str, key: str, missing: str = "unassigned") -> None:
    """One folder for each value of key, rows without one under ``missing``."""
    safe = F.regexp_replace(F.regexp_replace(F.col(key), "/", ","), " ", "_")
    rows.withColumn(key, F.coalesce(safe, F.lit(missing))).write.partitionBy(key).option("sep", "\t").option("header", True).csv(path)


def tagged(alignments: DataFrame, assigned: DataFrame, tags: dict[str, str]) -> DataFrame:
    """SAM lines of the reads that were assigned, with their tags; assigned: qname and the tags' columns."""
    extra: list[Column] = [F.concat(F.lit(f"{t}:Z:"), F.col(c).cast("string")) for t, c in tags.items()]
    return alignments.join(assigned, "qname").select(F.concat_ws("\t", "line", *extra).alias("value"))
