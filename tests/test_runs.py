"""Whole commands on small files."""

import random

from cellweave.operators import variants
from cellweave.plans import runs
from cellweave.sources import alignments, tables

from .test_sources import alignment

HEADER = "@HD\tVN:1.6\n@SQ\tSN:chr2\tLN:100000\n@SQ\tSN:chr1\tLN:100000\n@PG\tID:cellweave\tPN:cellweave\n"
CELLS = ["ATCACGACACTTTAGG", "GGCATTACAGATCACA"]


def put(folder, name, text):
    (folder / name).write_text(text)
    return f"file://{folder / name}"


def gtf(genes):
    out = ""
    for gene, name, chrom, start, stop, strand, transcripts in genes:
        out += f'{chrom}\t.\tgene\t{start}\t{stop}\t.\t{strand}\t.\tgene_id "{gene}"; gene_name "{name}";\n'
        out += "".join(f'{chrom}\t.\ttranscript\t{start}\t{stop}\t.\t{strand}\t.\tgene_id "{gene}"; transcript_id "{t}"; gene_name "{name}";\n' for t in transcripts)
    return out


def test_the_barcode_call_from_files_to_files(spark, tmp_path):
    lines, isoforms = [], "readId\tequalMatches\tcompatibleMatches\n"
    for i in range(24):
        line = alignment(f"r{i:02d}", CELLS[i % 2], "ACGTACGTAC" + "ACGT"[i // 2 % 4] * 2, start=5000 - 7 * i)
        lines.append(line if i % 3 else line.replace("\tchr1\t", "\tchr2\t"))
        isoforms += f"r{i:02d}\tT{1 + i % 2}\tNA\n" if i % 4 else f"r{i:02d}\tNA\tT1,T2\n"
    broken = CELLS[0][:7] + "T" + CELLS[0][8:]
    lines += [alignment("near", broken, "TTTTACGTACAA", start=10), alignment("far", "C" * 16, "TTTTACGTACAA", start=10), alignment("gone", CELLS[0], "A" * 12, flag=4)]
    isoforms += "near\tT1\tNA\n"
    sam = put(tmp_path, "a.sam", HEADER + "\n".join(lines) + "\n")
    alignments.write_alignments(tables.sam(spark, sam).select("line"), f"{tmp_path}/a.bam", HEADER)
    annotation = put(tmp_path, "a.gtf", gtf([("G1", "Name", "chr1", 1, 9000, "+", ["T1", "T2"])]))
    out = f"file://{tmp_path}/out"
    found = runs.call_barcodes(spark, f"file://{tmp_path}/a.bam", put(tmp_path, "c.tsv", isoforms), annotation, out, count=2)
    assert found == {"mapped": 26, "assigned": 25, "perfect_exact": 24, "perfect_corrected": 1, "imperfect_exact": 0, "imperfect_corrected": 0, "distance_0": 24, "distance_1": 1, "distance_2": 0, "cells": 2}
    assert sorted((tmp_path / "out" / "ref_bc.tsv").read_text().split()) == CELLS
    bam = alignments.bam(spark, f"{out}/bc_umi.sorted.bam", 1).collect()
    assert len(bam) == 25 and [r.chrom for r in bam] == ["chr2"] * 8 + ["chr1"] * 17
    assert all([r.start for r in bam if r.chrom == c] == sorted(r.start for r in bam if r.chrom == c) for c in ("chr1", "chr2"))
    tags = {r.qname: r.tags for r in bam}
    assert tags["near"] | {"ts": ""} == {"ts": "", "CB": CELLS[0], "UB": "TTTTACGTACAA", "BE": "1", "TC": "FullLen", "TI": "T1", "GI": "G1", "GN": "Name"}
    assert alignments.read_header(f"{out}/bc_umi.sorted.bam").count("ID:cellweave.2") == 1
    table = tables.molecules_tsv(spark, f"{out}/bc_umi.tsv").collect()
    assert sorted(q for r in table for q in r.reads) == sorted(tags) and all(r.n_reads == len(r.reads) == len(r.categories) == len(r.splices) for r in table)
    values = tables.matrix_10x(spark, f"{out}/expression_matrix/gene").collect()
    assert {r.name for r in values} == {"Name"} and abs(sum(r.value for r in values) - len(table)) < 1e-6
    # a given list of cells, SAM output, by region
    again = runs.call_barcodes(spark, sam, f"file://{tmp_path}/c.tsv", annotation, f"file://{tmp_path}/again", barcode_list=put(tmp_path, "l.txt", f"{CELLS[0]}-1\n"), by_region=True, kind="sam")
    assert (again["assigned"], again["cells"]) == (13, 1)
    assert {r.tags["CB"] for r in tables.sam(spark, f"file://{tmp_path}/again/bc_umi.sorted.sam").collect()} == {CELLS[0]}
    # one file a cluster, and both merged again
    cells = put(tmp_path, "cells.tsv", f"{CELLS[0]}-1\tT cell\n")
    runs.split_by_cluster(spark, f"{out}/bc_umi.sorted.bam", cells, f"file://{tmp_path}/by")
    assert [p.name for p in (tmp_path / "by").iterdir()] == ["T_cell.bam"]
    assert alignments.bam(spark, f"file://{tmp_path}/by").count() == 13
    runs.merge_alignments(spark, [f"file://{tmp_path}/by/T_cell.bam", sam], f"file://{tmp_path}/merged.bam")
    merged = alignments.bam(spark, f"file://{tmp_path}/merged.bam", 1).collect()
    places = [(["chr2", "chr1"].index(r.chrom), r.start) for r in merged]
    assert len(merged) == 13 + 27 and places == sorted(places)


def test_chimeric_reads_as_reads_of_their_own(spark, tmp_path):
    fields = lambda q, flag, at: "\t".join([q, str(flag), "chr1", str(at), "9", "4M", "*", "0", "0", "ACGT", "*"])
    lines = [fields("a", 0, 5), fields("a", 2048, 1), fields("u", 4, 0), fields("b", 2064, 9), fields("c", 2048 | 256, 9)]
    path = put(tmp_path, "a.sam", HEADER + "\n".join(lines) + "\n")
    runs.split_chimeric(spark, path, f"file://{tmp_path}/o.bam")
    assert [(r.qname, r.flag, r.start) for r in alignments.bam(spark, f"{tmp_path}/o.bam", 1).collect()] == [("a", 0, 4), ("a_r0x1", 0, 0), ("b_r0x2", 16, 8), ("c_r0x3", 2304, 8)]


def test_bulk_samples_from_files(spark, tmp_path):
    """One gene spliced by allele, one of one allele, one alike, one with too few reads, in two samples."""
    rows, haps = [], []
    for trans, n1, n2, none in (("T1", 40, 5, 0), ("T2", 5, 40, 0), ("T3", 40, 0, 1), ("T4", 30, 30, 0), ("T5", 30, 30, 0), ("T6", 3, 3, 0)):
        for hap, n in (("H1", n1), ("H2", n2), ("none", none)):
            rows += [f"{trans}{hap}{i}\ts1\tFSM\t{trans}," for i in range(n)]
            haps += [f"{trans}{hap}{i}\t{hap}\t1\tchr1" for i in range(n)]
    rows += ["x\ts2\tFSM\tT1", "y\ts2\tFSM\tT1,T2", "z\ts2\tFSM\tNA"]
    annotation = put(tmp_path, "a.gtf", gtf([("G1", "A", "chr1", 1, 9, "+", ["T1", "T2"]), ("G2", "B", "chr1", 1, 9, "+", ["T3"]), ("G3", "C", "chr1", 1, 9, "+", ["T4", "T5"]), ("G4", "D", "chr1", 1, 9, "+", ["T6"])]))
    runs.bulk_alleles(spark, [put(tmp_path, "c.tsv", "\n".join(rows) + "\n")], annotation, annotation, [put(tmp_path, "h.tsv", "#qname\n" + "\n".join(haps) + "\n")], f"file://{tmp_path}/o")
    read = lambda name: [r.asDict() for r in spark.read.option("sep", "\t").option("header", True).csv(f"file://{tmp_path}/o_{name}.tsv").collect()]
    (gene,) = read("allele_spliced_gene")
    assert (gene["sample"], gene["gene_name"], gene["transcripts"], gene["hap1_counts"], gene["hap2_counts"]) == ("s1", "A", "T1,T2", "40,5", "5,40")
    assert sorted((r["transcript_id"], r["hap1_count"]) for r in read("allele_spliced_transcript")) == [("T1", "40"), ("T2", "5")]
    assert {(r["gene_name"], r["total_cnts"]) for r in read("allele_expressed_gene")} == {("B", "40,0,1")}
    assert sorted(map(str, read("allele_spliced_genes_basic"))) == sorted(map(str, [{"gene_name": "A", "gene_id": "G1", "s1": "True", "s2": "LowExp"}, {"gene_name": "C", "gene_id": "G3", "s1": "False", "s2": "LowExp"}]))
    assert sorted((r["transcript_id"], r["s1"], r["s2"]) for r in read("allele_spliced_transcripts_basic")) == [("T1", "H1", "None"), ("T2", "H2", "None")]


def test_linkage_squares_are_the_sparse_pairs_made_dense(spark):
    rng = random.Random(4)
    snps = [(f"g{g}", f"rs{g}{i}", 10 * ((i * 7) % 11)) for g in range(3) for i in range(rng.randrange(1, 9))]
    pairs = [(a[1], b[1], rng.random()) for a in snps for b in snps if a[1] < b[1] and rng.random() < 0.5]
    pairs += [(b, a, r / 2) for a, b, r in pairs[:5]]
    found = variants.linkage_squares(spark.createDataFrame(snps, "gene string, snp string, pos int"), spark.createDataFrame(pairs, "snp_a string, snp_b string, r2 double")).collect()
    best = {}
    for a, b, r in pairs:
        for key in ((a, b), (b, a)):
            best[key] = max(best.get(key, 0.0), r)
    assert len(found) == len(snps)
    for r in found:
        names = [s for _, _, s in sorted((g, p, s) for g, s, p in snps if g == r.gene)]
        assert r.names == names and r.snp == names[r.nth - 1]
        assert r["values"] == [1.0 if n == r.snp else best.get((r.snp, n), 0.0) for n in names]


def test_traits_from_files(spark, tmp_path):
    annotation = put(tmp_path, "a.gtf", gtf([("G1", "CD3", "chr1", 1000, 2000, "+", ["T1"]), ("G2", "CD4", "chr1", 5000, 6000, "-", ["T2"])]))
    calls = "".join(f"chr1\t{pos}\t{name}\tA\tC\t.\t.\t.\tGT:x\t{gt}:1\n" for pos, name, gt in ((600, "rs1", "1|0"), (1500, ".", "0|1"), (1600, "rs4", "1|0"), (5500, "rs5", "0|1")))
    vcf = put(tmp_path, "d.vcf", "##fileformat\n#CHROM\n" + calls)
    head = "CHR_ID\tCHR_POS\tSNPS\tMAPPED_GENE\tEFO term\tParent term\tP-VALUE\n"
    catalog = put(tmp_path, "cat.tsv", head + "1\t3000\trs9\tCD3, X\tlupus\tImmune system disorder\t1e-8\n1\t1600\trs4\tCD3\tflu\tOther disease\t1e-9\n1\t1600\trs4\tCD3\theight\tBody measurement\t1e-9\n")
    linkage = put(tmp_path, "ld.tsv", "a\tb\tr2\nrs9\trs7\t0.9\nrs1\trs4\t0.3\n")
    positions = put(tmp_path, "pos.tsv", "rsid\tchrom\tpos\nrs7\tchr1\t1500\n")
    runs.traits(spark, put(tmp_path, "g.tsv", "gene_name\nCD3\nCD4\n"), annotation, vcf, catalog, linkage, positions, f"file://{tmp_path}/o")
    read = lambda name: [r.asDict() for r in spark.read.option("sep", "\t").option("header", True).csv(f"file://{tmp_path}/o_{name}.tsv").collect()]
    assert read("gwas_stat") == [{"gene_name": "CD3", "gene_id": "G1", "flu": "true", "lupus": "true"}]
    assert {(r["snp_id"], r["is_donor_snp_id"], r["haplotype"], r["gwas_trait"]) for r in read("gwas_snps_detailed")} == {("rs9", "false", "NA", "lupus"), ("rs4", "true", "H1", "flu")}
    assert [p.name for p in (tmp_path / "o_gwas_snps_ld").glob("gene=*")] == ["gene=CD3"]
    (part,) = (tmp_path / "o_gwas_snps_ld" / "gene=CD3").glob("part-*.txt")
    rows = [x.split("\t") for x in part.read_text().splitlines()]
    assert rows[0] == ["snp_id", "rs1", "rs7", "rs4", *runs.LINKAGE_HEAD]
    assert rows[1:] == [["rs1", "1.0", "0.0", "0.3", "H1", "1", "600", "None", "NA", "NA", "NA"], ["rs7", "0.0", "1.0", "0.0", "H2", "1", "1500", "ld_with_gwas", "NA", "NA", "NA"], ["rs4", "0.3", "0.0", "1.0", "H1", "1", "1600", "gwas", "flu", "Other disease", "1.0E-9"]]
