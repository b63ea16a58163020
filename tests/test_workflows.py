import pytest

from cellweave.plans import workflows
from cellweave.sources import tables

MOLECULES = "bc string, umi string, trans array<string>, genes array<string>, reads array<string>, categories array<string>, splices array<string>"


@pytest.fixture
def found(spark):
    rows = [
        ("A", "u1", ["T1"], ["G"], ["r1", "r2"], ["FullLen", "FullLen"], ["Y", "N"]),
        ("A", "u2", ["T1", "T2"], ["G"], ["r3"], ["Partial"], ["Y"]),
        ("B", "u1", ["T2"], ["G"], ["r4"], ["FullLen"], ["Y"]),
        ("B", "u3", ["NA"], ["NA"], ["r5"], ["NA"], ["N"]),
        ("C", "u4", ["T1", "T3"], ["G", "H"], ["r6"], ["FullLen"], ["Y"]),
    ]
    return spark.createDataFrame(rows, MOLECULES)


def test_quantify(spark, found):
    cells = spark.createDataFrame([("A", "x"), ("B", "x")], "bc string, cluster string")
    rows = workflows.quantify(found, cells).collect()
    assert sum(r.abundance for r in rows) == pytest.approx(3) and {r.bc for r in rows} == {"A", "B"}
    full = workflows.quantify(found, categories="x.categories = 'FullLen'").collect()
    assert sorted((r.bc, r.trans, r.abundance) for r in full) == [("A", "T1", pytest.approx(1)), ("B", "T2", pytest.approx(1))]


def test_allele_table(spark, found):
    haps = spark.createDataFrame([("r1", "H1"), ("r2", "H1"), ("r4", "H2")], "qname string, hap string")
    cells = spark.createDataFrame([("A", "x"), ("B", "x"), ("C", "x")], "bc string, cluster string")
    one = sorted(tuple(r) for r in workflows.allele_table(found, haps, cells).collect())
    assert one == [("x", "G", "T1", 1, 0, 0, 1), ("x", "G", "T2", 0, 1, 0, 1)]
    each = sorted(tuple(r) for r in workflows.allele_table(found, haps, cells, by_read=True).collect())
    assert each == [("x", "G", "T1", 2, 0, 0, 2), ("x", "G", "T2", 0, 1, 0, 1)]


def test_traits(spark):
    genes = spark.createDataFrame([("CD3", "1", 1000, 2000, "+")], "gene string, chrom string, start long, stop long, strand string")
    snps = spark.createDataFrame([("rs1", "1", 600, "H1"), ("rs2", "1", 300, "H1"), ("rs3", "1", 1500, None)], "snp string, chrom string, pos long, hap string")
    catalog = spark.createDataFrame([("rs9", "1", 5000, "CD3, X", "flu", "Immune", 1e-9), ("rs8", "1", 5000, "Y", "flu", "Immune", 1e-9)], "snp string, chrom string, pos long, mapped string, trait string, parent string, p double")
    ld = spark.createDataFrame([("rs9", "rs1", 0.9), ("rs1", "rs9", 0.95), ("rs2", "rs9", 0.5)], "snp_a string, snp_b string, r2 double")
    rows = workflows.traits_of_genes(genes, snps, catalog, ld).collect()
    assert [(r.gene, r.donor, r.listed, r.trait) for r in rows] == [("CD3", "rs1", "rs9", "flu")]


def test_split_by_chromosome(spark, tmp_path):
    rows = spark.createDataFrame([("q1", ["T1", "T2"]), ("q2", ["T9"]), ("q3", ["T1", "T9"])], "qname string, trans array<string>")
    spans = spark.createDataFrame([("T1", "chr 1"), ("T2", "chr2")], "trans string, chrom string")
    split = workflows.split_compatibility(rows, spans)
    assert sorted((r.qname, r.chrom or "") for r in split.collect()) == [("q1", "chr 1"), ("q1", "chr2"), ("q2", ""), ("q3", "chr 1")]
    tables.write_by(split.drop("trans"), f"file://{tmp_path}/out", "chrom")
    assert sorted(p.name for p in (tmp_path / "out").glob("chrom=*")) == ["chrom=chr2", "chrom=chr_1", "chrom=unassigned"]


def test_tagged_lines_and_molecule_table(spark, found, tmp_path):
    lines = spark.createDataFrame([("r1", "r1\t0"), ("r2", "r2\t0")], "qname string, line string")
    known = spark.createDataFrame([("r1", "AC")], "qname string, cell string")
    assert [r.value for r in tables.tagged(lines, known, {"CB": "cell"}).collect()] == ["r1\t0\tCB:Z:AC"]
    tables.write_molecules(found.withColumn("names", found.genes), f"file://{tmp_path}/m")
    again = tables.molecules_tsv(spark, f"file://{tmp_path}/m")
    assert sorted((r.bc, r.umi, r.n_reads, tuple(r.trans)) for r in again.collect()) == sorted((r.bc, r.umi, len(r.reads), tuple(r.trans)) for r in found.collect())


def test_from_molecules_to_spliced_genes(spark, tmp_path):
    """Molecules to matrices on disk, and from these to both result tables."""
    rows = []
    for bc, n1, n2 in (("A", 60, 10), ("B", 8, 70)):
        rows += [(bc, f"{bc}{t}{i}", [t], ["G"], [f"{bc}{t}{i}"], ["FullLen"], ["Y"]) for t, n in (("T1", n1), ("T2", n2)) for i in range(n)]
    found = spark.createDataFrame(rows, MOLECULES)
    names = spark.createDataFrame([("G", "Name", "T1"), ("G", "Name", "T2")], "gene string, gene_name string, trans string")
    cells = spark.createDataFrame([("A", "x"), ("B", "y")], "bc string, cluster string")
    workflows.write_matrices(found, f"file://{tmp_path}/m", names, cells)
    (tmp_path / "cells.tsv").write_text("A\tx\nB\ty\n")
    folder = f"file://{tmp_path}/m/transcript"
    assert sorted((r.feature, r.name) for r in tables.matrix_10x(spark, f"file://{tmp_path}/m/gene").select("feature", "name").distinct().collect()) == [("G", "Name")]
    assert sorted(tuple(r) for r in tables.gene_to_trans(spark, f"{folder}/gene_to_trans.tsv*").collect()) == [("T1", "G", "Name"), ("T2", "G", "Name")]
    workflows.splicing_from_files(spark, folder, f"file://{tmp_path}/cells.tsv", f"file://{tmp_path}/out")
    read = lambda kind: spark.read.option("sep", "\t").option("header", True).csv(f"file://{tmp_path}/out_cell_specific_spliced_{kind}.tsv")
    genes, trans = read("genes"), read("transcripts")
    assert genes.columns == tables.SPLICED_GENES and trans.columns == tables.SPLICED_TRANSCRIPTS
    (row,) = genes.collect()
    assert (row.gene_id, row.transcript_ids, row.cell1_counts, row.cell2_counts, row.cell_type1) == ("G", "T1,T2", "60.0,10.0", "8.0,70.0", "x")
    assert sorted(r.transcript_id for r in trans.collect()) == ["T1", "T2"]


def test_matrices_of_alleles(spark, found, tmp_path):
    haps = spark.createDataFrame([("r1", "H1"), ("r2", "H1"), ("r4", "H2")], "qname string, hap string")
    names = spark.createDataFrame([("G", "Name", "T1"), ("G", "Name", "T2")], "gene string, gene_name string, trans string")
    workflows.write_matrices(found, f"file://{tmp_path}/m", names, haps=haps)
    cells = {h: sorted(r.bc for r in tables.matrix_10x(spark, f"file://{tmp_path}/m/gene_haplotype_{h}").collect()) for h in ("H1", "H2", "none")}
    assert cells == {"H1": ["A"], "H2": ["B"], "none": ["A"]}


def test_alleles_share_one_fit(spark, tmp_path):
    """Three molecules of T1 and one of either in H1, nine of T2 in H2: the shared one is split by all thirteen."""
    rows = [("A", f"u{i}", trans, ["G"], [f"r{i}", f"x{i}"], ["FullLen", "Partial"], ["Y", "Y"]) for i, trans in enumerate([["T1"]] * 3 + [["T1", "T2"]] + [["T2"]] * 9)]
    found = spark.createDataFrame(rows, MOLECULES)
    haps = spark.createDataFrame([(f"r{i}", "H1" if i < 4 else "H2") for i in range(13)] + [(f"x{i}", "H2") for i in range(4)], "qname string, hap string")
    names = spark.createDataFrame([("G", "Name", "T1"), ("G", "Name", "T2")], "gene string, gene_name string, trans string")
    workflows.write_matrices(found, f"file://{tmp_path}/m", names, haps=haps, categories="x.categories = 'FullLen'")
    values = {h: {r.feature: round(r.value, 4) for r in tables.matrix_10x(spark, f"file://{tmp_path}/m/transcript_haplotype_{h}").collect()} for h in ("H1", "H2", "none")}
    assert values == {"H1": {"T1": 3.25, "T2": 0.75}, "H2": {"T2": 9.0}, "none": {}}
    tied = workflows.quantify(found, haps=haps).where("hap = 'none'")  # with both reads, one vote each
    assert {r.trans: round(r.abundance, 4) for r in tied.groupBy("trans").agg({"abundance": "sum"}).toDF("trans", "abundance").collect()} == {"T1": 3.25, "T2": 0.75}


def test_alleles_from_files(spark, tmp_path):
    """Two transcripts that the alleles share out unevenly; one gene expressed from one allele."""
    rows, haps = [], []
    for trans, gene, n1, n2, none in (("T1", "G", 30, 5, 1), ("T2", "G", 5, 30, 1), ("T3", "E", 40, 4, 0), ("T4", "F", 20, 20, 0), ("T5", "F", 20, 20, 2)):
        for hap, n in (("H1", n1), ("H2", n2), ("none", none)):
            names = [f"{trans}{hap}{i}" for i in range(n)]
            rows += [("A", q, [trans], [gene], [q], ["FullLen"], ["Y"], [gene.lower()]) for q in names]
            haps += [f"{q}\t{hap}\t1\tchr1" for q in names]
    tables.write_molecules(spark.createDataFrame(rows, MOLECULES + ", names array<string>"), f"file://{tmp_path}/m")
    (tmp_path / "haps.tsv").write_text("#qname\thap\n" + "\n".join(haps) + "\n")
    (tmp_path / "cells.tsv").write_text("A-1\tx\nB-1\ty\n")
    workflows.alleles_from_files(spark, f"file://{tmp_path}/m", f"file://{tmp_path}/cells.tsv", f"file://{tmp_path}/haps.tsv", f"file://{tmp_path}/o", verdicts=True, categories=["FullLen"])
    read = lambda name: spark.read.option("sep", "\t").option("header", True).csv(f"file://{tmp_path}/o_{name}.tsv")
    genes, trans, expressed = (read(f"allele_specific_{n}") for n in ("spliced_genes", "spliced_transcripts", "expressed_genes"))
    assert (genes.columns, trans.columns, expressed.columns) == (tables.ALLELE_SPLICED_GENES, tables.ALLELE_SPLICED_TRANSCRIPTS, tables.ALLELE_EXPRESSED_GENES)
    (row,) = genes.collect()
    assert (row.cell_type, row.gene_id, row.gene_name, row.transcripts, row.hap1_counts, row.hap2_counts) == ("x", "G", "g", "T1,T2", "30,5", "5,30")
    assert sorted((r.transcript_id, r.hap1_count) for r in trans.collect()) == [("T1", "30"), ("T2", "5")]
    (row,) = expressed.collect()
    assert (row.gene_id, row.hap1_counts, row.non_hap_counts, row.non_hap_ratios, row.total_cnts) == ("E", "40", "0", "0.0", "40,4,0")
    assert sorted((r.gene_id, r.x, r.y) for r in read("all_genes_stat").collect()) == [("F", "False", "Unknown"), ("G", "True", "Unknown")]
    assert sorted((r.transcript_id, r.x, r.y) for r in read("all_transcripts_stat").collect()) == [("T1", "H1", "None"), ("T2", "H2", "None")]


def test_expression_from_files(spark, found, tmp_path):
    names = spark.createDataFrame([("G", "Name", "T1"), ("G", "Name", "T2")], "gene string, gene_name string, trans string")
    workflows.write_matrices(found, f"file://{tmp_path}/m", names)
    (tmp_path / "cells.tsv").write_text("A\tx\nB\ty\nC\ty\n")
    read = lambda name: {r[0] if len(r) < 5 else r[2]: tuple(float(v) for v in r[-2:]) for r in spark.read.option("sep", "\t").option("header", True).csv(f"file://{tmp_path}/{name}.tsv").collect()}
    for kind, key in (("gene", "Name"), ("transcript", "G")):
        workflows.expression_from_files(spark, f"file://{tmp_path}/m/{kind}", f"file://{tmp_path}/cells.tsv", f"file://{tmp_path}/{kind}", transcripts=kind == "transcript")
        assert read(f"{kind}.clu_wise_gene_cnt") == {key: (pytest.approx(2), pytest.approx(1))}
        assert read(f"{kind}.clu_wise_gene_cpm") == {key: (pytest.approx(1e6), pytest.approx(1e6))}
        assert read(f"{kind}.clu_wise_gene_pct") == {key: (1.0, 0.5)}
    by_trans = read("transcript.clu_wise_trans_cnt")
    assert sorted(by_trans) == ["T1", "T2"] and sum(v[0] for v in by_trans.values()) == pytest.approx(2)


def test_artifacts_of_reads(spark, tmp_path):
    five, three, body = "CTACACGACGCTCTTCCGATCT", "CCCATGTACTCTGCGTTGATACCACTGCTT", "ACGTTGCA" * 30
    back = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    reads = {"proper": five + "T" * 20 + body + three, "rt": five + body, "tso": body + three, "none": body, "back": back(five + "T" * 20 + body + three)}
    (tmp_path / "a.sam").write_text("@HD\n" + "".join(f"{q}\t{4 if q == 'unmapped' else 0}\tchr1\t10\t60\t{len(s)}M\t*\t0\t0\t{s}\t*\n" for q, s in {**reads, "unmapped": body}.items()))
    (tmp_path / "m.tsv").write_text("#" + "\t".join(tables.MOLECULE_FIELDS) + "\nA\tu\t2\tT\tG\tg\tproper,rt\tFullLen,FullLen\tY,Y\n")
    workflows.artifacts_from_files(spark, f"file://{tmp_path}/a.sam", f"file://{tmp_path}/m.tsv", "s", f"file://{tmp_path}/o", five, three)
    rows = {r[1]: (r[2], r[3]) for r in spark.read.option("sep", "\t").csv(f"file://{tmp_path}/o_detail.tsv").collect()}
    kinds = {q: k for q, (k, _) in rows.items()}
    assert kinds == {"proper": "Proper-with BC", "rt": "RT-with BC", "tso": "TSO-no BC", "none": "No-RT-TSO-no BC", "back": "Proper-no BC"}
    assert rows["proper"][1] == "0,0,0,-1,-1,-1"
    counts = {r[1]: int(r[2]) for r in spark.read.option("sep", "\t").csv(f"file://{tmp_path}/o_summary.tsv").collect()}
    assert counts["Proper-with BC"] == 1 and sum(counts.values()) == 5


def test_trait_tables(spark):
    linked = spark.createDataFrame([("CD3", "rs1", "rs9", "flu", "Other disease", 1e-9), ("CD3", "rs1", "rs9", "lupus", "Immune system disorder", 1e-8), ("CD3", "rs1", "rs1", "height", "Body measurement", 1e-9)], "gene string, donor string, listed string, trait string, parent string, p double")
    snps = spark.createDataFrame([("rs1", "H1")], "snp string, hap string")
    names = spark.createDataFrame([("CD3", "G1")], "gene string, gene_id string")
    made = workflows.trait_tables(linked, snps, names)
    assert [tuple(r) for r in made["variants"].collect()] == [("CD3", "G1", "rs9", False, "NA", "lupus", "Immune system disorder")]
    assert [r.asDict() for r in made["traits"].collect()] == [{"gene_name": "CD3", "gene_id": "G1", "flu": True, "lupus": True}]
    assert made["parents"].columns == ["gene_name", "gene_id", "Immune system disorder", "Other disease"]
