import gzip

import pytest

from cellweave.plans import workflows
from cellweave.sources import tables
from cellweave.streaming import ingest

ADAPTER = "CTACACGACGCTCTTCCGATCT"


def put(folder, name, text, pack=False):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    if pack:
        with gzip.open(path, "wt") as f:
            f.write(text)
    return f"file://{path}"


def alignment(name, bc, umi, flag=0, start=100):
    seq = ADAPTER + bc + umi + "T" * 20 + "ACGT" * 10
    return "\t".join([name, str(flag), "chr1", str(start + 1), "60", f"{len(seq) - 40}S40M", "*", "0", "0", seq, "*", "ts:A:-"])


def test_from_alignments_to_molecules(spark, tmp_path):
    bcs = ["ATCACGACACTTTAGG", "GGCATTACAGATCACA"]
    lines = [alignment(f"r{i}", bcs[i % 2], "ACGTACGTAC" + "ACGT"[i // 2 % 4] * 2, start=100 + i) for i in range(12)]
    lines.append(alignment("bad", bcs[0], "A" * 12, flag=4))
    path = put(tmp_path, "a.sam", "@HD\tVN:1\n" + "\n".join(lines) + "\n")
    reads = workflows.extract_reads(tables.sam(spark, path))
    rows = reads.collect()
    assert len(rows) == 12 and all(r.is_perfect and r.bc in bcs and r.end == r.start + 40 for r in rows)
    tables.write_reads(reads, f"{tmp_path}/reads")
    again = tables.reads_tsv(spark, f"{tmp_path}/reads")
    assert sorted(r.qname for r in again.collect()) == sorted(f"r{i}" for i in range(12))
    cells = workflows.reference_barcodes(again, count=2)
    compatible = spark.createDataFrame([(f"r{i}", ["T1"]) for i in range(12)], "qname string, trans array<string>")
    genes = spark.createDataFrame([("T1", "G")], "trans string, gene string")
    for by_region in (False, True):
        found = workflows.assign_reads(again, cells, compatible, genes, by_region=by_region).collect()
        assert sorted(x for f in found for x in f.reads) == sorted(f"r{i}" for i in range(12))
        assert all(f.genes == ["G"] for f in found)


def test_compatibility_table(spark, tmp_path):
    path = put(tmp_path, "c.tsv", "readId\tequalMatches\tcompatibleMatches\nq1\tT1,T2\tT3\nq2\tNA\tT3,T4\nq3\ts\tFSM\tT5,\nq4\tNA\tNA\n")
    found = {r.qname: (r.category, r.trans) for r in tables.compatibility_tsv(spark, path).collect()}
    assert found == {"q1": ("FullLen", ["T1"]), "q2": ("Partial", ["T3", "T4"]), "q3": ("FSM", ["T5"])}


def test_annotation(spark, tmp_path):
    rows = [("gene", 1, 90, 'gene_id "G"; gene_name "N";'), ("transcript", 1, 50, 'gene_id "G"; transcript_id "T";'), ("exon", 30, 50, 'gene_id "G"; transcript_id "T";'), ("exon", 1, 10, 'gene_id "G"; transcript_id "T";')]
    path = put(tmp_path, "a.gtf", "#!x\n" + "".join(f"chr1\t.\t{k}\t{a}\t{b}\t.\t+\t.\t{t}\n" for k, a, b, t in rows))
    annotation = tables.gtf(spark, path)
    assert tuple(tables.transcripts(annotation).first()) == ("T", "G", "N", "chr1", 1, 50)
    assert [tuple(e) for e in tables.exons(annotation).first().exons] == [(1, 10), (30, 50)]


def test_small_tables(spark, tmp_path):
    assert sorted(r.bc for r in tables.barcode_list(spark, put(tmp_path, "b.tsv", "ACGTACGTACGTACGT-1\nACGTACGTACGTACGT\nACG\n", pack=False)).collect()) == ["ACGTACGTACGTACGT"]
    assert {tuple(r) for r in tables.clusters(spark, put(tmp_path, "k.tsv", "A-1\tx\nB\n")).collect()} == {("A", "x"), ("B", "cluster_0")}
    assert [tuple(r) for r in tables.haplotypes(spark, put(tmp_path, "h.tsv", "#q\nq1\tH1\tp\tc\nq2\tnone\tp\tc\n")).collect()] == [("q1", "H1")]
    vcf = put(tmp_path, "v.vcf", "##x\n#CHROM\n" + "".join(f"chr1\t{p}\t{i}\tA\tC\t.\t.\t.\tGT:DP\t{g}:3\n" for p, i, g in ((5, "rs5", "1|0"), (6, ".", "0|1"), (7, "rs7", "1|1"))))
    assert [tuple(r) for r in tables.vcf(spark, vcf).orderBy("pos").collect()] == [("rs5", "1", 5, "H1"), (None, "1", 6, "H2")]
    assert sorted(r.gene for r in tables.gene_list(spark, put(tmp_path, "g.tsv", "x\tGENE\n1\tCD3\n2\tCD4\n")).collect()) == ["CD3", "CD4"]
    assert sorted(r.gene for r in tables.gene_list(spark, put(tmp_path, "g2.tsv", "CD3\t1\nCD4\t2\n")).collect()) == ["CD3", "CD4"]


def test_matrix_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1, "G1", "A", 2.5), (2, 1, "G2", "A", 1.0), (2, 2, "G2", "B", 4.0)], "feature_idx int, cell_idx int, gene string, bc string, value double")
    folder = f"{tmp_path}/m"
    tables.write_10x(rows, folder)
    for name in ("matrix.mtx", "features.tsv", "barcodes.tsv"):
        (part,) = list((tmp_path / "m" / name).glob("part-*"))
        with gzip.open(part, "rt") as f:
            text = f.read()
        put(tmp_path, f"flat/{name}.gz", text, pack=True)
    flat = f"file://{tmp_path}/flat"
    assert sorted((r.feature, r.bc, r.value) for r in tables.matrix_10x(spark, flat).collect()) == [("G1", "A", 2.5), ("G2", "A", 1.0), ("G2", "B", 4.0)]
    put(tmp_path, "flat/barcodes.tsv.gz", "A\n", pack=True)
    with pytest.raises(ValueError):
        tables.matrix_10x(spark, flat)


def test_stream_counts_each_tag_once(spark, tmp_path):
    fields = lambda q, u: f"{q}\tchr1\t1\t2\tATCACGACACTTTAGG\t{u}\tx\t1\t.\n"
    put(tmp_path, "in/1.tsv", fields("a", "A" * 12) + fields("b", "A" * 12))
    put(tmp_path, "in/2.tsv", fields("c", "C" * 12))
    counts = ingest.running_counts(ingest.read_stream(spark, f"file://{tmp_path}/in", 1))
    run = counts.writeStream.outputMode("complete").format("memory").queryName("counts").option("checkpointLocation", f"file://{tmp_path}/state").start()
    run.processAllAvailable()
    run.stop()
    assert [tuple(r) for r in spark.table("counts").collect()] == [("ATCACGACACTTTAGG", 2)]


def test_the_last_line_counts(spark, tmp_path):
    assert [tuple(r) for r in tables.clusters(spark, put(tmp_path, "k.tsv", "A\tx\nA\ty\nA\tb\n")).collect()] == [("A", "b")]
    assert [tuple(r) for r in tables.haplotypes(spark, put(tmp_path, "h.tsv", "q\tH1\nq\tH2\nq\tnone\n")).collect()] == [("q", "H2")]
    assert [tuple(r) for r in tables.barcode_list(spark, put(tmp_path, "b.tsv", "TT\nAA\nTT\nCC\n"), 2).orderBy("rank").collect()] == [("TT", 1), ("AA", 2), ("CC", 3)]


def test_known_transcripts(spark, tmp_path):
    path = put(tmp_path, "c.tsv", "q1\tT1\tT3\nq2\tNA\tT9, T4,T3\nq3\ts\tFSM\tT5\n")
    known = spark.createDataFrame([("T3",), ("T4",), ("T1",)], "trans string")
    assert {r.qname: r.trans for r in tables.compatibility_tsv(spark, path, known).collect()} == {"q1": ["T1"], "q2": ["T4", "T3"]}


def test_regions():
    assert tables.region(None) == (None, None, None) and tables.region("chr1") == ("chr1", None, None) and tables.region("chr1:5-90") == ("chr1", 5, 90)
    with pytest.raises(ValueError):
        tables.region("chr1:5")


def test_variant_tables(spark, tmp_path):
    head = "DATE\tCHR_ID\tCHR_POS\tSNPS\tMAPPED_GENE\tEFO term\tParent term\tP-VALUE\n"
    rows = tables.catalog(spark, put(tmp_path, "g.tsv", head + "x\t1\t500\trs1-A\tCD3\tflu\tCancer\t1e-9\nx\t1\t\trs2\tCD3\tflu\tCancer\t1e-9\n")).collect()
    assert [tuple(r) for r in rows] == [("1", 500, "rs1-A", "CD3", "flu", "Cancer", 1e-9)]
    assert [tuple(r) for r in tables.linkage(spark, put(tmp_path, "l.tsv", "A\tB\tR2\nrs1\trs2\t0.9\nrs1\trs3\t0\n")).collect()] == [("rs1", "rs2", 0.9)]
    assert [tuple(r) for r in tables.positions(spark, put(tmp_path, "p.tsv", "id\tchr\tpos\nrs1\tchr2\t7\n")).collect()] == [("rs1", "2", 7)]


def test_merged_molecule_tables(spark, tmp_path):
    line = lambda u: "\t".join(["A", u, "1", "T", "G", "N", "r" + u, "Partial", "Y"])
    paths = [put(tmp_path, f"{i}.tsv", "#" + "\t".join(tables.MOLECULE_FIELDS) + "\n" + line(f"u{i}") + "\n") for i in (1, 2)]
    tables.merged_molecules(spark, paths, f"file://{tmp_path}/out")
    assert sorted(r.umi for r in tables.molecules_tsv(spark, f"file://{tmp_path}/out").collect()) == ["u1", "u2"]


def test_merged_alignments(spark, tmp_path):
    paths = [put(tmp_path, "a.sam", alignment("r1", "A" * 16, "C" * 12, start=70) + "\n"), put(tmp_path, "b.sam", alignment("r2", "A" * 16, "C" * 12, start=7) + "\n")]
    assert [r.qname for r in tables.merged_alignments(spark, paths).collect()] == ["r2", "r1"]


def test_written_ranks(spark, tmp_path):
    tables.write_barcodes(spark.createDataFrame([("B", 4, 2), ("A", 9, 1)], "bc string, umi_count long, rank long"), f"file://{tmp_path}/ranks")
    assert [tuple(r) for r in spark.read.option("sep", "\t").option("header", True).csv(f"file://{tmp_path}/ranks").collect()] == [("A", "1", "9"), ("B", "2", "4")]


def test_lines_are_numbered_by_blocks(spark, tmp_path):
    for i, n in enumerate((3000, 1, 0, 2500)):
        (tmp_path / f"l{i}.tsv").write_text("".join(f"{i}:{j}\n" for j in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = tables._numbered(spark, f"file://{tmp_path}/l*.tsv")
        assert rows.rdd.getNumPartitions() > 4
        found = [r.value for r in rows.orderBy("nth").collect()]
        assert found == [f"{i}:{j}" for i, n in enumerate((3000, 1, 0, 2500)) for j in range(n)]
        assert sorted(r.nth for r in rows.collect()) == list(range(1, 5502))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_matrix_files_are_joined_from_parts(spark, tmp_path):
    from cellweave.operators import quant

    values = spark.createDataFrame([(f"G{i % 40:02d}", f"{'ACGT'[i % 4] * 4}{i % 90:03d}", float(i % 7 + 1)) for i in range(2000)], "gene string, bc string, value double").groupBy("gene", "bc").agg({"value": "max"}).toDF("gene", "bc", "value").repartition(6)
    indexed = quant.sparse(values)
    tables.write_10x(indexed, f"file://{tmp_path}/m")
    assert sorted(str(p.relative_to(tmp_path)) for p in (tmp_path / "m").glob("*/*")) == [f"m/{x}/part-00000.txt.gz" for x in ("barcodes.tsv", "features.tsv", "matrix.mtx")]
    with gzip.open(tmp_path / "m" / "matrix.mtx" / "part-00000.txt.gz", "rt") as f:
        head, sizes, *body = f.read().splitlines()
    assert head.startswith("%%MatrixMarket") and [int(x) for x in sizes.split()] == [40, values.select("bc").distinct().count(), len(body)]
    places = [(int(x.split()[1]), int(x.split()[0])) for x in body]
    assert places == sorted(set(places))
    again = {(r.feature, r.bc): r.value for r in tables.matrix_10x(spark, f"file://{tmp_path}/m").collect()}
    assert again == {(r.gene, r.bc): r.value for r in values.collect()}
    empty = quant.sparse(values.limit(0))
    tables.write_10x(empty, f"file://{tmp_path}/e")
    assert tables.matrix_10x(spark, f"file://{tmp_path}/e").collect() == []
