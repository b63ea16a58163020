"""Binary alignments: what is written is read, in any number of splits, and files are one, in order, with one header."""

import gzip
import random

import pytest

from cellweave.sources import alignments, bgzf, tables

HEADER = "@HD\tVN:1.6\tSO:unsorted\n@SQ\tSN:chr1\tLN:100000\n@SQ\tSN:chr2\tLN:50000\n@PG\tID:map\tPN:map\n"


def records(n=400, seed=0, longest=3000):
    """SAM lines of all sorts: unmapped, without bases, with tags of every kind, longer than a block."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        size = 200_000 if i == n // 2 else rng.randrange(0, longest)
        seq = "".join(rng.choices("ACGTN", k=size)) or "*"
        qual = "".join(chr(33 + rng.randrange(60)) for _ in range(size)) if size and i % 3 else "*"
        tags = ["ts:A:+", f"NM:i:{rng.randrange(-5, 3_000_000_000)}", "XF:f:0.5", "SA:Z:chr1,5,+,3M,60,0;", "XB:B:s,-3,4", "XH:H:1AFF"][: rng.randrange(7)]
        mapped = i % 7 > 0
        place = [rng.choice(["chr1", "chr2"]), rng.randrange(1, 40000)] if mapped else ["*", 0]
        cigar = f"{max(size - 10, 0)}M{min(size, 10)}S" if mapped and size else "*"
        out.append("\t".join(map(str, [f"read{i}", 0 if mapped else 4, *place, 60, cigar, "=" if mapped and i % 2 else "*", 0, 0, seq, qual, *tags])))
    return out


def rows_of(df):
    return sorted((r.qname, r.flag, r.chrom, r.start, r.stop, r.mapq, r.cigar, r.seq, r.sa, r.ts, r.line, tuple(sorted(r.tags.items()))) for r in df.collect())


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("alignments")
    lines = records()
    (folder / "a.sam").write_text(HEADER + "\n".join(lines) + "\n")
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string").repartitionByRange(5, "i").sortWithinPartitions("i")
    alignments.write_alignments(rows, f"{folder}/a.bam", HEADER, program="cellweave", command="merge a b")
    return folder, lines


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_binary_and_text_have_equal_rows(spark, written, partitions):
    folder, _ = written
    assert rows_of(alignments.bam(spark, f"{folder}/a.bam", partitions)) == rows_of(tables.sam(spark, f"file://{folder}/a.sam"))


def test_a_file_is_one_stream_with_one_header(spark, written):
    folder, lines = written
    data = gzip.decompress((folder / "a.bam").read_bytes())
    assert data.count(b"BAM\1") == 1 and (folder / "a.bam").read_bytes().endswith(bgzf.END)
    text = alignments.read_header(f"{folder}/a.bam")
    assert text == HEADER + "@PG\tID:cellweave\tPN:cellweave\tPP:map\tCL:merge a b\n"
    assert alignments.read_header(f"{folder}/a.sam") == HEADER
    found = [r.line for r in alignments.bam(spark, f"{folder}/a.bam", 1).collect()]
    assert found == lines  # in the order of the partitions
    assert not list(folder.glob("*_work*")) and not list(folder.glob("*_new"))


def test_every_cut_reads_each_record_once(spark, written):
    """Splits at any byte, also within blocks, block heads and records longer than a split."""
    folder, lines = written
    path = f"{folder}/a.bam"
    size = (folder / "a.bam").stat().st_size
    names = ["chr1", "chr2"]
    reader = alignments.BamReader({"path": path})
    rng = random.Random(2)
    for _ in range(6):
        cuts = sorted(rng.sample(range(1, size), 9))
        got = []
        for a, b in zip([0, *cuts], [*cuts, size]):
            for batch in reader.read(alignments.Split(path, a, b, names)):
                got += batch.column(0).to_pylist()
        assert got == [x.split("\t")[0] for x in lines]


def test_one_file_for_each_cluster(spark, written):
    folder, lines = written
    reads = tables.sam(spark, f"file://{folder}/a.sam")
    keyed = reads.selectExpr("line", "if(flag = 4, null, if(length(seq) > 1000, 'T cell', 'B/x')) as cluster").repartition(4)
    for kind in ("bam", "sam"):
        alignments.write_alignments(keyed, f"{folder}/by_{kind}", HEADER, by="cluster", kind=kind)
        assert sorted(p.name for p in (folder / f"by_{kind}").iterdir()) == [f"{x}.{kind}" for x in ("B,x", "T_cell", "unassigned")]
    got = {}
    for name in ("B,x", "T_cell", "unassigned"):
        got[name] = sorted(r.line for r in alignments.bam(spark, f"{folder}/by_bam/{name}.bam").collect())
        assert got[name] == sorted(r.line for r in tables.sam(spark, f"file://{folder}/by_sam/{name}.sam").collect())
    assert sorted(x for v in got.values() for x in v) == sorted(lines)
    assert all(len(x.split("\t")[9]) > 1000 for x in got["T_cell"])
    whole = alignments.bam(spark, f"{folder}/by_bam")  # a folder is read as one table
    assert whole.count() == len(lines)


def test_damage_and_odd_input(spark, written, tmp_path):
    folder, _ = written
    raw = bytearray((folder / "a.bam").read_bytes())
    raw[len(raw) // 2] ^= 0xFF
    (tmp_path / "bad.bam").write_bytes(raw)
    with pytest.raises(Exception, match="damaged|invalid|no whole block"):
        alignments.bam(spark, f"{tmp_path}/bad.bam", 1).count()
    (tmp_path / "no.bam").write_bytes(bgzf.block(b"text") + bgzf.END)
    with pytest.raises(Exception, match="no BAM file"):
        alignments.bam(spark, f"{tmp_path}/no.bam").count()
    empty = spark.createDataFrame([], "line string")
    alignments.write_alignments(empty, f"{tmp_path}/e.bam", HEADER)
    assert alignments.bam(spark, f"{tmp_path}/e.bam").collect() == [] and alignments.read_header(f"{tmp_path}/e.bam") == HEADER
    with pytest.raises(ValueError, match="neither"):
        alignments.write_alignments(empty, f"{tmp_path}/e.cram", HEADER, kind="cram")


def test_program_lines_are_chained_and_named_apart():
    once = alignments.with_program(HEADER, "map", "1.0")
    assert once.splitlines()[-1] == "@PG\tID:map.2\tPN:map\tPP:map\tVN:1.0"
    assert alignments.with_program("", "x") == "@PG\tID:x\tPN:x\n"


def test_operations_beyond_the_field(spark, tmp_path):
    cigar = "1M1I" * 40_000
    line = "\t".join(["long", "0", "chr1", "7", "9", cigar, "*", "0", "0", "A" * 80_000, "*"])
    alignments.write_alignments(spark.createDataFrame([(line,)], "line string"), f"{tmp_path}/c.bam", HEADER)
    assert alignments.bam(spark, f"{tmp_path}/c.bam").first().line == line


def test_a_tag_that_comes_twice(spark, tmp_path):
    (tmp_path / "t.sam").write_text("\t".join(["q", "0", "chr1", "1", "0", "3M", "*", "0", "0", "ACG", "*", "ts:A:+", "ts:A:-"]) + "\n")
    row = tables.sam(spark, f"file://{tmp_path}/t.sam").first()
    assert (row.ts, row.stop) == ("+", 3)
