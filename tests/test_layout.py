"""Region scans: the right rows, one folder, and fewer row groups than there are."""

import random

import pytest

from cellweave.sources import layout, tables


def leaf(df):
    """(filters of folders, of columns, rows that the scan gave) after the query has run."""
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.partitionFilters().mkString(" "), scan.dataFilters().mkString(" "), scan.metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def placed(spark, tmp_path_factory):
    folder = f"file://{tmp_path_factory.mktemp('layout')}/reads"
    rng = random.Random(7)
    rows = [(f"q{i}", rng.choice(["chr1", "chr1", "chr2"]), (a := rng.randrange(2_000_000)), a + rng.randrange(1, 40_000)) for i in range(60_000)] + [("u", None, 0, 0)]
    df = spark.createDataFrame(rows, "qname string, chrom string, start int, stop int").repartition(6)
    layout.write_places(df, folder, group_bytes=1 << 15)
    return folder, rows


def test_a_region_is_pruned_to_folder_and_row_groups(spark, placed):
    folder, rows = placed
    for text, lo, hi in (("chr1:500000-520000", 500_000, 520_000), ("chr2:0-1", 0, 1), ("chr2:1999999-2100000", 1_999_999, 2_100_000)):
        chrom = text.split(":")[0]
        found = layout.places(spark, folder, text)
        assert sorted(r.qname for r in found.collect()) == sorted(q for q, c, a, b in rows if c == chrom and a < hi and b > lo)
        folders, columns, read = leaf(found)
        assert "chrom" in folders and all(c in columns for c in ("bin", "start", "stop"))
        assert read < 0.5 * sum(c == chrom for _, c, _, _ in rows)
    closed = layout.places(spark, folder, "chr1:500000-520000", closed=True)
    assert closed.count() == sum(c == "chr1" and a <= 520_000 and b >= 500_000 for _, c, a, b in rows)
    assert layout.places(spark, folder, "chr1").count() == sum(c == "chr1" for _, c, _, _ in rows)
    assert layout.places(spark, folder).count() == len(rows) and layout.places(spark, folder, "chrX:1-2").collect() == []


def test_overlaps_with_many_regions_meet_once(spark, placed):
    folder, rows = placed
    rng = random.Random(8)
    regions = [(rng.choice(["chr1", "chr2"]), (a := rng.randrange(2_000_000)), a + rng.choice([1, 500, 90_000])) for _ in range(40)]
    found = layout.in_regions(layout.places(spark, folder).drop("bin"), spark.createDataFrame(regions, "chrom string, lo int, hi int"))
    want = sorted((q, lo, hi) for c, lo, hi in regions for q, d, a, b in rows if c == d and a < hi and b > lo)
    assert sorted((r.qname, r.lo, r.hi) for r in found.collect()) == want


def test_calls_of_a_sample_in_a_region(spark, tmp_path):
    calls = [("chr1", 5, "1|0", "0|1"), ("chr1", 9, "0|1", "1|1"), ("2", 5, "1|0", "1|0")]
    text = "##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ta\tb\n" + "".join(f"{c}\t{p}\trs{p}\tA\tC\t.\t.\t.\tGT\t{x}\t{y}\n" for c, p, x, y in calls)
    (tmp_path / "v.vcf").write_text(text)
    path = f"file://{tmp_path}/v.vcf"
    rows = lambda **more: sorted((r.chrom, r.pos, r.hap) for r in tables.vcf(spark, path, **more).collect())
    assert rows() == rows(sample="a") == [("1", 5, "H1"), ("1", 9, "H2"), ("2", 5, "H1")]
    assert rows(sample="b") == [("1", 5, "H2"), ("2", 5, "H1")] and rows(sample="b", regions="chr1") == [("1", 5, "H2")]
    assert rows(regions="1:6-9") == [("1", 9, "H2")] and rows(regions="2:6-9") == []
    with pytest.raises(ValueError, match="no sample"):
        tables.vcf(spark, path, sample="c")
