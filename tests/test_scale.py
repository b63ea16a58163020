"""What a task holds does not grow with the tables: how rows are dealt, and plans that do not read or join twice."""

from pyspark.sql import functions as F

from cellweave.operators import barcodes, intervals, molecules, quant
from cellweave.operators.partitioning import tasks_for
from cellweave.plans import bindings, catalog


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_reads_are_dealt_by_cell_over_tasks_that_grow(spark, sf_dir, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    assert [tasks_for(spark.range(n), each=100) for n in (0, 100 * cores, 100 * cores + 1)] == [cores, cores, cores + 1]
    monkeypatch.setattr(bindings, "tasks_for", lambda rows: 17)
    places = bindings.reads(spark, sf_dir).select("bc", F.spark_partition_id().alias("p")).distinct()
    assert places.groupBy("bc").count().where("count > 1").isEmpty() and places.select("p").distinct().count() == 17


def test_contents_count_each_value_once_without_repeating_rows(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (1, "b", "x"), (1, None, "y"), (2, None, None)], "bc long, gene string, trans string")
    found = barcodes.contents(rows, ["gene", "trans"])
    assert sorted(map(tuple, found.collect())) == [(1, 4, 2, 2), (2, 1, 0, 0)]
    assert "Expand" not in plan_of(found)


def test_stretches_are_merged_within_more_columns(spark):
    rows = spark.createDataFrame([("A", 1, 0, 5), ("A", 1, 5, 8), ("A", 1, 10, 12), ("B", 1, 4, 9), ("A", 2, 6, 7)], "bc string, chrom long, start long, stop long")
    found = intervals.merge(rows, more=["bc"], bin_size=4)
    assert sorted(map(tuple, found.select("bc", "chrom", "start", "stop").collect())) == [("A", 1, 0, 8), ("A", 1, 10, 12), ("A", 2, 6, 7), ("B", 1, 4, 9)]


def test_tags_of_a_place_meet_once(spark):
    """One tag a hundred times over a stretch: what is joined is the stretch."""
    reads = spark.range(200).selectExpr("if(id % 2 = 0, 'ACGTA', 'ACGTC') as bc", "1L as umi", "1L as chrom", "id div 2 as start", "id div 2 + 9 as stop")
    joined = []
    try:
        merge, barcodes.merge = barcodes.merge, lambda *a, **b: joined.append(merge(*a, **b)) or joined[0]
        ranks = spark.createDataFrame([("ACGTA", 1), ("ACGTC", 2)], "bc string, rank long")
        found = barcodes.candidates_merged(reads, ranks, knee=2, length=5, most=1)
    finally:
        barcodes.merge = merge
    assert sorted((r.bc, r.root) for r in found.collect()) == [("ACGTA", "ACGTA"), ("ACGTC", "ACGTA")]
    assert joined[0].count() == 2


def test_tags_of_one_length_meet_without_joins(spark):
    tags = spark.createDataFrame([(1, "AACC", ["x"]), (1, "AACG", ["x", "y"]), (1, "AAGG", ["y"]), (1, "TTTT", ["x"]), (2, "AACC", ["x"]), (None, "AACG", ["x"]), (None, "AACC", ["x"])], "bc long, umi string, trans array<string>")
    found = molecules.near_tags(tags, ["bc"])
    assert sorted(map(tuple, found.collect())) == [(1, "AACC", "AACG"), (1, "AACG", "AAGG")]
    assert "Join" not in plan_of(found)


def test_allele_matrices_read_the_lines_twice(spark, sf_dir, monkeypatch):
    written = []
    keep = quant.stored
    monkeypatch.setattr(quant, "stored", lambda rows, name: written.append(plan_of(rows)) or keep(rows, name))
    last = plan_of(catalog.allele_matrices(spark, sf_dir))
    assert [p.count("Relation [l_orderkey") for p in [*written, last]] == [2, 0]


def dealt_keys(df) -> set[str]:
    """The keys by which rows are dealt, but by a number of tasks that was asked for."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return {line.split("hashpartitioning(")[1].split("), ENSURE")[0] for line in lines if "Exchange hashpartitioning(" in line and "REPARTITION" not in line}


def test_cells_are_judged_where_they_lie(spark):
    """no deal by feature, of which there are few, and none by cell again."""
    rows = spark.createDataFrame([("g1", "a", 1), ("g1", "b", 2), ("g2", "a", 1), ("g2", "a", 2), ("g2", "b", 0), ("g3", "b", 5), (None, "a", 9), ("g1", None, 3)], "gene string, bc string, value long")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = quant.cell_qc(rows.repartition(3, "bc"), min_cells=2, min_features=1, marked="^none")
        assert sorted(map(tuple, found.collect()), key=str) == [("a", 1, 1, 0.0), ("b", 1, 2, 0.0), (None, 1, 3, 0.0)]
        assert {k.split("#")[0] for k in dealt_keys(found)} == {"gene"} and "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_cells_of_a_cluster_are_counted_where_they_lie(spark):
    """the deal by feature and cluster has sums alone."""
    rows = spark.createDataFrame([("g1", "A", "a", 1), ("g1", "A", "a", 2), ("g1", "A", "b", 0), ("g1", "B", "c", 4), ("g2", "A", None, 5)], "gene string, cluster string, bc string, value long")
    found = quant.by_cluster(rows.repartition(3, "bc"), spark.createDataFrame([("A", 2), ("B", 1)], "cluster string, n_cells long"))
    assert sorted(map(tuple, found.collect())) == [("g1", "A", 3, 375000.0, 0.5), ("g1", "B", 4, 1e6, 1.0), ("g2", "A", 5, 625000.0, 0.0)]
    assert not [k for k in dealt_keys(found) if "bc#" in k]


def test_dealt_reads_of_a_cell_cluster_where_they_lie(spark):
    """one deal, which the caller made, and a search for tags that share a piece and a transcript alone."""
    rows = spark.range(300).selectExpr("id % 7 as bc", "concat(substr('ACGTACGTACGT', 1, 11), substr('ACGT', cast(1 + id % 4 as int), 1)) as umi", "cast(id as string) as qname", "array(concat('t', id % 3)) as trans", "true as is_perfect", "id as pos")
    found = molecules.molecules(rows.repartition(5, "bc"), ["bc"], dealt=True)
    assert not dealt_keys(found)
    plain = molecules.molecules(rows.repartition(5), ["bc"])
    key = lambda df: sorted((r.bc, r.umi, tuple(r.trans), tuple(r.reads)) for r in df.collect())
    assert key(found) == key(plain) == key(molecules.molecules(rows.repartition(5), ["bc"], dealt=True)) and len(key(found)) == 21
    split = molecules.molecules(rows.repartition(5, "bc"), ["bc"], dealt=True, split=20)
    assert key(split) == key(found)


def test_a_tag_is_searched_for_where_pieces_are_shared(monkeypatch):
    """reads of one tag and tags without a common piece need no comparison."""
    seen = []
    search = molecules.search
    monkeypatch.setattr(molecules, "search", lambda *a: seen.append(a) or search(*a))
    reads = [("r1", frozenset("ab"), True), ("r2", frozenset("bc"), True), ("r3", frozenset("c"), True)]
    assert molecules.cluster([("AAAAAACCCCCC", reads), ("GGGGGGTTTTTT", [("r4", frozenset("c"), True)])], 1) == [("AAAAAACCCCCC", ["c"], ["r3", "r2"]), ("AAAAAACCCCCC", ["a", "b"], ["r1"]), ("GGGGGGTTTTTT", ["c"], ["r4"])]
    assert not seen


def test_tags_lose_letters_where_their_cell_lies(spark):
    """a tag is dealt once with its cell, and not once for each text it becomes; within a large cell once to each part at most."""
    letters = "array_join(transform(sequence(0, 4), i -> substr('ACGT', cast(1 + pmod(xxhash64(id, i), 4) as int), 1)), '')"
    tags = spark.range(400).selectExpr("if(id < 300, 1L, 2L) as bc", f"{letters} as umi", "array(concat('t', id % 3)) as trans").groupBy("bc", "umi").agg(F.array_distinct(F.flatten(F.collect_list("trans"))).alias("trans"))
    held: dict[int, list] = {}
    for r in tags.collect():
        held.setdefault(r.bc, []).append((r.umi, set(r.trans), {r.umi} | {r.umi[:i] + r.umi[i + 1 :] for i in range(5)}))
    brute = {(bc, a[0], b[0]) for bc, cell in held.items() for a in cell for b in cell if a[0] < b[0] and a[1] & b[1] and a[2] & b[2]}
    plain, split = molecules.near_tags(tags, ["bc"]), molecules.near_tags(tags, ["bc"], split=90)
    for found in (plain, split):
        assert sorted(map(tuple, found.collect())) == sorted(brute)
        assert not [k for k in dealt_keys(found) if " k#" in k]
    assert len(brute) > 100 and not [k for k in dealt_keys(plain) if "umi" not in k]
