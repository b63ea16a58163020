import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.operators import barcodes, intervals, molecules, quant, splicing, variants


def test_regions(spark):
    rows = spark.createDataFrame([("chr1", 0, 10), ("chr1", 10, 20), ("chr1", 21, 30), ("chr2", 0, 5)], "chrom string, start int, stop int")
    for size in (1, 7, 1000):
        assert sorted(map(tuple, intervals.merge(rows, bin_size=size).collect())) == [("chr1", 0, 20), ("chr1", 21, 30), ("chr2", 0, 5)]


def test_regions_against_a_loop(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), s := rng.randrange(500), s + rng.randrange(12)) for _ in range(300)]
    want, at = [], None
    for c, s, e in sorted(rows):
        if at and at[0] == c and s <= at[2]:
            at[2] = max(at[2], e)
        else:
            at = [c, s, e]
            want.append(at)
    found = intervals.merge(spark.createDataFrame(rows, "chrom string, start int, stop int"), bin_size=50).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, want))


def test_read_filter(spark):
    rows = spark.createDataFrame([(4, False), (256, False), (2048, False), (0, True), (0, False)], "flag int, sa boolean")
    keep = [tuple(r) for r in rows.select(*molecules.read_filter("flag", F.col("sa"))).collect()]
    assert keep == [(True, "unmapped"), (True, "unmapped"), (True, "non_primary"), (False, "chimeric"), (False, "proper")]
    strict = [r.skip for r in rows.select(*molecules.read_filter("flag", F.col("sa"), skip_chimeric=True)).collect()]
    assert strict == [True, True, True, True, False]


def clusters(tags):
    return sorted((u, tuple(t), tuple(sorted(r))) for u, t, r in molecules.cluster(tags, 1))


def test_molecule_clustering():
    tags = [("A" * 12, [("r1", frozenset({"T1", "T2"}), True), ("r2", frozenset({"T1", "T2"}), True)]), ("A" * 11 + "C", [("r3", frozenset({"T2"}), False)])]
    assert clusters(tags) == [("A" * 12, ("T2",), ("r1", "r2", "r3"))]
    unknown = [("C" * 12, [("r4", frozenset(), False)]), ("C" * 11 + "G", [("r5", frozenset(), False)])]
    assert clusters(unknown) == [("C" * 12, ("NA",), ("r4", "r5"))]
    third = unknown + [("C" * 10 + "GC", [("r9", frozenset(), False)])]
    assert ("C" * 10 + "GC", ("NA",), ("r9",)) in clusters(third)
    split = [("G" * 12, [("r6", frozenset({"T1"}), False), ("r7", frozenset(), False)])]
    assert clusters(split) == [("G" * 12, ("NA",), ("r7",)), ("G" * 12, ("T1",), ("r6",))]


def test_every_read_is_in_one_molecule(spark):
    rng = random.Random(5)
    rows = [(rng.choice("xyz"), "".join(rng.choices("AC", k=5)), f"r{i}", rng.sample(["T1", "T2", "T3"], rng.randrange(3)), rng.random() < 0.5, i) for i in range(200)]
    found = molecules.molecules(spark.createDataFrame(rows, "bc string, umi string, qname string, trans array<string>, is_perfect boolean, pos int"), ["bc"]).collect()
    assert sorted(r for f in found for r in f.reads) == sorted(r[2] for r in rows)


def test_compatibility(spark):
    rows = spark.createDataFrame([("T1,T2", "T3"), ("NA", "T3,T4")], "e string, c string")
    assert [tuple(r) for r in rows.select(*molecules.compatibility("e", "c")).collect()] == [(["T1"], "FullLen"), (["T3", "T4"], "Partial")]


def test_aligned_lists(spark):
    rows = spark.createDataFrame([(["a", "b"], ["x", "y"]), (["c"], ["x"])], "n array<string>, c array<string>")
    assert [tuple(r) for r in molecules.keep_elements(rows, ["n", "c"], "x.c = 'y'").collect()] == [(["b"], ["y"])]
    assert molecules.keep_elements(rows, ["n", "c"], "x.c = 'y'", drop_empty=False).count() == 2


def test_chimeric_names(spark):
    rows = spark.createDataFrame([("q", 0, 1), ("q", 2048, 2), ("q", 2064, 3)], "qname string, flag int, at int")
    assert sorted((r.qname, r.flag) for r in molecules.rename_chimeric(rows, place="at").collect()) == [("q", 0), ("q_r0x1", 0), ("q_r0x2", 16)]


def test_abundance(spark):
    rows = spark.createDataFrame([("g", "c", ["T1"]), ("g", "c", ["T1"]), ("g", "c", ["T2"]), ("g", "c", ["T1", "T2"]), ("g", "d", ["T3", "T1"]), ("g", "d", [])], "gene string, cluster string, trans array<string>")
    found = {(r.cluster, r.trans): r.abundance for r in quant.abundance(rows).collect()}
    assert found["c", "T1"] == pytest.approx(8 / 3, abs=1e-4) and found["c", "T2"] == pytest.approx(4 / 3, abs=1e-4)
    assert sum(v for (c, _), v in found.items() if c == "d") == pytest.approx(1)


def test_abundance_keeps_the_molecules(spark):
    rng = random.Random(1)
    rows = [("g", rng.choice("cd"), rng.sample(["T1", "T2", "T3"], 1 + rng.randrange(3)), rng.choice(["H1", "H2"])) for _ in range(100)]
    table = spark.createDataFrame(rows, "gene string, cluster string, trans array<string>, hap string")
    assert quant.abundance(table, extra=["hap"]).agg(F.sum("abundance")).first()[0] == pytest.approx(100)


def test_ranks_and_knee(spark):
    counts = spark.createDataFrame([(f"b{i}", c) for i, c in enumerate([5, 9, 5, 1])], "bc string, umi_count int")
    assert [(r.bc, r.rank) for r in barcodes.ranked(counts).orderBy("rank").collect()] == [("b1", 1), ("b0", 2), ("b2", 3), ("b3", 4)]
    curve = np.cumsum(np.r_[np.full(100, 500.0), np.full(900, 2.0)])
    assert 95 <= barcodes.cell_count(curve) <= 105
    with pytest.raises(ValueError):
        barcodes.cell_count(curve[:5])


def test_knees_of_prefixes_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(barcodes, "MOST", 400)
    monkeypatch.setattr(barcodes, "FIRST_PREFIX", 50)
    rng = random.Random(4)
    totals = np.cumsum(sorted((rng.paretovariate(1.1) * 3 for _ in range(390)), reverse=True))
    votes = barcodes.votes_of_prefixes(spark, totals)
    plain = {}
    for size in range(50, 390):
        knee = barcodes.knee_of(totals[:size])
        plain[knee] = plain.get(knee, 0) + 1
    assert list(votes.items()) == list(plain.items()) and len(plain) > 1
    assert barcodes.cell_count(totals, votes) == barcodes.cell_count(totals)


def test_sparse_indices_follow_the_names(spark):
    rng = random.Random(6)
    cells = ["".join(rng.choices("ACGT", k=16)) for _ in range(200)] + ["A", "AC", "ACGTACGTA"]
    rows = spark.createDataFrame([(f"g{i % 7}", c, 1) for i, c in enumerate(cells)], "gene string, bc string, value int")
    found = quant.sparse(rows).collect()
    assert {r.bc: r.cell_idx for r in found} == {c: i for i, c in enumerate(sorted(cells), 1)}
    assert {r.gene: r.feature_idx for r in found} == {f"g{i}": i + 1 for i in range(7)}


def test_bulk_analysis(spark):
    """Each label once, two samples, and the transcripts of the gene that differs."""
    counts = [
        ("s", "low", "a", 9, 0, 0), ("s", "low", "b", 0, 9, 0),
        ("s", "one", "a", 90, 10, 0),
        ("s", "loose", "a", 20, 10, 20), ("s", "loose", "b", 20, 10, 0),
        ("s", "lost", "a", 40, 10, 0), ("s", "lost", "b", 9, 9, 0),
        ("s", "same", "a", 50, 50, 0), ("s", "same", "b", 50, 50, 0),
        ("s", "other", "a", 60, 10, 0), ("s", "other", "b", 10, 60, 1), ("s", "other", "c", 30, 32, 0), ("s", "other", "d", 10, 0, 90),
        ("t", "other", "a", 30, 30, 0), ("t", "other", "b", 30, 30, 0),
    ]
    rows = spark.createDataFrame([(*r, sum(r[3:])) for r in counts], "sample string, gene string, trans string, h1 long, h2 long, unphased long, total long")
    keys = ["sample", "gene"]
    labels = {(r.sample, r.gene): r.label for r in splicing.bulk_genes(rows.where("trans <> 'd'"), keys).collect()}
    assert labels == {("s", "low"): "LowExp", ("s", "one"): "LowExp", ("s", "loose"): "Unphased", ("s", "lost"): "NoSplice", ("s", "same"): "False", ("s", "other"): "True", ("t", "other"): "False"}
    # Unphased reads of a transcript that does not pass count for its gene.
    assert {r.label for r in splicing.bulk_genes(rows.where("gene = 'other' and sample = 's'"), keys).collect()} == {"Unphased"}
    found = {r.trans: (r.hap, r.h1, r.h2) for r in splicing.bulk_significant(rows.where("trans <> 'd'"), keys).collect()}
    assert found == {"a": ("H1", 60, 10), "b": ("H2", 10, 60)}
    assert splicing.bulk_genes(rows.limit(0), keys).collect() == []


def test_nearest_against_all_pairs(spark):
    rng = random.Random(9)
    refs = list({"".join(rng.choices("ACGT", k=16)) for _ in range(25)})
    seen = []
    for _ in range(200):
        b = list(rng.choice(refs))
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(b))
            rng.choice([lambda: b.__setitem__(i, rng.choice("ACGT")), lambda: b.insert(i, rng.choice("ACGT")), lambda: b.pop(i)])()
        seen.append("".join(b)[:16].ljust(16, "A"))
    from cellweave.functions.sequences import search

    want = set()
    for b in set(seen):
        d = {r: search(b, r, 2)[0] for r in refs}
        near = [x for x in d.values() if x >= 0]
        want |= {(b, r, x) for r, x in d.items() if near and x == min(near)}
    table, known = spark.createDataFrame([(b,) for b in seen], ["bc"]), spark.createDataFrame([(r,) for r in refs], ["ref"])
    assert {(r.bc, r.ref, r.ed) for r in barcodes.nearest(table, known).collect()} == want


def test_assign_needs_a_unique_reference(spark):
    a, b = "AACCGGTTAACCGGTT", "AACCGGTTAACCGGTA"
    refs = spark.createDataFrame([(a,), (b,)], ["ref"])
    umi = "ACGTACGTACGT"
    rows = spark.createDataFrame([(1, a, umi, a + umi + "TTTTT"), (2, "AACCGGTTAACCGGTC", umi, "AACCGGTTAACCGGTC" + umi + "TTTTT"), (3, "T" * 16, umi, "T" * 33)], "id int, bc string, umi string, bu string")
    assert [(r.id, r.cell, r.ed) for r in barcodes.assign(rows, refs).collect()] == [(1, a, 0)]


def test_hap_votes(spark):
    rows = spark.createDataFrame([(1, "H1"), (1, "H1"), (1, "H2"), (2, "H1"), (2, "H2"), (3, None)], "k int, hap string")
    assert {r.k: r.hap for r in splicing.majority(rows, ["k"]).collect()} == {1: "H1", 2: "none", 3: "none"}


def test_snp_lists(spark):
    rows = spark.createDataFrame([("rs1 x rs2-rs3",)], ["snps"])
    assert [r.snp for r in variants.snp_list(rows).collect()] == ["rs1", "rs2", "rs3"]


def test_leading_trait_prefers_the_first_parent(spark):
    rows = spark.createDataFrame([(1, "flu", "Other", 1e-9), (1, "lung", "Cancer", 1e-3)], "snp int, trait string, parent string, p double")
    assert variants.leading(rows, ["snp"], order=["Cancer", "Immune"]).first().leading == "lung"


def test_points_in_ranges(spark):
    points = spark.createDataFrame([("c", p) for p in range(0, 100, 7)], "chrom string, pos long")
    ranges = spark.createDataFrame([("c", 5, 30), ("c", 29, 29)], "chrom string, lo long, hi long")
    assert sorted((r.pos, r.lo) for r in intervals.points_in_ranges(points, ranges, bin_size=10).collect()) == [(7, 5), (14, 5), (21, 5), (28, 5)]


def test_repeated_reads_each_keep_their_cell(spark):
    refs = spark.createDataFrame([("ATCACGACACTTTAGG",), ("ATCACGACACTTTAGG",), ("GGCATTACAGATCACA",)], "ref string")
    rows = [("r1", "ATCACGACACTTTAGC", "A" * 12, "ATCACGACACTTTAGC" + "A" * 12 + "TTT", {"k": "v"})] * 2 + [("r2", "ATCACGACACTTTAGG", "C" * 12, "", {})] * 2 + [("r3", None, None, None, {})]
    reads = spark.createDataFrame(rows, "qname string, bc string, umi string, bu string, tags map<string,string>")
    found = sorted((r.qname, r.cell, r.ed) for r in barcodes.assign(reads, refs).collect())
    assert found == [("r1", "ATCACGACACTTTAGG", 1)] * 2 + [("r2", "ATCACGACACTTTAGG", 0)] * 2


def test_ranks_number_all_rows(spark):
    rng = random.Random(2)
    names = sorted({"".join(rng.choices("ACGT", k=8)) for _ in range(500)})
    rows = [(n, rng.choice([1, 1, 1, 2, 7])) for n in names]
    found = barcodes.ranked(spark.createDataFrame(rows, "bc string, umi_count long")).orderBy("rank").collect()
    assert [(r.bc, r.umi_count, r.rank) for r in found] == [(b, c, i + 1) for i, (b, c) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))]


def test_places_in_a_file(spark):
    rows = [(i * 700, "q", 2048 if i % 3 else 4) for i in range(300)]
    found = molecules.rename_chimeric(spark.createDataFrame(rows, "place long, qname string, flag int")).orderBy("place").collect()
    assert [r.qname for r in found] == [f"q_r{hex(i)}" for i in range(200)] and {r.flag for r in found} == {0}


def plain_cluster(tags, most):
    """As ``molecules.cluster``, against every earlier node."""
    from cellweave.functions.sequences import search

    tags, nodes = sorted(tags, key=lambda t: (-len(t[1]), not any(r[2] for r in t[1]))), []
    for umi, reads in tags:
        named = [(r[0], r[1] or frozenset(["NA"]), bool(r[1])) for r in reads]
        common = frozenset.intersection(*(t for _, t, _ in named))
        for names, trans, open_ in [([n for n, _, _ in named], common, True)] if common else [([n], t, k) for n, t, k in sorted(named, key=lambda r: len(r[1]))]:
            near = [(search(umi, o["umi"], most)[0], i) for i, o in enumerate(nodes) if open_ and o["open"] and trans & o["trans"]]
            near = [x for x in near if 0 <= x[0] < len(umi)]
            nodes.append({"umi": umi, "trans": trans, "open": open_, "head": len(nodes), "all": list(names)})
            if near:
                parent = nodes[min(near)[1]]
                head, shared = nodes[parent["head"]], trans & parent["trans"]
                nodes[-1]["trans"] = parent["trans"] = head["trans"] = shared
                nodes[-1]["head"] = parent["head"]
                head["all"] += names
                nodes[-1]["open"] = parent["open"] = head["open"] = shared != {"NA"}
    return [(n["umi"], sorted(n["trans"]), n["all"]) for i, n in enumerate(nodes) if n["head"] == i]


def test_clusters_against_all_pairs():
    rng = random.Random(4)
    for _ in range(60):
        umis = {"".join(rng.choices("AC", k=rng.choice([5, 6, 6, 6, 7]))) for _ in range(25)}
        tags = [(u, [(f"{u}{i}", frozenset(rng.sample(["T1", "T2", "T3"], rng.randrange(3))), rng.random() < 0.5) for i in range(rng.randrange(1, 4))]) for u in sorted(umis)]
        for most in (1, 2):
            assert molecules.cluster(tags, most) == plain_cluster(tags, most)


@pytest.mark.parametrize("most", [1, 2])
def test_a_hot_cell_is_split_and_clusters_the_same(spark, most):
    """A cell with a third of all reads, tags of two lengths, near one another and far; parts are small, results those of the whole cell."""
    rng = random.Random(most)
    stems = ["".join(rng.choices("ACGT", k=12)) for _ in range(25)]
    rows = []
    for i in range(900):
        tag = list(rng.choice(stems))
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            j = rng.randrange(len(tag))
            tag[j : j + 1] = rng.choice([["A"], ["C"], [], ["G", "T"]])
        trans = rng.choice([[], ["T1"], ["T1", "T2"], ["T2", "T3"], ["T4"]])
        rows.append((f"cell{0 if i % 3 == 0 else i % 11}", "".join(tag)[: rng.choice([12, 12, 11])], f"q{i}", trans, rng.random() < 0.5, f"{i:06d}"))
    reads = spark.createDataFrame(rows, "bc string, umi string, qname string, trans array<string>, is_perfect boolean, pos string")
    parts = molecules.parts_of(reads, ["bc"], "umi", "trans", most, 30)
    assert parts.where("bc = 'cell0'").select("_part").distinct().count() > (3 if most == 1 else 1)
    found = sorted((r.bc, r.umi, tuple(r.trans), tuple(r.reads)) for r in molecules.molecules(reads, ["bc"], most=most, split=30).collect())
    want = []
    for bc in {r[0] for r in rows}:
        tags = {}
        for _, u, q, t, p, _ in (r for r in rows if r[0] == bc):
            tags.setdefault(u, []).append((q, frozenset(t), p))
        want += [(bc, u, tuple(t), tuple(q)) for u, t, q in plain_cluster(list(tags.items()), most)]
    assert found == sorted(want)
    assert found == sorted((r.bc, r.umi, tuple(r.trans), tuple(r.reads)) for r in molecules.molecules(reads.repartition(7), ["bc"], most=most).collect())
    assert molecules.molecules(reads.limit(0), ["bc"]).collect() == []


def test_candidates_are_merged_in_rank_order(spark, sf_dir):
    """The whole query against one barcode after the other, as the rule is stated."""
    from cellweave.functions.sequences import search
    from cellweave.plans import bindings, catalog

    rows = bindings.reads(spark, sf_dir).select(F.expr(bindings.sequence("bc % 700", 5)).alias("bc"), "line", (F.col("chrom") % 20).alias("chrom"), "start", "stop").collect()
    tags = {}
    for r in rows:
        tags.setdefault(r.bc, set()).add((r.line, r.chrom, r.start, r.stop))
    found = {r.bc: r for r in catalog.QUERIES["candidate_merge"](spark, sf_dir).collect()}
    assert set(found) == set(tags)
    refs, knee = [], 60
    for bc in sorted(found, key=lambda b: found[b].rank):
        i, root = found[bc].rank - 1, bc
        if i >= knee // 2:
            close = {ref: search(bc, ref, 1)[0] for ref in refs}
            least = min((d for d in close.values() if d >= 0), default=-1)
            hits = [ref for ref, d in close.items() if d == least >= 0 and any(u == v and c == e and a <= z and x <= b for u, c, a, b in tags[bc] for v, e, x, z in tags[ref])]
            root = hits[0] if len(hits) == 1 else bc
        if root == bc and (i < knee // 2 or i < int(knee * 1.5)):
            refs.append(bc)
        assert (found[bc].root, found[bc].is_ref) == (root, bc in refs)
    assert sum(r.root != b for b, r in found.items()) > 5


def test_sketches_add_up(spark, sf_dir):
    from cellweave.plans import catalog

    exact = {r.bc: r.umi_count for r in catalog.QUERIES["bc_umi_rank"](spark, sf_dir).collect()}
    found = {r.bc: r.umi_count for r in catalog.QUERIES["umi_sketch_counts"](spark, sf_dir).collect()}
    assert set(found) == set(exact) and all(abs(found[b] - n) <= max(1, 0.03 * n) for b, n in exact.items())
    many = spark.range(60_000).selectExpr("'a' as bc", "id as umi")
    both = barcodes.umi_sketches(many.where("umi < 40000")).unionByName(barcodes.umi_sketches(many.where("umi >= 20000")))
    assert abs(barcodes.merged_counts(both).first().umi_count - 60_000) < 0.03 * 60_000


def test_components(spark):
    from cellweave.operators import partitioning

    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(80)] + [(7, 7)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    found = {r.node: r.root for r in partitioning.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: find(x) for x in root}


def test_genes_of_equal_molecules(spark):
    genes = spark.createDataFrame([("T1", "G1"), ("T2", "G1"), ("T3", "G3")], "trans string, gene string")
    rows = spark.createDataFrame([("A", ["T3", "T1", "T2"]), ("A", ["T3", "T1", "T2"]), ("B", ["T9"]), ("C", []), ("D", None)], "bc string, trans array<string>")
    found = sorted((r.bc, r.genes) for r in molecules.bc_umi_table(rows, genes).where("bc < 'D'").collect())
    assert found == [("A", ["G3", "G1"])] * 2 + [("B", ["NA"]), ("C", ["NA"])] and molecules.bc_umi_table(rows, genes).count() == 5
    spans = spark.createDataFrame([("T1", "1", 10, 20), ("T9", "2", 10, 20)], "trans string, chrom string, start int, stop int")
    assert sorted(r.bc for r in molecules.in_region(rows, spans, "1", 15, 30).collect()) == ["A", "A"]


def test_hull_of_wanted_genes(spark):
    rows = spark.createDataFrame([("A", "1", 5, 9, "+", 1), ("A", "2", 1, 7, "-", 2), ("B", "1", 1, 2, "+", 3)], "gene string, chrom string, start int, stop int, strand string, line int")
    assert [tuple(r) for r in variants.gene_hull(rows, wanted=rows.where("gene = 'A'"), more=["strand"], last="line").collect()] == [("A", "2", 1, 9, "-")]
    assert [r.parent for r in variants.diseases(spark.createDataFrame([("Cancer",), ("Body measurement",)], "parent string")).collect()] == ["Cancer"]
