import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellweave.functions import sequences, stats


def quadratic(query, target):
    row = [0] * (len(target) + 1)
    for i, a in enumerate(query, 1):
        new = [i]
        for j, b in enumerate(target, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row), row.index(min(row))


@settings(max_examples=300, deadline=None)
@given(st.text("ACGT", min_size=1, max_size=24), st.text("ACGTN", max_size=60), st.integers(0, 8))
def test_search_agrees_with_a_quadratic_table(query, target, most):
    distance, end = quadratic(query, target)
    assert sequences.search(query, target, most) == ((distance, end) if distance <= most else (-1, -1))


def test_native_infix_distance(spark):
    pairs = [("ACGTAC", "TTACGTACTT"), ("ACGTAC", "TTACGACTT"), ("ACGTAC", ""), ("AC", "GG"), ("ACGTAC", "GGGGGGGG")]
    rows = spark.createDataFrame(pairs, "q string, t string").withColumn("d", sequences.infix_distance("q", "t", 2)).collect()
    assert [r.d for r in rows] == [d if (d := quadratic(*p)[0]) <= 2 else None for p in pairs]


def test_revcomp(spark):
    assert spark.createDataFrame([("ACGTNacgtuUx",)], ["s"]).select(sequences.revcomp("s")).first()[0] == "NAAACGTNACGT"


def test_perfect_tag(spark):
    bc, umi = "ATCACGACACTTTAGG", "ATCACATCCATG"
    head = sequences.ADAPTER + bc + umi
    rows = spark.createDataFrame([("AA" + head + "T" * 15,), (head + "GTTTTTTTTTTTT",), (head[:40],), ("ACGT",)], ["s"]).select(*sequences.perfect_tag("s")).collect()
    assert tuple(rows[0]) == (bc, umi, bc + umi + "TTTTT", True)
    assert (rows[1].bc, rows[1].umi, rows[1].is_perfect) == (bc, umi, False)
    assert tuple(rows[2]) == tuple(rows[3]) == ("", "", "", False)


def test_tags_find_a_broken_adapter(spark):
    bc, umi = "ATCACGACACTTTAGG", "ATCACATCCATG"
    broken = sequences.ADAPTER.replace("GACGCTC", "GACGTC")
    rows = spark.createDataFrame([(1, "GG" + broken + bc + umi + "T" * 12), (2, None), (3, "A" * 60)], "id int, seq string")
    found = {r.id: (r.bc, r.umi, r.is_perfect) for r in sequences.tags(rows).collect()}
    assert found == {1: (bc, umi, False), 2: ("", "", False), 3: ("", "", False)}


def test_tests_of_independence(spark):
    assert stats.chi2_tail(32.47764, 1) == pytest.approx(1.2057e-08, rel=1e-4)
    assert stats.fisher_two_sided(58, 9, 24, 41) == pytest.approx(3.588e-09, rel=1e-3)
    assert stats.fisher_two_sided(61, 180, 322, 19) == pytest.approx(8.2524e-73, rel=1e-4)
    assert stats.binomial_tail(15, 20) == pytest.approx(21700 / 2**20)
    assert stats.chi2_tail(4.0, 2) == pytest.approx(math.exp(-2))
    assert math.isnan(stats.chi2_tail(math.nan, 1))
    table = spark.createDataFrame([("g", "a", 58.9, 9.0), ("g", "b", 24.0, 41.2)], "g string, t string, x double, y double")
    assert stats.chi2(table, ["g"], "t", "x", "y").first().statistic == pytest.approx(32.47764, abs=1e-4)
    empty = spark.createDataFrame([("g", "a", 3.0, 0.0), ("g", "b", 2.0, 0.0)], "g string, t string, x double, y double")
    assert math.isnan(stats.chi2(empty, ["g"], "t", "x", "y").first().statistic)


@settings(max_examples=100, deadline=None)
@given(st.floats(0.001, 800), st.integers(1, 300))
def test_chi2_tail_falls_by_the_density(statistic, df):
    """The tail loses the density times a short way, and nothing overflows."""
    way = 1e-4 * statistic
    middle = math.exp((df / 2 - 1) * math.log(statistic / 2) - statistic / 2 - math.lgamma(df / 2)) / 2
    low, high = stats.chi2_tails(np.array([statistic - way, statistic + way]), df)
    assert 0 <= high <= low + 1e-12 <= 1 + 1e-12 and low - high == pytest.approx(2 * way * middle, rel=1e-3, abs=1e-11)
    assert stats.chi2_tail(1e6, df) == 0


def test_p_values_of_batches(spark):
    rows = spark.createDataFrame([(1, 58.9, 9.0, 24.0, 41.2), (2, 58.0, 9.0, 24.0, 41.0), (3, None, 9.0, 24.0, 41.0), (4, 3.0, 3.0, 3.0, 3.0)], "i int, a double, b double, c double, d double")
    found = {r.i: r for r in rows.select("i", stats.fisher_p("a", "b", "c", "d").alias("f"), stats.binomial_p("a", F.col("a") + F.col("b")).alias("b"), stats.chi2_p("a", F.col("i")).alias("c")).collect()}
    assert found[1].f == found[2].f == pytest.approx(3.588e-09, rel=1e-3) and found[4].f == pytest.approx(1)
    assert found[3].f is found[3].b is found[3].c is None
    assert found[2].b == pytest.approx(stats.binomial_tail(58, 67)) and found[2].c == pytest.approx(math.exp(-29))


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 100_000))
def test_ln_factorial(k):
    assert float(stats.ln_factorial(np.array(k))) == pytest.approx(math.lgamma(k + 1), rel=1e-12, abs=1e-12)


def test_bh_leaves_nan_out(spark):
    rows = spark.createDataFrame([(i, p) for i, p in enumerate([0.01, 0.04, 0.03, math.nan])], "i int, p double")
    found = [r.fdr for r in stats.bh(rows, "p", [], ["i"]).orderBy("i").collect()]
    assert found[:3] == pytest.approx([0.03, 0.04, 0.04]) and math.isnan(found[3])


def test_bh_over_one_scope_by_ranges(spark):
    """Against sorting all at once: ties, ones, nulls, many parts; no window takes all rows."""
    rng = random.Random(5)
    values = [rng.choice([rng.random() ** 3, 1.0, 0.25, 0.0]) for _ in range(1500)]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate([*values, None, math.nan])], "i int, p double")
    ranks = sorted(range(1500), key=values.__getitem__)
    want, least = {1500: None, 1501: None}, 1.0
    for rank in range(1500, 0, -1):
        i = ranks[rank - 1]
        least = min(least, values[i] * 1500 / rank)
        want[i] = least
    made = stats.bh(rows.repartition(7), "p", [], ["i"])
    found = {r.i: None if math.isnan(r.fdr) else r.fdr for r in made.collect()}
    assert found == want
    assert stats.bh(rows.limit(0), "p", [], ["i"]).collect() == []


def test_strand_and_candidate_bases(spark):
    rows = spark.createDataFrame(
        [("a", "T" * 20 + "ACGTACGT" * 5, "20S40M", 0, None), ("b", "ACGTACGT" * 5 + "A" * 20, "40M20S", 0, None), ("c", "ACGT" * 10, "40M", 0, None), ("d", "ACGT" * 10, "40M", 16, "+")],
        "id string, seq string, cigar string, flag int, ts string",
    ).withColumn("reverse", sequences.is_reverse())
    found = {r.id: (r.reverse, r.bases) for r in rows.withColumn("bases", sequences.candidate()).collect()}
    assert found["a"] == (True, "T" * 20 + "ACGTACGT" * 5)
    assert found["b"][0] is False and found["b"][1].startswith("T" * 20)
    assert found["c"] == (None, "") and found["d"][0] is True


def test_read_class(spark):
    rows = [("Proper", 1, 1, None, None, False, False), ("RT-RT", 2, None, 2, None, False, False), ("RT", 1, None, 2, None, True, False), ("RT-RT", 1, None, 2, None, False, True), ("TSO-TSO", None, 1, None, 1, False, False), ("TSO", None, None, None, 1, False, False), ("No-RT-TSO", None, None, None, None, True, True)]
    table = spark.createDataFrame(rows, "want string, a int, b int, c int, d int, e boolean, f boolean")
    assert all(r.want == r.got for r in table.withColumn("got", sequences.read_class("a", "b", "c", "d", "e", "f")).collect())
    assert table.select(F.col("want")).count() == len(rows)
