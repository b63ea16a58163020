"""Languages, phrases and divergent sources on texts that are null, empty, long, repeated or strange."""

import collections
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cellweave.llm import divergence, language, phrases, queries, words

from . import brute

KINDS = "doc_id long, text string, lang string, source string, n long, rank string, score string"
ODD = [None, "", " ", "\n\t.", "a", "é" * 3, "A b  c\r\nd", "x" * 3000, "ab " * 900, "ß z", "\U0001f600 smile", "don't. Stop, now", "end\x00mark", "12 34", "½ ²"]


def documents(spark, seed=0, n=120, extra=()):
    """Texts of a small vocabulary in three languages, null ones among them, repeated rows, and columns that results have too."""
    rng = random.Random(seed)
    made = []
    for i in range(n):
        lang = rng.choice(["aa", "bb", "bb", None])
        own = [f"{lang or 'zz'}{c}" for c in "abcdefgh"] + ["the", "of", "New", "york", "éa"]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", ". ", "\n", ","]) for w in rng.choices(own, k=rng.randrange(0, 60)))
        made.append((i, text + (" New york city " * rng.randrange(3)), lang, rng.choice(["s1", "s2", "s3", None, ""])))
    made += [(1000 + i, t, "aa" if i % 2 else None, "odd") for i, t in enumerate([*ODD, *extra])]
    made += [made[3], made[4], (None, "null id", "aa", "s1")]
    return spark.createDataFrame([(*r, 1, "p", "q") for r in made], KINDS)


@settings(max_examples=80, deadline=None)
@given(st.text(st.sampled_from("ab .\té"), max_size=120), st.integers(0, 3), st.integers(4, 20))
def test_steps_show_each_phrase_once(text, overlap, step):
    column = pa.array([text])
    whole, parts = collections.Counter(), collections.Counter()
    for found, size in ((whole, 10**6), (parts, step)):
        for data, offsets, shown in words.texts_in_steps(column, phrases.ENDS, phrases.BLANKS, overlap, size):
            held = words.Words(data, offsets, phrases.ENDS | phrases.BLANKS)
            names, piece = [held.names[c].as_py() for c in held.codes.tolist()], np.cumsum(phrases.ENDS[data])[held.start]
            for m in range(1, overlap + 2):
                for i in range(max(0, shown - m + 1), len(names) - m + 1):
                    if piece[i] == piece[i + m - 1]:
                        found[tuple(names[i : i + m])] += 1
    assert whole == parts


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 6), min_size=1, max_size=4), max_size=200), st.integers(1, 8), st.integers(0, 40))
def test_trie_counts_across_bursts_and_spills(paths, burst, down_to):
    trie, found = phrases.HatTrie(burst), collections.Counter()
    assert trie.ids_of("x", [b"w%d" % i for i in range(1, 7)], list(range(1, 7))) == list(range(1, 7))
    pack = lambda path: sum(w << phrases.ID_BITS * i for i, w in enumerate(path))
    runs = []
    for i, path in enumerate(paths):
        trie.add([path[0] >> phrases.BLOCK_BITS], [pack(path)], [1])
        if i % 50 == 49:
            runs += trie.spill(down_to)
    assert trie.size <= max(down_to, 0) + 50
    runs += trie.spill(0)
    for run in runs:
        for part, lang, phrase, n in zip(*(c.to_pylist() for c in run.columns)):
            found[phrase] += n
    assert found == collections.Counter(" ".join(f"w{w}" for w in p) for p in paths) and trie.size == 0


def test_filters_stop_no_key(spark):
    rng = random.Random(1)
    keys = [(rng.randrange(-(2**63), 2**63),) for _ in range(500)]
    made = words.filter_of(spark.createDataFrame(keys, "h long"), len(keys))
    held = np.array(keys, np.int64).ravel().view(np.uint64)
    assert made.passes(held).all() and made.passes(words.rolling.mix(held + np.uint64(1))).mean() < 0.1


@pytest.mark.parametrize("longest, most", [(3, phrases.MOST_ENTRIES), (4, 40), (2, 40)])
def test_phrases_against_brute_force(spark, monkeypatch, longest, most):
    monkeypatch.setattr(phrases, "BURST", 3)
    docs = documents(spark)
    found = sorted(tuple(r) for r in phrases.collocations(docs.repartition(5), longest=longest, most=most).collect())
    want = brute.phrases([(r.lang, r.text) for r in docs.collect()], longest)
    assert found == want and len(want) > 20


def test_first_phrases_only_and_large_counts(spark):
    docs = documents(spark)
    found = sorted(tuple(r) for r in phrases.collocations(docs, top=3).collect())
    assert found == brute.phrases([(r.lang, r.text) for r in docs.collect()], top=3)
    exact = spark.sql("SELECT (1000000BD * cast(a as decimal(18,0)) * cast(a as decimal(18,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0))) AS s FROM VALUES (9000000000000000L, 9000000000000001L, 9000000000000007L) AS t(a, l, r)")
    assert exact.first().s == 1000000 * 9000000000000000**2 // (9000000000000001 * 9000000000000007)


@pytest.mark.parametrize("block, cells", [(divergence.BLOCK, divergence.CELLS), (2, 7)])
def test_divergence_against_brute_force(spark, monkeypatch, block, cells):
    monkeypatch.setattr(divergence, "BLOCK", block)  # more sources than one block holds
    monkeypatch.setattr(divergence, "CELLS", cells)
    docs = documents(spark, 2)
    rows = [(r.lang, r.source, r.text) for r in docs.collect()]
    for least, top in ((3, 200), (30, 4), (10**6, 200)):
        assert sorted(tuple(r) for r in divergence.audit(docs.repartition(3), least, top).collect()) == brute.divergence(rows, least, top)


def test_prefixes_are_dropped_level_by_level(spark):
    texts = ["prefixes prefixed lone", "prefixes other prefixed", "prefixes prefixing others", "prefixed oth"]
    docs = spark.createDataFrame([("aa", "s", t) for t in texts], "lang string, source string, text string")
    levels = []
    kept = {bytes(r.term): r.n for r in divergence.kept_terms(docs, 3, 2, levels).collect()}
    assert kept == {b"prefixes": 3, b"prefixed": 3} and levels == [2, 1, 0]  # pr, ot; pref; none is open


def test_terms_of_megabytes(spark):
    long = "Wort " * 500_000 + "ä" * 300_000 + " ende. new york " + "Wort " * 10
    docs = documents(spark, 3, 40, [long, long, long])
    rows = [(r.lang, r.source, r.text) for r in docs.collect()]
    assert sorted(tuple(r) for r in divergence.audit(docs).collect()) == brute.divergence(rows)
    assert sorted(tuple(r) for r in phrases.collocations(docs).collect()) == brute.phrases([(r[0], r[2]) for r in rows])


def plain_prediction(model, text):
    """The sums of one text, word by word."""
    total, n = np.zeros(len(model.langs), np.int64), 0
    for run in words_of(text):
        for w in language.words_in(run.encode()):
            total += model.scores[model.entries(w)].sum(axis=0) if model.entries(w) else 0
            n += 1
    return model.langs[int(total.argmax())] if n and model.langs else "und"


def words_of(text):
    cut = "".join(c if ord(c) > 127 or c.isalpha() else " " for c in text or "")
    return cut.split()


def test_languages_of_odd_rows(spark):
    docs = documents(spark, 4, 150, ["the of " * 400_000])
    rest = lambda d: None if d is None else zlib.crc32(str(d).encode()) % 5
    rows = docs.collect()
    found = language.identify(docs).collect()
    key = lambda d: (d is None, d)
    assert sorted((key(r.doc_id), r.held_out) for r in found) == sorted((key(r.doc_id), None if r.doc_id is None else rest(r.doc_id) == 0) for r in rows)
    F = language.F
    labelled = docs.where("crc32(cast(doc_id as string)) % 5 <> 0").select(F.xxhash64("doc_id").alias("key"), "lang", "text")
    model = language.fit(labelled)
    want = collections.Counter((r.doc_id, plain_prediction(model, r.text)) for r in rows)
    assert collections.Counter((r.doc_id, r.lang_pred) for r in found) == want
    assert all(0 <= r.score <= 1 and (r.score == 0) == (r.lang_pred == "und") for r in found)
    assert {r.lang_pred for r in found if r.doc_id in (1000, 1001, 1002, 1003, 1013)} == {"und"}


def test_words_back_off_to_shorter_grams(spark):
    rows = [(i, lang, text) for i, (lang, text) in enumerate([("aa", "haus maus laus haus maus"), ("bb", "mous house louse house mous")] * 4)]
    model = language.fit(spark.createDataFrame(rows, "key long, lang string, text string"))
    assert model.entries("haus") == [model.words["haus"]] and "klaus" not in model.words
    grams = {i: g for g, i in model.grams.items()}
    assert [grams[i] for i in model.entries("klaus")] == ["laus$", "aus$", "us$", "s$"]  # ^ and k are in no gram
    assert model.entries("ж") == []
    scored = language.predict(spark.createDataFrame([("klaus",), ("blouse",), ("ж",), ("1",)], "text string"), model).collect()
    assert [r.lang_pred for r in scored] == ["aa", "bb", "aa", "und"] and scored[2].score == 0.5


def test_no_label_gives_no_language(spark):
    docs = documents(spark).withColumn("lang", language.F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in language.identify(docs).collect()} == {("und", 0.0)}
    for made in (language.identify, phrases.collocations, divergence.audit):
        assert made(docs.limit(0)).collect() == []
        with pytest.raises(ValueError, match="missing columns"):
            made(docs.drop("text"))


def test_held_out_accuracy(spark):
    found = queries.op11_language_id(spark, "/root/testdata/sf0.01").collect()
    langs = dict(duckdb.sql("SELECT doc_id, lang FROM '/root/testdata/sf0.01/documents.parquet'").fetchall())
    right = [langs[r.doc_id] == r.lang_pred for r in found if r.held_out and langs[r.doc_id] is not None]
    assert len(right) > 150 and np.mean(right) > 0.985
