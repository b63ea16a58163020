"""Each stage of the pipeline, on what the one before it kept, against a plain version."""

import collections

import duckdb
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from cellweave.llm import quality, tokens
from cellweave.llm.shared import stored

from . import brute


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(stored(stage(spark, found[-1], sf_dir), "stage"))
    return [(t.columns, t.collect()) for t in found]


def texts(rows):
    return {r.doc_id: r.text for r in rows}


def test_columns_stay(tables):
    assert all(columns == tables[0][0] for columns, _ in tables[1:5])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near copies", "repeated passages", "source mix", "packing"]


def test_quality_stage(tables, duck):
    kept = duck.sql(f"SELECT doc_id FROM ({quality.sql()}) WHERE kept").fetchall()
    assert sorted(r.doc_id for r in tables[1][1]) == sorted(d for d, in kept)
    good = duckdb.sql("SELECT doc_id FROM '/root/testdata/sf0.001/labels.parquet' WHERE quality = 1").fetchall()
    base = {r.doc_id: brute.quality_base(r.text)[-1] for r in tables[0][1]}
    assert all(d in texts(tables[1][1]) for d, in good if not base[d])


def test_near_copies_stage(tables):
    before, after = texts(tables[1][1]), texts(tables[2][1])
    sets = {d: set(brute.shingles(t, 5)) for d, t in before.items()}
    alike = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b}
    assert not [p for p, s in alike.items() if s >= 0.8 and p[0] in after and p[1] in after]
    for d in set(before) - set(after):
        assert max(s for p, s in alike.items() if d in p) >= 0.6
    groups = brute.components(before, lambda a, b: alike[min(a, b), max(a, b)] >= 0.6)
    assert {groups[d] for d in after} == set(groups.values())  # no group is lost


def test_near_copies_are_removed_at_the_similarity_alone(tables):
    before, after = texts(tables[1][1]), texts(tables[2][1])
    sets = {d: set(brute.shingles(t, 5)) for d, t in before.items()}
    groups = brute.components(before, lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    assert set(after) == set(groups.values())


def test_near_copies_keep_null_and_repeated_ids(spark, sf_dir):
    say = lambda k, *more: " ".join([*(f"w{k}x{i}" for i in range(40)), *more])
    rows = [(None, say(1)), (None, say(1, "more")), (None, say(2)), (4, say(3)), (4, say(4)), (4, say(4)), (2, say(4, "more")), (None, say(5)), (6, say(5, "more")), (8, say(6))]
    docs = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, row long")
    kept = corpus_pipeline.near_copies(spark, docs, sf_dir)
    found = sorted(kept.collect(), key=lambda r: r.row)
    assert kept.columns == docs.columns and all((r.doc_id, r.text) == rows[r.row] for r in found)
    assert [r.row for r in found][1:] == [2, 3, 6, 8, 9] and found[0].row in (0, 1)


def test_repeated_passages_stage(tables):
    before, after = texts(tables[2][1]), tables[3][1]
    data = {d: t.encode() for d, t in before.items()}
    count = collections.Counter(b[i : i + 200] for b in data.values() for i in range(len(b) - 199))
    for r in after:
        b = data[r.doc_id]
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if count[b[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        assert r.text == bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore") and r.n_chars == len(r.text)
    assert len(after) == len(before)


def test_source_mix_stage(tables):
    before, after = tables[3][1], tables[4][1]
    copies = collections.Counter(r.doc_id for r in after)
    assert max(copies.values()) <= 3 and set(copies) <= set(texts(before))
    n = {r.doc_id: len(brute.WORD.findall(r.text)) for r in before}
    source = {r.doc_id: r.source for r in before}
    size, taken, most = collections.Counter(), collections.Counter(), collections.Counter()
    for d, s in source.items():
        size[s] += n[d]
        taken[s] += n[d] * copies[d]
        most[s] = max(most[s], n[d])
    weight = {s: 1 + i % 3 for i, s in enumerate(sorted(size))}
    total, fixed = sum(size.values()), {}
    while True:
        rest = [s for s in size if s not in fixed]
        share = {s: (total - sum(fixed.values())) * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * size[s]]
        if not over:
            break
        fixed |= {s: 3 * size[s] for s in over}
    assert all(abs(taken[s] - t) <= 1.5 * most[s] for s, t in (fixed | share).items())


def test_packing_stage(tables):
    tokenizer = Tokenizer.from_file(tokens.vocabulary_path())
    want = collections.Counter()
    for r in tables[4][1]:
        ids = tokenizer.encode(r.text, add_special_tokens=False).ids
        want[r.doc_id, len(ids) + 1] += len(ids) + 1
    got = collections.Counter()
    placed = []
    for r in tables[5][1]:
        got[r.doc_id, r.doc_tokens] += r.length
        placed.append((r.sequence_id * 2048 + r.offset, r.length))
    assert got == want
    placed.sort()
    assert placed[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(placed, placed[1:]))


def test_stages_on_odd_rows(spark, sf_dir):
    """Nulls in any column, empty texts, repeated rows, and columns with the names that stages use themselves."""
    good = [" ".join("the" if i % 3 == 0 else f"w{chr(97 + k)}{chr(97 + i % 26)}{'abc' * (i % 2 + 1)}"[: 4 + i % 5] + chr(97 + i // 26) for i in range(60)) + "." for k in range(6)]
    rows = [(1, good[0], None, "a"), (2, good[1], "s", None), (2, good[1], "s", None), (None, good[2], "s", "b"), (4, None, "s", "b"), (5, "", None, None), (6, " \n", "t", "c"), (7, good[3] * 2, "t", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    docs = docs.withColumns({c: docs.lang for c in ("pattern", "size", "copies", "row", "_parts", "n_words", "kept", "key", "_salt")}).withColumn("n_chars", docs.doc_id)
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, sf_dir)
        empty = stage(spark, docs.limit(0), sf_dir)
        assert empty.count() == 0 and empty.columns == found.columns, name
        if name != "packing":
            assert found.columns == docs.columns, name
        kept = collections.Counter((r.doc_id, r.text) for r in found.collect()) if name != "packing" else None
        if name == "quality rules":
            assert kept == collections.Counter({(1, good[0]): 1, (2, good[1]): 2, (None, good[2]): 1})
        elif name == "near copies":
            assert kept == collections.Counter([(1, good[0]), (2, good[1]), (None, good[2]), (4, None), (7, good[3] * 2)])
        elif name == "repeated passages":
            assert sum(kept.values()) == 8 and kept[(None, good[2])] == 1 and kept[(1, good[0])] == 1 and kept[(2, "")] == 2
        elif name == "source mix":
            assert all(n <= 6 for n in kept.values()) and (1, good[0]) in kept
        else:
            assert found.where("doc_id is null").count() == 1 and found.count() >= len(rows)
