"""The registered queries at sf0.001: against SQL where there is some, else against plain versions."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from cellweave.llm import queries, tokens

from ..compare import rows_of, rows_of_sql
from . import brute


@pytest.fixture(scope="module")
def docs(sf_dir):
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, duck, sf_dir, name):
    assert rows_of(queries.QUERIES[name](spark, sf_dir)) == rows_of_sql(duck, queries.ORACLE_SQL[name])


@pytest.mark.parametrize("name, plain", [("op1_suffix_dedup", brute.suffix_dedup), ("op4_simhash", brute.simhash), ("op5_substring_dedup", brute.substring_dedup)])
def test_query_matches_brute_force(spark, sf_dir, docs, name, plain):
    found = {r[0]: tuple(r[1:]) for r in queries.QUERIES[name](spark, sf_dir).collect()}
    assert found == plain(docs)


@pytest.fixture(scope="module")
def ids(docs):
    tokenizer = Tokenizer.from_file(tokens.vocabulary_path())
    return {d: tokenizer.encode(t or "", add_special_tokens=False).ids for d, t in docs}


def test_token_files(spark, sf_dir, ids):
    at, want = 0, {}
    for d in sorted(ids):
        mine = np.array([*ids[d], 0], "<u4")
        want[d] = (at, len(mine), zlib.crc32(mine.tobytes()))
        at += len(mine)
    assert {r[0]: tuple(r[1:]) for r in queries.op3_token_files(spark, sf_dir).collect()} == want


def test_packing(spark, sf_dir, ids):
    rows = sorted(map(tuple, queries.op8_packing(spark, sf_dir).collect()))
    starts = {r[0]: r[5] * 2048 + r[6] for r in rows if r[1] == 0}
    assert rows == sorted(brute.packed([(d, [*ids[d], 1], starts[d]) for d in ids]))
    placed = sorted((r[5], r[6], r[2]) for r in rows)
    assert all(b[1] == (0 if b[0] > a[0] else a[1] + a[2]) for a, b in zip(placed, placed[1:])) and placed[0][:2] == (0, 0)


def test_media(spark, sf_dir, docs):
    found = {r.doc_id: r for r in queries.op2_media_columns(spark, sf_dir).collect()}
    for d, t in docs:
        raw = (t or "").encode()
        padded = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        r = found[d]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))


def test_mix_comes_near_its_targets(spark, sf_dir):
    by = {}
    for r in queries.op6_mixing(spark, sf_dir).collect():
        assert r.taken <= 3 * r.size
        target, taken, most = by.get((r.source_size, r.target), (r.target, 0, 0))
        by[r.source_size, r.target] = (r.target, taken + r.taken, max(most, r.size))
    assert all(abs(taken - target) <= 1.5 * most for target, taken, most in by.values())


def test_quality_against_labels(spark):
    kept = {r.doc_id: (r.kept, r.base_failed) for r in queries.op9_quality(spark, "/root/testdata/sf0.01").collect()}
    labels = duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall()
    good = [kept[d][0] for d, q in labels if q == 1 and not kept[d][1]]
    bad = [kept[d][0] for d, q in labels if q == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.05
