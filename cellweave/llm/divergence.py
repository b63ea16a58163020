"""Source divergence audit over the terms that enough documents of a language hold.

The kept terms come by iceberg refinement of byte prefixes: a level counts, for each language, the documents that hold
a term with each prefix of so many bytes; prefixes in fewer documents than the threshold go, the others
are twice as long at the next level, and terms no longer than a level are whole there. Each level reads the texts anew and
sends counts only for terms whose prefix is left, by a filter of bounded size that stops none of them.
The terms that are left are then counted by language and source, and groups are held against one another in whole
numbers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import give_back, need, slices, stored
from .words import STEP_BYTES, Filter, Words, filter_of, hashes, table_of, texts_in_steps

#: Bytes that are in no term; bytes of the first level's prefixes; sources whose pairs a task holds at once.
GAPS = table_of((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
FIRST, BLOCK = 8, 256
#: Cells of a comparison that numpy holds at a time, and blocks of sums that a task holds.
CELLS, MOST_BLOCKS = 1 << 18, 64
#: What a share of one is in whole numbers.
ONE = 1_000_000_000


def seed_of(lang: str) -> int:
    return int(hashes([lang.encode()])[0])


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, pa.Array]]:
    """(language, its rows, their texts) of a batch (lang, source, text)."""
    langs = np.array(batch.column(0).to_pylist(), object)
    for lang in dict.fromkeys(langs):
        mine = langs == lang
        yield lang, np.flatnonzero(mine), batch.column(2).filter(pa.array(mine))


def level_counts(docs: DataFrame, before: int, level: int, passing: Filter) -> DataFrame:
    """lang, prefix, whole, n: documents (lang, source, text) with a term of that prefix of ``level`` bytes.

    Terms of up to ``before`` bytes were whole earlier and are left out, as are those whose prefix of that size does not pass.
    """

    def held_in(lang: str, words: Words) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """(prefix number of each distinct term or -1, the prefixes, whether they are whole)."""
        sizes = pc.binary_length(words.names).to_numpy()
        open_ = np.flatnonzero(sizes > before)
        names = words.names.take(pa.array(open_))
        if before:
            ok = passing.passes(hashes([x[:before] for x in names.to_pylist()], seed_of(lang)))
            open_, names = open_[ok], names.filter(pa.array(ok))
        heads = pc.binary_slice(names.cast(pa.binary()), 0, level).dictionary_encode()
        whole = sizes[open_] <= level
        both, at = np.unique(heads.indices.to_numpy().astype(np.int64) * 2 + whole, return_inverse=True)
        number = np.full(len(words.names), -1)
        number[open_] = at
        return number, heads.dictionary.take(pa.array(both // 2)), both % 2 == 1

    def rows(lang: str, prefixes: pa.Array, whole: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array([lang] * len(n), pa.string()), prefixes, pa.array(whole), pa.array(n.astype(np.int64))], ["lang", "prefix", "whole", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, 2 * STEP_BYTES):
            for lang, _, texts in by_language(batch):
                seen: set[tuple[bytes, bool]] = set()
                steps = 0
                for data, offsets, _ in texts_in_steps(texts, GAPS, GAPS):
                    words = Words(data, offsets, GAPS)
                    if not len(words.codes):
                        continue
                    number, prefixes, whole = held_in(lang, words)
                    n = len(prefixes)
                    at = number[words.codes]
                    pairs = np.unique(words.text[at >= 0] * max(n, 1) + at[at >= 0])
                    steps += 1
                    if len(texts) > 1:
                        yield rows(lang, prefixes, whole, np.bincount(pairs % max(n, 1), minlength=n)[:n])
                    else:  # one text that may come in steps counts once
                        seen.update(zip(prefixes.to_pylist(), whole.tolist()))
                if seen:
                    yield rows(lang, pa.array([x for x, _ in seen], pa.binary()), np.array([w for _, w in seen]), np.ones(len(seen)))
        give_back()

    made = docs.select("lang", "source", "text").mapInArrow(run, "lang string, prefix binary, whole boolean, n long")
    return made.groupBy("lang", "prefix", "whole").agg(F.sum("n").alias("n"))


def kept_terms(docs: DataFrame, least: int = 3, first: int = FIRST, levels: list[int] | None = None) -> DataFrame:
    """lang, term (binary), n: terms in ``least`` documents of the language at least. docs: lang, source, text without nulls in the first two.

    ``levels`` gets the number of prefixes left at each level.
    """
    found, before, level, passing = None, 0, first, Filter()
    while True:
        left = stored(level_counts(docs, before, level, passing).where(F.col("n") >= least), "prefixes")
        whole = left.where("whole").select("lang", F.col("prefix").alias("term"), "n")
        found = whole if found is None else found.unionByName(whole)
        open_ = left.where("not whole")
        n = open_.count()
        if levels is not None:
            levels.append(n)
        if not n:
            return found
        passing = filter_of(open_.select(F.xxhash64("lang", "prefix").alias("h")), n)
        before, level = level, 2 * level


def term_counts(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, term, n: occurrences of the kept terms (lang, term), above none."""
    passing = filter_of(kept.select(F.xxhash64("lang", "term").alias("h")), max(kept.count(), 1))
    sent = docs.sparkSession.sparkContext.broadcast(passing)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, 2 * STEP_BYTES):
            sources = batch.column(1).dictionary_encode()
            numbers = sources.indices.to_numpy().astype(np.int64)
            for lang, rows, texts in by_language(batch):
                for data, offsets, _ in texts_in_steps(texts, GAPS, GAPS):
                    words = Words(data, offsets, GAPS)
                    if not len(words.codes):
                        continue
                    ok = sent.value.passes(hashes(words.names.to_pylist(), seed_of(lang)))[words.codes]
                    n = len(words.names)
                    both, counts = np.unique(numbers[rows][words.text[ok]] * n + words.codes[ok], return_counts=True)
                    names = [pa.array([lang] * len(both), pa.string()), sources.dictionary.take(pa.array(both // n)), words.names.take(pa.array(both % n)).cast(pa.binary())]
                    yield pa.record_batch([*names, pa.array(counts.astype(np.int64))], ["lang", "source", "term", "n"])
        give_back()

    made = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term binary, n long")
    return made.groupBy("lang", "source", "term").agg(F.sum("n").alias("n")).join(kept.select("lang", "term"), ["lang", "term"], "left_semi")


def share(count: str, total: str) -> str:
    """SQL of 1 + floor(ONE * (count + 1) / total), in decimals, so that no product leaves its type."""
    return f"(1 + ({ONE}BD * cast({count} + 1 as decimal(19,0))) div cast({total} as decimal(19,0)))"


#: SQL of the divergence of p from q.
PART = "((p - q) * (p - q)) div q"


def pair_sums(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, g, h, f, terms: the divergence of source g from h over the terms that a source of either's block has, and how many these are.

    counts: lang, term, at (the source's number within its language), p; groups: lang, at, p (of a term that the source
    does not have). Each term's row meets the others of its block pair by a shuffle; sums are kept by block pair. Broadcast: one number for
    each group, of whose pairs the result holds a row each.
    """
    zero: dict[str, np.ndarray] = {}
    for r in groups.orderBy("lang", "at").groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "p"))).alias("all")).collect():
        zero[r["lang"]] = np.array([x["p"] for x in r["all"]], np.int64)
    if not zero:
        return counts.sparkSession.createDataFrame([], "lang string, g int, h int, f long, terms long")
    sent = counts.sparkSession.sparkContext.broadcast(zero)
    blocks = F.create_map(*(F.lit(x) for lang, p in zero.items() for x in (lang, -(-len(p) // BLOCK))))[F.col("lang")]
    block = F.floor(F.col("at") / BLOCK).cast("int")
    lists = counts.repartition("lang", "term").groupBy("lang", "term", block.alias("b")).agg(F.collect_list("at").alias("ats"), F.collect_list("p").alias("ps"))
    mine = F.struct("ats", "ps")
    none = F.lit(None).cast("struct<ats: array<int>, ps: array<bigint>>")
    make = lambda o: F.when(o == F.col("b"), F.array(F.struct(o.alias("gb"), o.alias("hb"), mine.alias("g"), mine.alias("h")))).otherwise(F.array(F.struct(F.col("b").alias("gb"), o.alias("hb"), mine.alias("g"), none.alias("h")), F.struct(o.alias("gb"), F.col("b").alias("hb"), none.alias("g"), mine.alias("h"))))
    sent_to = lists.withColumn("to", F.explode(F.flatten(F.transform(F.sequence(F.lit(0), blocks - 1), make))))
    met = sent_to.groupBy("lang", "term", "to.gb", "to.hb").agg(F.max("to.g").alias("g"), F.max("to.h").alias("h")).select("lang", "gb", "hb", "g.ats", "g.ps", F.col("h.ats").alias("hats"), F.col("h.ps").alias("hps"))

    def filled(default: np.ndarray, ats: pa.Array, ps: pa.Array, start: int) -> np.ndarray:
        out = np.repeat(default[None, :], len(ats), axis=0)
        owner = np.repeat(np.arange(len(ats)), pc.fill_null(pc.list_value_length(ats), 0).to_numpy())
        out[owner, ats.flatten().to_numpy() - start] = ps.flatten().to_numpy()
        return out

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int, int], list] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for (lang, gb, hb), (total, terms) in sums.items():
                g, h = (x.ravel() for x in np.indices(total.shape))
                yield pa.record_batch([pa.array([lang] * len(g), pa.string()), pa.array(g + gb * BLOCK, pa.int32()), pa.array(h + hb * BLOCK, pa.int32()), pa.array(total.ravel()), pa.array(np.full(len(g), terms))], ["lang", "g", "h", "f", "terms"])
            sums.clear()

        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            for key in dict.fromkeys(keys):
                lang, gb, hb = key
                rows = batch.filter(pa.array([k == key for k in keys]))
                zg, zh = (sent.value[lang][b * BLOCK : (b + 1) * BLOCK] for b in (gb, hb))
                if key not in sums:
                    if len(sums) >= MOST_BLOCKS:
                        yield from flushed()
                    sums[key] = [np.zeros((len(zg), len(zh)), np.int64), 0]
                step = max(1, CELLS // (len(zg) * len(zh)))
                for a in range(0, rows.num_rows, step):
                    part = rows.slice(a, step)
                    p = filled(zg, part.column(3), part.column(4), gb * BLOCK)[:, :, None]
                    q = filled(zh, part.column(5), part.column(6), hb * BLOCK)[:, None, :]
                    sums[key][0] += ((p - q) ** 2 // q).sum(axis=0)
                sums[key][1] += rows.num_rows
        yield from flushed()

    made = met.mapInArrow(run, "lang string, g int, h int, f long, terms long")
    return made.groupBy("lang", "g", "h").agg(F.sum("f").alias("f"), F.sum("terms").alias("terms"))


def audit(docs: DataFrame, least: int = 3, top: int = 200, lang: str = "lang", source: str = "source", text: str = "text", first: int = FIRST) -> DataFrame:
    """lang, source, part, item, value, rank of every (lang, source) group.

    Part ``pair``: the divergence from each other source of the language; part ``term``: the ``top`` terms that the
    group has more often than its language. Null texts, languages and sources are empty ones; repeated rows count each; a
    language without kept terms gives pairs of value 0; a long text counts whole, in steps; an empty table gives no rows; other
    columns are ignored.
    """
    need(docs, lang, source, text)
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    plain = docs.select(blank(lang).alias("lang"), blank(source).alias("source"), F.col(text).alias("text"))
    kept = stored(kept_terms(plain, least, first), "terms")
    counts = stored(term_counts(plain, kept), "counts")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    number = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("at")
    groups = plain.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"), number)
    groups = stored(groups.withColumn("all", F.sum("total").over(Window.partitionBy("lang"))).withColumn("p", F.when(F.col("v") > 0, F.expr(share("0", "total + v")))), "groups")
    by_term = counts.join(groups.select("lang", "source", "at", "total", "v", "all"), ["lang", "source"])
    by_term = stored(by_term.select("lang", "source", "at", "term", "n", F.expr(share("n", "total + v")).alias("p"), F.col("all").alias("whole"), "v"), "shares")

    pairs = groups.alias("a").join(groups.alias("b"), (F.col("a.lang") == F.col("b.lang")) & (F.col("a.at") != F.col("b.at")))
    pairs = pairs.select("a.lang", "a.source", F.col("b.source").alias("item"), F.col("a.at").alias("g"), F.col("b.at").alias("h"), F.col("a.p").alias("p"), F.col("b.p").alias("q"), "a.v")
    sums = pair_sums(by_term.select("lang", "term", "at", "p"), groups.where("v > 0").select("lang", "at", "p"))
    absent = F.coalesce("f", F.lit(0)) + (F.col("v") - F.coalesce("terms", F.lit(0))) * F.expr(PART)
    value = F.when(F.col("v") > 0, absent).otherwise(F.lit(0)).cast("long")
    pairs = pairs.join(sums, ["lang", "g", "h"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))

    whole = by_term.groupBy("lang", "term").agg(F.sum("n").alias("n_all"))
    terms = by_term.join(whole, ["lang", "term"]).withColumn("q", F.expr(share("n_all", "whole + v"))).where("p > q")
    terms = terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), F.expr(PART).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked(pairs).unionByName(ranked(terms).where(F.col("rank") <= top))


#: The query in SQL.
SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), words AS MATERIALIZED (
  SELECT k, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS MATERIALIZED (
  SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT k) >= 3
), c AS MATERIALIZED (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
), v AS (
  SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY ALL
), g AS MATERIALIZED (
  SELECT lang, source, coalesce(total, 0)::HUGEINT AS total, coalesce(v, 0)::HUGEINT AS v
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source) LEFT JOIN v USING (lang)
), p AS MATERIALIZED (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.total + g.v) AS p
  FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
), q AS (
  SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(n) + 1)::HUGEINT // (all_n + v) AS q
  FROM c JOIN v USING (lang) JOIN (SELECT lang, sum(n)::HUGEINT AS all_n FROM c GROUP BY ALL) USING (lang) GROUP BY lang, term, all_n, v
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source AS s, y.source AS o, sum((x.p - y.p) * (x.p - y.p) // y.p) AS f FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL
  ) z ON z.lang = a.lang AND z.s = a.source AND z.o = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""
