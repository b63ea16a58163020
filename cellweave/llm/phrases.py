"""Phrase collocations, counted in HAT-tries.

A task counts the phrases of its texts in a trie of word ids. At first a container, a hash table of phrases, holds those of
a block of first words; one that outgrows BURST entries bursts: words that many of its phrases go on with get
containers of their own below it. A trie that outgrows its bound spills whole subtrees, the largest first, as runs sorted by
words. Runs are merged by prefix partition: a first word's subtree is dealt over DEALT partitions by the rest of the
phrase, so none gathers in one task.

Lengths come one after another: a phrase of m words counts only where both its parts of m - 1 words may be frequent, by
a filter that stops no frequent one. So counts of frequent phrases are exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import rolling
from .shared import give_back, need, slices, stored
from .words import STEP_BYTES, Filter, Words, filter_of, hashes, table_of, texts_in_steps

#: What ends a piece, what parts words within it.
ENDS = table_of(*((ord(c), ord(c)) for c in ".,;:!?"), (0x0A, 0x0D))
BLANKS = table_of((0x09, 0x09), (0x20, 0x20))
#: Entries of a container before it bursts, of a trie before it spills; its words, fewer than 2^20; partitions of a prefix.
BURST, MOST_ENTRIES, MOST_WORDS, DEALT = 4096, 700_000, 600_000, 32
#: Bits of a word id in a packed path, and of the first words that share a container.
ID_BITS, BLOCK_BITS = 32, 8
MASK = (1 << ID_BITS) - 1
#: Rows of a batch of a run.
RUN_ROWS = 1 << 15
FOLD = np.uint64(0x9E3779B97F4A7C15)


class Node:
    """A container, and once it has burst the containers below it. held: counts by path, packed, its next word lowest."""

    __slots__ = ("held", "below", "limit")

    def __init__(self, limit: int):
        self.held: dict[int, int] = {}
        self.below: dict[int, Node] = {}
        self.limit = limit

    def burst(self, limit: int) -> None:
        """Words with an eighth of the entries get containers for what follows them; paths of one word stay."""
        sizes: dict[int, int] = {}
        for k in self.held:
            if k > MASK:
                sizes[k & MASK] = sizes.get(k & MASK, 0) + 1
        large = {word for word, n in sizes.items() if n >= max(limit // 8, 2)}
        for k in [k for k in self.held if k > MASK and k & MASK in large]:
            word = k & MASK
            if word not in self.below:
                self.below[word] = Node(limit)
            self.below[word].held[k >> ID_BITS] = self.held.pop(k)
        self.limit = max(limit, 2 * len(self.held))

    def size(self) -> int:
        return len(self.held) + sum(x.size() for x in self.below.values())

    def entries(self) -> Iterator[tuple[list[int], list[int]]]:
        """(paths, packed; counts) of the subtree."""
        yield list(self.held), list(self.held.values())
        for word, node in self.below.items():
            for paths, counts in node.entries():
                yield [k << ID_BITS | word for k in paths], counts


class HatTrie:
    """Counts of paths of word ids. A word of a language has one id, from 1 on; 0 ends a path."""

    def __init__(self, burst: int | None = None):
        self.burst, self.size = burst or BURST, 0
        self.top: dict[int, Node] = {}
        self.ids: dict[str, dict[bytes, int]] = {}
        self.names, self.langs, self.keys = [b""], [""], [0]

    def ids_of(self, lang: str, names: list[bytes], keys: list[int]) -> list[int]:
        mine = self.ids.setdefault(lang, {})
        out = []
        for name, key in zip(names, keys):
            at = mine.get(name)
            if at is None:
                at = mine[name] = len(self.names)
                self.names.append(name)
                self.langs.append(lang)
                self.keys.append(key)
            out.append(at)
        return out

    def add(self, blocks: list[int], paths: list[int], counts: list[int]) -> None:
        """blocks: the block of each path's first word."""
        top, new = self.top, 0
        for block, k, n in zip(blocks, paths, counts):
            node = top.get(block)
            if node is None:
                node = top[block] = Node(self.burst)
            while k > MASK:
                below = node.below.get(k & MASK)
                if below is None:
                    break
                node = below
                k >>= ID_BITS
            held = node.held
            before = held.get(k)
            if before is None:
                new += 1
                held[k] = n
                if len(held) > node.limit:
                    node.burst(self.burst)
            else:
                held[k] = before + n
        self.size += new

    def spill(self, down_to: int) -> Iterator[pa.RecordBatch]:
        """Takes subtrees out, the largest first, until ``down_to`` entries are left, and gives them as sorted runs."""
        paths, counts = [], []
        for size, block in sorted(((node.size(), block) for block, node in self.top.items()), reverse=True):
            if self.size <= down_to:
                break
            for k, n in self.top.pop(block).entries():
                paths += k
                counts += n
            self.size -= size
        if paths:
            yield from self.run(paths, np.array(counts, np.int64))

    def run(self, paths: list[int], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        names = pa.array(self.names, pa.binary())
        rank = np.empty(len(names), np.int64)
        rank[pc.sort_indices(names).to_numpy()] = np.arange(len(names))
        keys = np.array(self.keys, np.uint64)
        longest = -(-max(paths).bit_length() // ID_BITS)
        if longest <= 2:
            packed = np.array(paths, np.uint64)
            path = [(packed >> np.uint64(ID_BITS * j) & np.uint64(MASK)).astype(np.int64) for j in range(longest)]
        else:
            path = [np.array([k >> (ID_BITS * j) & MASK for k in paths], np.int64) for j in range(longest)]
        order = np.lexsort([rank[x] for x in path[::-1]])
        path, counts = [x[order] for x in path], counts[order]
        rest = np.zeros(len(counts), np.uint64)
        for x in path[1:]:
            rest = rolling.mix(rest * FOLD + keys[x])
        part = (rolling.mix(keys[path[0]] + rest % np.uint64(DEALT) * FOLD) >> np.uint64(33)).astype(np.int32)
        langs = pa.array(self.langs, pa.string())
        for a in range(0, len(counts), RUN_ROWS):
            here = [x[a : a + RUN_ROWS] for x in path]
            phrase = names.take(pa.array(here[0]))
            for x in here[1:]:
                more = pc.binary_join_element_wise(phrase, names.take(pa.array(x)), pa.scalar(b" "))
                phrase = pc.if_else(pa.array(x > 0), more, phrase)
            yield pa.record_batch([pa.array(part[a : a + RUN_ROWS]), langs.take(pa.array(here[0])), phrase.cast(pa.string()), pa.array(counts[a : a + RUN_ROWS])], ["part", "lang", "phrase", "n"])


def folded(keys: list[np.ndarray]) -> np.ndarray:
    """One hash of the words of each phrase, from their keys in turn."""
    out = keys[0]
    for x in keys[1:]:
        out = rolling.mix(out * FOLD + x)
    return out


def phrase_keys(phrases: DataFrame) -> DataFrame:
    """h: the hash of each phrase (lang, phrase), as ``folded`` gives it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            seeds = {lang: int(hashes([lang.encode()])[0]) for lang in set(batch.column(0).to_pylist())}
            words = [x.encode().split(b" ") for x in batch.column(1).to_pylist()]
            keys = [np.array([hashes([w[j]], seeds[lang])[0] for w, lang in zip(words, batch.column(0).to_pylist())], np.uint64) for j in range(len(words[0]))]
            yield pa.record_batch([pa.array(folded(keys).view(np.int64))], ["h"])

    return phrases.select("lang", "phrase").mapInArrow(run, "h long")


class Counter:
    """Counts the phrases of given lengths of one task's texts, of over one word those whose parts pass."""

    def __init__(self, lengths: tuple[int, ...], passing: Filter, most: int):
        self.lengths, self.passing, self.most, self.trie = lengths, passing, most, HatTrie()
        self.total: dict[str, int] = {}

    def step(self, lang: str, data: np.ndarray, offsets: np.ndarray, shown: int) -> None:
        """Phrases that end behind the first ``shown`` words of texts in one language."""
        held = Words(data, offsets, ENDS | BLANKS)
        n, codes, names = len(held.codes), held.codes, held.names.to_pylist()
        self.total[lang] = self.total.get(lang, 0) + n - shown
        if not n:
            return
        keys = hashes(names, int(hashes([lang.encode()])[0]))
        piece = np.cumsum(ENDS[data])[held.start] + held.text * (len(data) + 1)
        follows = piece[1:] == piece[:-1]
        for m in self.lengths:
            at = np.arange(max(shown - m + 1, 0), n - m + 1)
            for j in range(m - 1):
                at = at[follows[at + j]]
            if m > 1:  # both parts of m - 1 words must pass
                parts = [folded([keys[codes[at + s + j]] for j in range(m - 1)]) for s in (0, 1)]
                at = at[self.passing.passes(parts[0]) & self.passing.passes(parts[1])]
            if not len(at):
                continue
            path = codes[at]
            for j in range(1, m):  # distinct phrases so far as numbers, then pairs of those and the next word
                if j > 1:
                    path = np.unique(path, return_inverse=True)[1]
                path = path * len(names) + codes[at + j]
            _, where, counts = np.unique(path, return_index=True, return_counts=True)
            words = [codes[at[where] + j] for j in range(m)]
            used = np.unique(np.concatenate(words))
            ids = np.zeros(len(names), np.int64)
            ids[used] = self.trie.ids_of(lang, [names[i] for i in used.tolist()], keys[used].tolist())
            path = [ids[x] for x in words]
            packed = (path[0] | path[1] << ID_BITS if m > 1 else path[0]).tolist()
            for j in range(2, m):
                packed = [k | x << (ID_BITS * j) for k, x in zip(packed, path[j].tolist())]
            self.trie.add((path[0] >> BLOCK_BITS).tolist(), packed, counts.tolist())

    def spilled(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        if last or len(self.trie.names) > MOST_WORDS:
            yield from self.trie.spill(0)
            self.trie = HatTrie()
        elif self.trie.size > self.most:
            yield from self.trie.spill(self.most // 2)


def counted(docs: DataFrame, lengths: tuple[int, ...], passing: Filter, least: int, most: int = MOST_ENTRIES) -> DataFrame:
    """lang, phrase, n of the phrases (lang, text) of these lengths that occur ``least`` times; phrase '': all words of a language."""
    sent = docs.sparkSession.sparkContext.broadcast(passing)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Counter(lengths, sent.value, most)
        for batch in slices(batches, limit=STEP_BYTES):
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in dict.fromkeys(langs):
                for data, offsets, shown in texts_in_steps(batch.column(1).filter(pa.array(langs == lang)), ENDS, BLANKS, max(lengths) - 1):
                    mine.step(lang, data, offsets, shown)
                    yield from mine.spilled()
        yield from mine.spilled(last=True)
        if 1 in lengths:
            rows = list(mine.total.items())
            yield pa.record_batch([pa.array([0] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.string()), pa.array([""] * len(rows)), pa.array([r[1] for r in rows], pa.int64())], ["part", "lang", "phrase", "n"])
        mine.trie = None
        give_back()

    rows = docs.select("lang", "text").mapInArrow(run, "part int, lang string, phrase string, n long")
    merged = rows.repartition("part").groupBy("part", "lang", "phrase").agg(F.sum("n").alias("n"))
    return merged.where((F.col("n") >= least) | (F.col("phrase") == "")).select("lang", "phrase", "n")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000, lang: str = "lang", text: str = "text", most: int = MOST_ENTRIES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of two to ``longest`` words.

    Score: a million times a * a over l * r, floored, at the cut that gives least; it is exact in decimals below
    10^38. Phrases inside a longer one that has ``share`` percent of their count are left out. Null languages are
    ``und``, null and empty texts have no words; repeated rows count each; a long text counts whole, in steps; an empty table
    gives no rows; other columns are ignored.
    """
    need(docs, lang, text)
    plain = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    shorter = found = stored(counted(plain, (1,), Filter(), least, most).withColumn("m", F.lit(1)), "phrases")
    for m in range(2, longest + 1):
        shorter = shorter.where("phrase <> ''")
        n = shorter.count()
        passing = filter_of(phrase_keys(shorter), n) if n else Filter(64, np.zeros(1, np.uint64))
        shorter = stored(counted(plain, (m,), passing, least, most).withColumn("m", F.lit(m)), "phrases")
        found = found.unionByName(shorter)
    known = found.where("phrase <> ''")
    words = F.split("phrase", " ")
    candidates = known.where("m > 1").withColumnRenamed("n", "a")
    part = lambda start, size: F.array_join(F.slice("w", start, size), " ")
    cuts = candidates.withColumn("w", words).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.col("m") - F.col("k")).alias("tail"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r")), ["lang", "tail"])
    exact = F.expr("(1000000BD * cast(a as decimal(18,0)) * cast(a as decimal(18,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("cut"))
    inner = candidates.where("m > 2").withColumn("w", words).withColumn("size", F.explode(F.sequence(F.lit(2), F.col("m") - 1)))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("m") - F.col("size") + 1))).select("lang", part(F.col("at"), F.col("size")).alias("phrase"), "a")
    inside = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(inside, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {share} * a")
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = found.where("phrase = ''").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


#: The query in SQL.
SQL = r"""
WITH pieces AS MATERIALIZED (
  SELECT lang, row_number() OVER () AS p, w FROM (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents))
  WHERE len(w) > 0
), grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces, range(1, 4) AS s(m))
), f AS MATERIALIZED (
  SELECT lang, m, phrase, count(*)::HUGEINT AS n FROM grams GROUP BY ALL
), cand AS (
  SELECT lang, m, phrase, string_split(phrase, ' ') AS w, n AS a FROM f WHERE m > 1 AND n >= 10
), cuts AS (
  SELECT c.lang, c.phrase, c.m, c.a, c.k, l.n AS l, r.n AS r, 1000000::HUGEINT * a * a // (l.n * r.n) AS score
  FROM (SELECT lang, phrase, m, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)) c
  JOIN f l ON l.lang = c.lang AND l.phrase = c.head
  JOIN f r ON r.lang = c.lang AND r.phrase = c.tail
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS longer FROM (SELECT lang, w, a, unnest([1, 2]) AS i FROM cand WHERE m = 3) GROUP BY ALL
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best b LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
