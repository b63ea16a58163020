"""URL rules through Bloom filter cascades: exact membership for every key of the corpus, no join.

A rule is a key, host and path prefix. Level 0 of a cascade encodes the listed keys; level 1 the
corpus's keys that level 0 takes by mistake; level 2 the listed keys that level 1 takes; and so on
until a level takes nothing by mistake. A key of the corpus leaves at the first level that rejects
it: an odd one means listed. Judging a page hashes the keys of its own url and reads the levels.

Level 0 has so many bits a key that its mistakes among all keys of the corpus are about as many as
the listed keys: every level grows with the rules, and with the corpus by its logarithm alone. Lists too long for a level are split
by a hash of the key into shards, each a cascade of its own that is judged in a pass of its own.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from .shared import need, set_aside, stored

#: Bits for each key of a level, at least, and bits that a level may have to be broadcast.
BITS, MOST_BITS = 10, 1 << 30
URL = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# The rules of the query, as (host, path, verdict).
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def parts_of(url: str | None) -> tuple[str, str]:
    """(host, path); both empty without a url or a ://."""
    found = URL.search(url or "")
    return (found[1].translate(LOWER), found[2]) if found else ("", "")


def keys_of(host: str, path: str, dots: int | None = None, slashes: int | None = None) -> list[str]:
    """Every key that fits, the longest first: each domain above the host with each folder above the path.

    No more than ``dots`` in the domain and ``slashes`` in the folder: no rule has more, so long urls make no more keys.
    """
    cuts = [i + 1 for i, c in enumerate(host) if c == "."]
    domains = [host[i:] for i in ([0, *cuts] if dots is None else [0, *cuts][max(0, len(cuts) - dots) :])]
    folders, at = [], -1
    while (slashes is None or len(folders) < slashes) and (at := path.find("/", at + 1)) >= 0:
        folders.append(path[: at + 1])
    return sorted((d + f for d in domains for f in folders), key=lambda k: (-len(k), k))


def digests(keys: list[str], level: int) -> np.ndarray:
    """Two 64-bit hashes a key; each level hashes with a seed of its own."""
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(k.encode("utf-8", "surrogatepass"), seed=level) for k in keys), "<u8").reshape(-1, 2)


def shard_of(keys: list[str], shards: int) -> np.ndarray:
    return (digests(keys, 1 << 32)[:, 0] % np.uint64(shards)).astype(np.int64)


@dataclass
class Level:
    """A Bloom filter: bits as 64-bit words, and probes for each key. One of no words takes nothing."""

    words: np.ndarray
    probes: int

    def at(self, keys: list[str], level: int) -> np.ndarray:
        """Bit positions, one row for each key."""
        both = digests(keys, level)
        return (both[:, :1] + np.arange(self.probes, dtype=np.uint64) * (both[:, 1:] | np.uint64(1))) % np.uint64(64 * len(self.words))


@dataclass
class Cascade:
    levels: list[Level] = field(default_factory=list)

    def passes(self, keys: list[str], level: int) -> np.ndarray:
        one = self.levels[level]
        if not len(one.words) or not keys:
            return np.zeros(len(keys), bool)
        at = one.at(keys, level)
        return ((one.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)

    def has(self, keys: list[str]) -> np.ndarray:
        """Membership; right for the listed keys and for those of the universe it was built over."""
        out, open_ = np.zeros(len(keys), bool), np.arange(len(keys))
        for level in range(len(self.levels)):
            stays = self.passes([keys[i] for i in open_], level)
            out[open_[~stays]] = level % 2 == 1
            open_ = open_[stays]
        out[open_] = len(self.levels) % 2 == 1
        return out


def bits_for(listed: int, universe: int) -> int:
    """Bits a key so that about as many keys of the universe are taken by mistake as are listed."""
    return max(BITS, math.ceil(math.log2(max(2.0, universe / max(listed, 1))) / math.log(2)))


def level_of(keys: DataFrame, level: int, bits: int) -> Level:
    """The filter of one level; its words are united in Spark, and the driver gets them as Arrow batches, MOST_BITS at most."""
    n = keys.count()
    made = Level(np.zeros(-(-n * bits // 64), np.uint64), max(1, round(bits * math.log(2))))
    size, n_probes = len(made.words), made.probes

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = Level(np.broadcast_to(np.uint64(0), size), n_probes)
        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.unique(shape.at(batch.column(0).to_pylist(), level))
            mask = np.uint64(1) << (at & np.uint64(63))
            where, first = np.unique(at >> np.uint64(6), return_index=True)
            yield pa.record_batch([pa.array(where.astype(np.int64)), pa.array(np.bitwise_or.reduceat(mask, first).view(np.int64))], ["word", "mask"])

    if n:
        table = keys.mapInArrow(run, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
        made.words[table["word"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
    return made


def passing(keys: DataFrame, cascade: Cascade, level: int) -> DataFrame:
    held = keys.sparkSession.sparkContext.broadcast(cascade)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            yield pa.record_batch([pa.array([k for k, yes in zip(names, held.value.passes(names, level)) if yes], pa.string())], ["key"])

    return keys.mapInArrow(run, "key string")


@dataclass
class Universe:
    """The keys of all urls of a table that a rule could have, of one shard of ``shards``."""

    pages: DataFrame
    url: str
    dots: int
    slashes: int
    shards: int = 1
    shard: int = 0

    def size(self) -> int:
        """Keys of all urls, repeats included, by their dots and slashes: no more than this are different."""
        host = F.regexp_extract(F.coalesce(F.col(self.url), F.lit("")), "(?s)^.*?://([^/?#]*)([^?#]*)", 1)
        path = F.regexp_extract(F.coalesce(F.col(self.url), F.lit("")), "(?s)^.*?://([^/?#]*)([^?#]*)", 2)
        n = F.least(1 + F.regexp_count(host, F.lit("[.]")), F.lit(self.dots + 1)) * F.least(F.regexp_count(path, F.lit("/")), F.lit(self.slashes))
        return int(self.pages.agg(F.sum(n.cast("long")).alias("n")).first().n or 0) // self.shards

    def taken(self, cascade: Cascade) -> DataFrame:
        """The keys that the cascade's first level takes, repeats left out; none of the others needs to be stored."""
        held = self.pages.sparkSession.sparkContext.broadcast(cascade)
        dots, slashes, shards, shard = self.dots, self.slashes, self.shards, self.shard

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                names = list({k for x in batch.column(0).to_pylist() for k in keys_of(*parts_of(x), dots, slashes)})
                if shards > 1 and names:
                    names = [k for k, s in zip(names, shard_of(names, shards)) if s == shard]
                yield pa.record_batch([pa.array([k for k, yes in zip(names, held.value.passes(names, 0)) if yes], pa.string())], ["key"])

        return self.pages.select(self.url).mapInArrow(run, "key string").distinct()


def build(listed: DataFrame, universe: Universe, most_levels: int = 64) -> Cascade:
    """The cascade of a stored list (column key, each once) over a universe."""
    first = bits_for(listed.count(), universe.size())
    cascade = Cascade([level_of(listed, 0, first)])
    wrong = stored(universe.taken(cascade).join(listed, "key", "left_anti"), "wrong")
    taken, other = wrong, listed
    while taken.head(1):
        if len(cascade.levels) == most_levels:
            raise RuntimeError("the cascade does not end; are hashes of different keys equal?")
        level = len(cascade.levels)
        cascade.levels.append(level_of(taken, level, BITS))
        taken, other = stored(passing(other, cascade, level), "taken"), taken
    return cascade


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] | DataFrame | None = None, default: str = "allow", url: str = "url", most_bits: int | None = None) -> DataFrame:
    """pages with host, path, rule and verdict; of the rules that fit, the longest decides, of equally long ones the first by code point.

    rules: (host, path, verdict), as a list or a DataFrame with these columns; hosts in lower
    case, paths from a slash to a slash, verdict allow or block. A rule fits its host and all
    subdomains where the url's path starts with its own. Without one, verdict is ``default``. Null
    and repeated rules count once or not at all; a rule that both allows and blocks is refused. Null
    urls and urls without :// have an empty host and path, which no rule fits. Rows are kept as
    they are, long urls too; an empty table gives no rows; other columns pass through, those of these names with an underscore in front.
    """
    need(pages, url)
    pages, now = set_aside(pages, "host", "path", "rule", "verdict")
    url = now[url]
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(RULES if rules is None else rules, "host string, path string, verdict string")
    if rules.where("not (path like '/%' and path like '%/') or verdict not in ('allow', 'block')").head(1):
        raise ValueError("a rule's path starts and ends with a slash, and its verdict is allow or block")
    keyed = stored(rules.select(F.concat("host", "path").alias("key"), "verdict", F.regexp_count("host", F.lit("[.]")).alias("dots"), F.regexp_count("path", F.lit("/")).alias("slashes")).where("key is not null").distinct(), "rules")
    both = keyed.groupBy("key").count().where("count > 1").head(1)
    if both:
        raise ValueError(f"a rule both allows and blocks {both[0].key}")
    most = keyed.agg(F.max("dots").alias("dots"), F.max("slashes").alias("slashes")).first()
    universe = Universe(pages, url, most.dots or 0, most.slashes or 0)
    total, n = universe.size(), keyed.count()
    shards = max(1, math.ceil(n * bits_for(n, total) / (most_bits or MOST_BITS)))
    shard = F.udf(lambda k: int(shard_of([k], shards)[0]), IntegerType())
    parts = stored(keyed.withColumn("shard", shard("key") if shards > 1 else F.lit(0)), "listed")
    names = [*pages.columns, "host", "path", "rule", "verdict"]
    at = pages.columns.index(url)
    found = pages.withColumns({"host": F.lit(None).cast("string"), "path": F.lit(None).cast("string"), "rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    schema = StructType([*pages.schema.fields, *(StructField(x, StringType()) for x in ("host", "path", "rule", "verdict"))])
    for i in range(shards):
        one = Universe(pages, url, universe.dots, universe.slashes, shards, i)
        lists = {v: build(parts.where((F.col("verdict") == v) & (F.col("shard") == i)).select("key"), one) for v in ("allow", "block")}
        held = spark.sparkContext.broadcast(lists)
        found = found.mapInArrow(_judging(held, at, names, one.dots, one.slashes, shards, i), schema)
    return found


def _judging(held, at: int, names: list[str], dots: int, slashes: int, shards: int, shard: int):
    """Arrow function that sets host and path, and rule and verdict where a rule of this shard is longer than the one found."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sites = [parts_of(x) for x in batch.column(at).to_pylist()]
            keys = [keys_of(*x, dots, slashes) for x in sites]
            if shards > 1:
                flat = [k for x in keys for k in x]
                mine = dict(zip(flat, shard_of(flat, shards).tolist())) if flat else {}
                keys = [[k for k in x if mine[k] == shard] for x in keys]
            flat = [k for x in keys for k in x]
            found = {v: cascade.has(flat) for v, cascade in held.value.items()}
            rule, verdict = (batch.column(len(names) - 2 + j).to_pylist() for j in (0, 1))
            i = 0
            for row, mine in enumerate(keys):
                hit = next(((k, v) for j, k in enumerate(mine, i) for v in found if found[v][j]), None)
                i += len(mine)
                if hit and (rule[row] is None or (-len(hit[0]), hit[0]) < (-len(rule[row]), rule[row])):
                    rule[row], verdict[row] = hit
            made = [[h for h, _ in sites], [p for _, p in sites], rule, verdict]
            yield pa.record_batch([*batch.columns[: len(names) - 4], *(pa.array(x, pa.string()) for x in made)], names)

    return run


SQL = r"""
WITH sites AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), rules(h, p, v) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
)
SELECT page_id, host, path, arg_max(h || p, length(h || p)) AS rule, coalesce(arg_max(v, length(h || p)), 'allow') AS verdict
FROM sites LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
GROUP BY page_id, host, path
"""
