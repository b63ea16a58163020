"""Near copies by SimHash: fingerprints of word shingles, compared exactly, tile against tile.

Distinct fingerprints are dealt by population counts, of the whole or of pieces where there are
many. Every pair of groups whose counts come within the radius meets in one task, which compares
tile by tile with exclusive-or and bit counts; pairs of groups beyond it never meet. A task
reports the links of a spanning forest only, so a large group of near copies costs no pairs;
components of those links give the groups.

Where a similarity of shingle sets is asked for, the bits only name candidates, by wide radii. The
sets of each group of candidates are then held against each other, block by block, and components
of the pairs that are as similar give the groups.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate, groupby
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rolling
from .shared import components, need, salted_join, slices, stored

SEED = 42
#: Distinct fingerprints of a strip, until there are MOST_STRIPS; rows and columns of a tile.
STRIP, MOST_STRIPS, TILE_ROWS, TILE_COLUMNS = 8192, 1024, 256, 4096
#: Groups by population counts that the driver may name.
MOST_GROUPS = 100_000
#: Candidates and shingles of a block, about; shared shingles that one step counts.
SET_DOCS, SET_SHINGLES, SET_COLUMNS = 512, 1 << 19, 4096
LANES = 0x0101010101010101


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(XXH64 of each shingle, text by text; number of each text's shingles)."""
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    start, end, first = rolling.words_of(data, offsets)
    length = end - start + 1
    spaced = np.r_[data, np.uint8(32)][rolling.ranges(start, length)] if len(start) else data[:0]
    stop = np.cumsum(length)
    spaced[stop - 1] = 32
    words = np.diff(first)
    count = np.where(words >= size, words - size + 1, np.minimum(words, 1))
    head = rolling.ranges(first[:-1], count)
    tail = np.minimum(head + size, np.repeat(first[1:], count)) - 1
    raw, digest = spaced.tobytes(), xxhash.xxh64_intdigest
    hashes = [digest(raw[a:b], SEED) for a, b in zip((stop - length)[head].tolist(), (stop - 1)[tail].tolist())]
    return np.array(hashes, np.uint64), count


def majority(hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Per text, the bits set in over half of its hashes; eight bits are counted in one addition."""
    out = np.zeros(len(count), np.uint64)
    full = np.flatnonzero(count)
    if not len(full):
        return out
    n = count[full]
    parts = -(-n // 255)  # sums of 255 bits fit a byte
    begin = np.cumsum(n) - n
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    cuts, texts = np.repeat(begin, parts) + nth * 255, np.cumsum(parts) - parts
    for shift in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(shift)) & np.uint64(LANES), cuts)
        per_text = np.add.reduceat(sums.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), texts, axis=0)
        for byte in range(8):
            out[full] |= (2 * per_text[:, byte] > n).astype(np.uint64) << np.uint64(8 * byte + shift)
    return out


def distinct_hashes(hashes: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of each text in order, each once, and their number."""
    owner = np.repeat(np.arange(len(count)), count)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])][: len(hashes)]
    return hashes[new], np.bincount(owner[new], minlength=len(count))


def binaries(raw: bytes, at: np.ndarray) -> pa.Array:
    """The bytes cut at ``at``, one value between two cuts."""
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype("<i4").tobytes()), pa.py_buffer(raw)])


def fingerprints(docs: DataFrame, shingle: int = 5, lanes: int = 1, distinct: bool = False, doc_id: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """doc_id, n (shingles), fp (8 bytes a lane, big-endian), for every row; with ``row`` that column and the 128-bit hash of the shingles too.

    Words are runs of non-space, A-Z lower-cased; texts with fewer words than a shingle are one
    shingle; null, empty and blank texts have none and fingerprint zero. ``distinct`` counts equal
    shingles of a text once. The first lane uses the shingle's XXH64, the others a mix of it.
    """
    need(docs, doc_id, text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, count = shingle_hashes(*rolling.buffer_of(batch.column(1)), shingle)
            if distinct:
                hashes, count = distinct_hashes(hashes, count)
            bits = [majority(hashes if j == 0 else rolling.mix(hashes + np.uint64(j * rolling.BYTE_BASE & (1 << 64) - 1)), count) for j in range(lanes)]
            made = [batch.column(0).cast("int64"), pa.array(count.astype(np.int64)), binaries(np.stack(bits, 1).astype(">u8").tobytes(), np.arange(len(count) + 1) * 8 * lanes)]
            if row:
                raw, at = hashes.tobytes(), np.r_[0, np.cumsum(count)] * 8
                made += [batch.column(2), pa.array([xxhash.xxh3_128_digest(raw[i:j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())]
            yield pa.record_batch(made, ["doc_id", "n", "fp", "row", "shingles"][: len(made)])

    return docs.select(doc_id, text, *([row] if row else [])).mapInArrow(run, "doc_id long, n long, fp binary" + (", row long, shingles binary" if row else ""))


def unite(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Hooks the labels of linked nodes to the smaller until all links hold."""
    while len(u):
        a, b = labels[u], labels[v]
        apart = a != b
        if not apart.any():
            return
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        labels[np.maximum(a, b)] = np.minimum(a, b)
        while True:
            deeper = labels[labels]
            if (deeper == labels).all():
                break
            labels[:] = deeper


def forest(left: np.ndarray, right: np.ndarray, key_l: np.ndarray, key_r: np.ndarray, reach, radius: int, first_lanes: int, first_radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, root) that join what is within the radius; nodes count on from left to right."""
    shift = 0 if same else len(left)
    labels = np.arange(len(left) if same else len(left) + len(right))
    for a in range(0, len(left), TILE_ROWS):
        rows = left[a : a + TILE_ROWS]
        lo, hi = reach(key_l[a], key_l[a + len(rows) - 1])
        begin, stop = np.searchsorted(key_r, lo), np.searchsorted(key_r, hi, side="right")
        for b in range(max(begin, a) if same else begin, stop, TILE_COLUMNS):
            columns = right[b : min(b + TILE_COLUMNS, stop)]
            apart = sum(np.bitwise_count(rows[:, k][:, None] ^ columns[:, k][None, :]) for k in range(first_lanes))
            u, v = np.nonzero(apart <= first_radius)
            if same:
                u, v = u[v + b > u + a], v[v + b > u + a]
            if rows.shape[1] > first_lanes and len(u):
                whole = np.bitwise_count(rows[u] ^ columns[v]).sum(axis=1, dtype=np.int64) <= radius
                u, v = u[whole], v[whole]
            unite(labels, u + a, v + b + shift)
    nodes = np.flatnonzero(labels != np.arange(len(labels)))
    return nodes, labels[nodes]


def pieces_for(total: int, lanes: int, radius: int) -> int:
    """Into how many pieces fingerprints are cut to be dealt by their population counts.

    Enough that fair bits put STRIP of them or so into the largest group; but the groups stay
    few enough to be named (17^4 for 64 bits).
    """
    for parts in (1, 2, 4):
        bits = 64 * lanes // parts
        if parts > 1 and (radius > 8 or (bits + 1) ** parts > MOST_GROUPS):
            return parts // 2
        if total * (comb(bits, bits // 2) / 2**bits) ** parts <= 2 * STRIP:
            break
    return parts


def piece_counts(lanes: int, parts: int) -> list[Column]:
    """Bits set in each piece of fp."""
    digits = 16 * lanes // parts
    word = lambda at, n: F.bit_count(F.conv(F.substring(F.hex("fp"), at + 1, n), 16, -10).cast("long")).cast("long")
    return [sum((word(at, min(16, digits)) for at in range(k * digits, (k + 1) * digits, 16)), F.lit(0).cast("long")) for k in range(parts)]


def within(parts: int, radius: int) -> list[tuple[int, ...]]:
    """All whole vectors whose absolute values sum to ``radius`` at most."""
    if parts == 1:
        return [(i,) for i in range(-radius, radius + 1)]
    return [(i, *rest) for i in range(-radius, radius + 1) for rest in within(parts - 1, radius - abs(i))]


def groups(prints: DataFrame, lanes: int = 1, radius: int = 3, first_lanes: int = 1, first_radius: int | None = None, similarity: float = 0.0, shingle: int = 5, texts: DataFrame | None = None) -> DataFrame:
    """fp, root, component_id for each distinct fingerprint of a stored table.

    Linked: at most ``radius`` bits differ, at most first_radius of the first lanes'. With a
    similarity these are candidates for ``verified``, and there is a row for each distinct set of
    shingles (column shingles); prints have a row key then, by which ``texts`` (row, text) are
    found. root: a key of the component. component_id: the smallest doc_id reachable.

    Without a similarity, fingerprints are dealt by the population counts of their pieces: what
    differs in ``radius`` bits has counts whose differences sum to no more, so each group meets
    those groups alone. With one, they are dealt in order of n into strips, as the smaller set
    has at least that share of the larger's size.
    """
    first_radius = radius if first_radius is None else first_radius
    spark = prints.sparkSession
    by_size = similarity > 0
    if by_size:
        alike = prints.groupBy("shingles").agg(F.min("fp").alias("fp"), F.min("n").alias("n"), F.min("doc_id").alias("least"), F.min("row").alias("row"))
    else:
        alike = prints.groupBy("fp").agg(F.lit(0).cast("long").alias("n"), F.min("doc_id").alias("least"))
    alike = stored(alike.withColumn("rep", F.monotonically_increasing_id()), "fingerprints")
    total = alike.count()
    if by_size:
        strips = min(MOST_STRIPS, max(1, -(-total // STRIP)))
        dealt = stored(alike.repartitionByRange(strips, "n", "fp").withColumn("strip", F.spark_partition_id().cast("long")), "strips")
        bounds = {r.strip: (r.lo, r.hi) for r in dealt.groupBy("strip").agg(F.min("n").alias("lo"), F.max("n").alias("hi")).collect()}
        subs = dict.fromkeys(sorted(bounds), 1)

        def reach(lo: int, hi: int) -> tuple[float, float]:
            return int(lo * similarity), int(hi / similarity) + 1

        def partners_of(g: int) -> list[int]:
            lo, hi = reach(*bounds[g])
            return [h for h, (least, most) in bounds.items() if least <= hi and most >= lo]
    else:
        parts = pieces_for(total, lanes, radius)
        base = 64 * lanes // parts + 1
        name = sum((c * base**k for k, c in enumerate(piece_counts(lanes, parts))), F.lit(0).cast("long"))
        dealt = stored(alike.withColumn("strip", name).repartition("strip", F.pmod(F.xxhash64("fp"), F.lit(16))), "strips")
        # base^parts names at most; a group of more than STRIP is split by a hash of the fingerprint
        subs = {r.strip: -(-r["count"] // STRIP) for r in dealt.groupBy("strip").count().collect()}
        steps = within(parts, radius)

        def reach(lo: int, hi: int) -> tuple[float, float]:
            return lo, hi  # n is 0 for all

        def partners_of(g: int) -> list[int]:
            place = [g // base**k % base for k in range(parts)]
            near = ([a + b for a, b in zip(place, step)] for step in steps)
            return [h for x in near if 0 <= min(x) and max(x) < base for h in [sum(c * base**k for k, c in enumerate(x))] if h in subs]

    first = dict(zip(subs, accumulate([0, *subs.values()])))

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strip, key, rep, raw = (batch.column(i) for i in range(4))
            strip, key, rep = (np.asarray(x) for x in (strip, key, rep))
            prints_ = np.frombuffer(b"".join(raw.to_pylist()), ">u8").astype("<u8").reshape(-1, lanes)
            for g in np.unique(strip).tolist():
                mine = np.flatnonzero(strip == g)
                part = rolling.mix(prints_[mine, 0]) % np.uint64(subs[g])
                others = [j for h in partners_of(g) for j in range(first[h], first[h] + subs[h])]
                for sub in np.unique(part).tolist():
                    own, i = mine[part == sub], first[g] + sub
                    data = [x[own].astype(kind).tobytes() for x, kind in ((key, "<i8"), (rep, "<i8"), (prints_, "<u8"))]
                    rows = [(min(i, j) << 32 | max(i, j), int(j < i), *data) for j in others]
                    for at in range(0, len(rows), 16):
                        yield pa.record_batch([pa.array(x) for x in zip(*rows[at : at + 16])], ["pair", "side", "key", "rep", "fp"])

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
        for pair, members in groupby(rows, key=lambda r: r[0]):
            sides: tuple[list, list] = ([], [])
            for _, side, *data in members:
                sides[side].append(data)
            if pair >> 32 != pair & 0xFFFFFFFF and not (sides[0] and sides[1]):
                continue
            tables = []
            for side in sides:
                key, rep = (np.frombuffer(b"".join(x[i] for x in side), "<i8") for i in (0, 1))
                prints_ = np.frombuffer(b"".join(x[2] for x in side), "<u8").reshape(-1, lanes)
                order = np.argsort(key, kind="stable")
                tables.append((key[order], rep[order], prints_[order]))
            (key_l, rep_l, left), (key_r, rep_r, right) = tables
            same = not sides[1]
            nodes, roots = forest(left, left if same else right, key_l, key_l if same else key_r, reach, radius, first_lanes, first_radius, same)
            reps = rep_l if same else np.r_[rep_l, rep_r]
            if len(nodes):
                yield pa.record_batch([pa.array(reps[nodes]), pa.array(reps[roots])], ["a", "b"])

    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(sum(subs.values()) * 8, 256))
    tiles = dealt.select("strip", F.col("n").alias("key"), "rep", "fp").mapInArrow(spread, "pair long, side long, key binary, rep binary, fp binary")
    links = tiles.repartition(width, "pair").sortWithinPartitions("pair").mapInArrow(compare, "a long, b long")
    roots = components(links)
    if by_size:
        candidates = roots.join(alike.select(F.col("rep").alias("node"), "row", "n"), "node")
        roots = components(verified(texts, candidates, shingle, similarity, width))
    smallest = roots.join(alike.select(F.col("rep").alias("node"), "least"), "node").groupBy("root").agg(F.min("least").alias("component_id"))
    named = alike.join(salted_join(roots, smallest, "root", "node").withColumnRenamed("node", "rep"), "rep", "left")
    root, component = F.coalesce("root", "rep").alias("root"), F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id")
    return stored(named.select("shingles" if by_size else "fp", root, component), "groups")


def similar(left: list[np.ndarray], right: list[np.ndarray] | None, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of sets with that Jaccard similarity at least: of left and right, or i < j of left."""
    sides = [left] if right is None else [left, right]
    sizes = [np.array([len(x) for x in side]) for side in sides]
    flat = [np.concatenate(side) for side in sides]
    if right is None:
        hashes, times = np.unique(flat[0], return_counts=True)
        shared = hashes[times > 1]
    else:
        shared = np.intersect1d(*flat)
    cells = []
    for x, n in zip(flat, sizes):
        at = np.searchsorted(shared, x)
        owner, hit = np.repeat(np.arange(len(n)), n), at < len(shared)
        hit[hit] = shared[at[hit]] == x[hit]
        order = np.argsort(at[hit], kind="stable")
        cells.append((at[hit][order], owner[hit][order]))
    both = np.zeros((len(sizes[0]), len(sizes[-1])))
    for begin in range(0, len(shared), SET_COLUMNS):
        held = []
        for (at, owner), n in zip(cells, sizes):
            i, j = np.searchsorted(at, (begin, begin + SET_COLUMNS))
            table = np.zeros((len(n), min(SET_COLUMNS, len(shared) - begin)), np.float32)
            table[owner[i:j], at[i:j] - begin] = 1
            held.append(table)
        both += held[0] @ held[-1].T
    near = both / np.maximum(sizes[0][:, None] + sizes[-1][None, :] - both, 1) >= similarity
    return np.nonzero(np.triu(near, 1) if right is None else near)


def verified(texts: DataFrame, candidates: DataFrame, shingle: int, similarity: float, width: int) -> DataFrame:
    """Links (a, b) that join what of a group of candidates (node, root, row, n) is as similar.

    A large group is dealt into blocks, and every pair of its blocks meets in one task. Sets are
    those of the shingles' hashes; a task reports a spanning forest only.
    """
    number = F.greatest(F.ceil(F.count("*") / SET_DOCS), F.ceil(F.sum("n") / SET_SHINGLES))
    blocks = candidates.groupBy("root").agg(F.least(F.count("*"), number).alias("blocks"))
    dealt = salted_join(candidates, blocks, "root", "node").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))

    def sets_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4):
            hashes, count = distinct_hashes(*shingle_hashes(*rolling.buffer_of(batch.column(4)), shingle))
            yield pa.record_batch([*batch.columns[:4], binaries(hashes.tobytes(), np.r_[0, np.cumsum(count)] * 8)], ["node", "root", "block", "blocks", "hashes"])

    def hold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
        for (_, i, j), members in groupby(rows, key=lambda r: r[:3]):
            nodes: tuple[list, list] = ([], [])
            sets: tuple[list, list] = ([], [])
            for *_, side, node, hashes in members:
                nodes[side].append(node)
                sets[side].append(np.frombuffer(hashes, np.uint64))
            if not nodes[0] or i != j and not nodes[1]:
                continue
            u, v = similar(sets[0], None if i == j else sets[1], similarity)
            both = np.array(nodes[0] + nodes[1])
            labels = np.arange(len(both))
            unite(labels, u, v if i == j else v + len(nodes[0]))
            moved = np.flatnonzero(labels != np.arange(len(labels)))
            if len(moved):
                yield pa.record_batch([pa.array(both[moved]), pa.array(both[labels[moved]])], ["a", "b"])

    sets = stored(texts.join(dealt, "row").select("node", "root", "block", "blocks", "text").mapInArrow(sets_of, "node long, root long, block long, blocks long, hashes binary"), "sets")
    pairs = sets.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pairs = pairs.select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).cast("int").alias("side"), "node", "hashes")
    return pairs.repartition(width, "root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(hold, "a long, b long")


def near_copies(docs: DataFrame, shingle: int = 5, lanes: int = 1, radius: int = 3, first_lanes: int = 1, first_radius: int | None = None, similarity: float = 0.0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n, fp, component_id for every row: which group of near copies it belongs to.

    With a similarity, shingles of a text count once, and groups are the components of all pairs
    with that Jaccard similarity of shingle sets at least; see ``settings_for``.

    Null, empty and blank texts have fingerprint zero and link like any other. Repeated rows and
    ties get the same component; an empty table gives no rows; other columns are ignored.
    """
    if not similarity:
        prints = stored(fingerprints(docs, shingle, lanes, doc_id=doc_id, text=text), "prints")
        found = groups(prints, lanes, radius, first_lanes, first_radius)
        return salted_join(prints, found.drop("root"), "fp", "doc_id")
    need(docs, doc_id, text)
    rows = stored(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row")), "rows")
    return by_similarity(rows, shingle, lanes, radius, first_lanes, first_radius, similarity).select("doc_id", "n", "fp", "component_id")


def by_similarity(rows: DataFrame, shingle: int, lanes: int, radius: int, first_lanes: int, first_radius: int, similarity: float, doc_id: str = "doc_id", text: str = "text", row: str = "row") -> DataFrame:
    """row, doc_id, n, fp, root, component_id for every row of a stored table whose column ``row`` is unique."""
    prints = stored(fingerprints(rows, shingle, lanes, True, doc_id, text, row), "prints")
    found = groups(prints, lanes, radius, first_lanes, first_radius, similarity, shingle, rows.select(F.col(row).alias("row"), F.col(text).alias("text")))
    return salted_join(prints, found, "shingles", "row").drop("shingles")


def differ(a: int, b: int, common: int) -> float:
    """The chance that a bit differs between fingerprints of sets of a and b shingles, some in common."""
    over = lambda n, k: sum(comb(n, i) for i in range(n + 1) if i > k) / 2**n
    out = 0.0
    for k in range(common + 1):
        p, q = over(a - common, a / 2 - k), over(b - common, b / 2 - k)
        out += comb(common, k) / 2**common * (p + q - 2 * p * q)
    return out


def settings_for(similarity: float, lanes: int = 16) -> dict:
    """Radii at which pairs of that Jaccard similarity of shingle sets are candidates.

    Large sets with similarity s have cosine 2s/(1+s) at equal sizes, and each bit differs with the
    chance angle/pi; small ones are counted out. The radii lie five deviations above the most.
    """
    small = [(a, b, -int(-(a + b) * similarity / (1 + similarity) // 1)) for a in range(1, 31) for b in range(a, int(a / similarity) + 1)]
    chance = max([float(np.arccos(2 * similarity / (1 + similarity)) / np.pi), *(differ(*x) for x in small if x[2] <= x[0])])
    upto = lambda bits: int(bits * chance + 5 * (bits * chance * (1 - chance)) ** 0.5)
    return {"lanes": lanes, "radius": upto(64 * lanes), "first_lanes": 2, "first_radius": upto(128), "similarity": similarity}
