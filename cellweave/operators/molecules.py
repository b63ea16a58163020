"""Reads into molecules: filters, transcript sets, and clustering of molecule tags."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import search
from .partitioning import ROWS, by_key, components, numbered, stored, tasks_for

# Fixed values of the alignment format: flag bits of unmapped, secondary and supplementary records.
UNMAPPED, SECONDARY, SUPPLEMENTARY, REVERSE = 4, 256, 2048, 16


def read_filter(flag: str, chimeric: Column, skip_chimeric: bool = False) -> list[Column]:
    """skip and tag of an alignment: of several tags chimeric names the read, then non_primary."""
    bit = lambda b: F.col(flag).bitwiseAND(b) > 0
    none, more = bit(UNMAPPED | SECONDARY), bit(SUPPLEMENTARY)
    return [(none | more | (chimeric if skip_chimeric else F.lit(False))).alias("skip"), F.when(chimeric, "chimeric").when(more, "non_primary").when(none, "unmapped").otherwise("proper").alias("tag")]


def grouped(reads: DataFrame, keys: list[str], read: str, name: str = "reads") -> DataFrame:
    return reads.groupBy(*keys).agg(F.count("*").alias("n_reads"), F.array_sort(F.collect_list(read)).alias(name))


def common_set(reads: DataFrame, keys: list[str], trans: str) -> DataFrame:
    """keys, common: the transcripts that every read of the group is compatible with, sorted.

    A transcript is common if it is counted once for each read; no group is gathered.
    """
    sizes = reads.groupBy(*keys).agg(F.count("*").alias("_reads"))
    each = reads.select(*keys, F.explode(F.array_distinct(trans)).alias("_t")).groupBy(*keys, "_t").agg(F.count("*").alias("_n"))
    found = each.join(sizes, keys).where("_n = _reads").groupBy(*keys).agg(F.array_sort(F.collect_list("_t")).alias("common"))
    return sizes.select(*keys).join(found, keys, "left").withColumn("common", F.coalesce("common", F.array().cast("array<string>")))


def keep_elements(rows: DataFrame, arrays: list[str], test: str, drop_empty: bool = True) -> DataFrame:
    """Aligned lists without the elements that fail ``test`` (SQL over x.<list>); rows left empty go if asked."""
    zipped = rows.withColumn("_z", F.expr(f"filter(arrays_zip({', '.join(arrays)}), x -> {test})"))
    out = zipped.withColumns({a: F.col(f"_z.{a}") for a in arrays}).drop("_z")
    return out.where(F.size(arrays[0]) > 0) if drop_empty else out


def compatibility(equal: str, compatible: str) -> list[Column]:
    """trans and category: the first equal match alone is full length, else all compatible ones are partial."""
    clean = lambda c: F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: (x != "") & (x != "NA"))
    full = F.size(clean(F.col(equal))) > 0
    return [F.when(full, F.slice(clean(F.col(equal)), 1, 1)).otherwise(clean(F.col(compatible))).alias("trans"), F.when(full, "FullLen").otherwise("Partial").alias("category")]


def rename_chimeric(reads: DataFrame, name: str = "qname", flag: str = "flag", place: str = "place", ties: list[str] | None = None) -> DataFrame:
    """Mapped records; supplementary ones get a name of their own, qname_r0x and their place among all of the file in hex.

    place: a whole number that grows with the line. Flags that are supplementary, on either strand, become primary.
    """
    rows = numbered(reads.where(F.col(flag).bitwiseAND(UNMAPPED) == 0), place, "_i", ties)
    extra = F.col(flag).bitwiseAND(SUPPLEMENTARY) > 0
    alone = F.col(flag).isin(SUPPLEMENTARY, SUPPLEMENTARY | REVERSE)
    return rows.withColumn(name, F.when(extra, F.concat(F.col(name), F.lit("_r0x"), F.lower(F.hex("_i")))).otherwise(F.col(name))).withColumn(flag, F.when(alone, F.col(flag) - SUPPLEMENTARY).otherwise(F.col(flag))).drop("_i")


def cluster(tags: list[tuple[str, list[tuple[str, frozenset, bool]]]], most: int) -> list[tuple[str, list[str], list[str]]]:
    """(umi, transcripts, reads) of each molecule of one cell.

    tags: for each umi, in order of first sight, its reads as (name, transcripts, perfect). Umis with
    more reads come first, then those with a perfect read. Reads of a umi form one node if they
    share a transcript, else one node each. A node joins the earlier node at the least distance that
    shares a transcript; both keep what they share, and so does the head of that molecule. Reads without
    transcripts share the name NA, until two have met and not when their umi was split.

    Nodes are found through the substrings of their umi, held once a umi, and their transcripts: of most + 1 pieces of a tag one stays
    whole under ``most`` edits. A node's transcripts only shrink, so its first ones find it; what it has now decides.
    """
    tags = sorted(tags, key=lambda t: (-len(t[1]), not any(r[2] for r in t[1])))
    nodes: list[dict] = []
    at: dict[str, list[int]] = {}  # umis by substring
    own: list[dict[str, list[int]]] = [{} for _ in tags]  # of each umi, its nodes by transcript
    having: dict[str, list[int]] = {}  # nodes by transcript
    bounds_of = {n: [n * i // (most + 1) for i in range(most + 2)] for n in {len(umi) for umi, _ in tags}}
    sizes = {b - a for bounds in bounds_of.values() for a, b in zip(bounds[:-1], bounds[1:])}
    for place, (umi, _) in enumerate(tags):
        for spot in {umi[a : a + n] for n in sizes for a in range(len(umi) - n + 1)}:
            at.setdefault(spot, []).append(place)
    pieces_of = lambda umi: [umi[a:b] for a, b in zip(bounds_of[len(umi)][:-1], bounds_of[len(umi)][1:])]
    shared_parts = [same for same in (at[p] for p in {p for umi, _ in tags for p in pieces_of(umi)}) if len(same) > 1]
    meeting = set().union(*shared_parts)  # umis that find another or are found
    for place, (umi, reads) in enumerate(tags):
        parts, alone = pieces_of(umi), place not in meeting
        near = 0 if alone else sum(len(at[p]) for p in parts)
        named = [(n, t or frozenset(["NA"]), bool(t)) for n, t, _ in reads]
        common = named[0][1] if len(named) == 1 else frozenset.intersection(*[t for _, t, _ in named])
        pieces = [([n for n, _, _ in named], common, True)] if common else [([n], t, known) for n, t, known in sorted(named, key=lambda r: len(r[1]))]
        if alone and (common or len(frozenset.union(*[t for _, t, _ in named])) == sum(len(t) for _, t, _ in named)):
            nodes += [{"umi": umi, "trans": trans, "head": i, "all": names} for i, (names, trans, _) in enumerate(pieces, len(nodes))]
            continue
        for names, trans, open_ in pieces:
            best, parent, shared = len(umi), None, frozenset()
            found: set[int] = set()
            for t in trans if open_ else ():
                same = having.get(t, ())
                # The fewer of the two: nodes with the transcript, or umis with a piece.
                if len(same) <= near:
                    found.update([i for i in same if any(p in nodes[i]["umi"] for p in parts)])
                else:
                    found.update([i for p in parts for j in at[p] for i in own[j].get(t, ())])
            for i in sorted(found):
                other = nodes[i]
                both = trans & other["trans"]
                if not both or not other["open"]:
                    continue
                distance = 0 if other["place"] == place else search(umi, other["umi"], most)[0]
                if 0 <= distance < best:
                    best, parent, shared = distance, i, both
            node = {"umi": umi, "place": place, "reads": names, "trans": trans, "open": open_, "head": len(nodes), "all": list(names)}
            nodes.append(node)
            if open_:
                for t in trans:
                    having.setdefault(t, []).append(len(nodes) - 1)
                    own[place].setdefault(t, []).append(len(nodes) - 1)
            if parent is not None:
                node["trans"] = nodes[parent]["trans"] = shared
                head = nodes[parent]["head"]
                node["head"], nodes[head]["trans"] = head, shared
                nodes[head]["all"] += names
                node["open"] = nodes[parent]["open"] = nodes[head]["open"] = shared != {"NA"}
    return [(n["umi"], sorted(n["trans"]), n["all"]) for i, n in enumerate(nodes) if n["head"] == i]


#: Reads of a cell that cluster in one group, and tags of a cell that are held against one another in one task; larger cells are split.
SPLIT = 5000


def near_tags(tags: DataFrame, keys: list[str], umi: str = "umi", trans: str = "trans", most: int = 1, split: int = SPLIT) -> DataFrame:
    """keys, a, b: every two tags of a cell that clustering may hold against one another, a < b. tags: keys, umi, trans, a tag once.

    Within ``most`` edits, ends of the earlier tag being free, two tags of one length become equal when each loses up
    to ``most`` letters; tags that lose the same are joined, and so are, through pieces and substrings as in ``cluster``, those of another length than the
    commonest. Both must share a transcript; reads without any count as NA.

    Tags of one length are dealt by cell, and lose letters where they lie. A cell of over ``split`` tags is dealt by what its tags become,
    in as many parts as it holds ``split`` tags; a tag goes once to each part that it has a text in.
    """
    named = tags.select(*keys, F.col(umi).alias("u"), F.when(F.size(trans) > 0, F.col(trans)).otherwise(F.array(F.lit("NA"))).alias("t"), F.length(umi).alias("n"))
    lose = lambda c: F.flatten(F.transform(c, lambda x: F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.concat(F.substr(x, F.lit(1), i - 1), F.substr(x, i + 1)))))
    shorter = F.array("u")
    for _ in range(most):
        shorter = F.array_distinct(F.concat(shorter, lose(shorter)))
    pair = lambda left, right, more: left.alias("x").join(right.alias("y"), [F.col(f"x.{c}") == F.col(f"y.{c}") for c in [*keys, *more]])
    shared = F.arrays_overlap("x.t", "y.t")
    out = lambda df, at="": df.select(*(F.col(f"{at}{c}").alias(c) for c in keys), F.least("x.u", "y.u").alias("a"), F.greatest("x.u", "y.u").alias("b"))
    whole, at = named.where(" and ".join(["n > 0", *(f"{c} is not null" for c in keys)])), keys
    large = stored(whole.groupBy(*keys).agg(F.count("*").alias("_c")).where(F.col("_c") > split), "cells")
    if large.head(1):
        part = lambda k: F.pmod(F.xxhash64(k), F.col("_of"))
        of = F.coalesce(F.ceil(F.col("_c") / split), F.lit(1)).alias("_of")
        whole, at = whole.join(large, keys, "left").select(*named.columns, of).withColumn("_part", F.explode(F.array_distinct(F.transform(shorter, part)))), [*keys, "_part"]
        shorter = F.filter(shorter, lambda k: part(k) == F.col("_part"))
    lost = whole.repartition(tasks_for(whole, ROWS // 4), *at).withColumn("k", F.explode(shorter))
    # Tags that become one text: those with some letters more, so a group's size is bounded by the length and the letters.
    met = lost.groupBy(*at, "n", "k").agg(F.collect_list(F.struct("u", "t")).alias("_g")).where("size(_g) > 1")
    same = out(met.withColumn("x", F.explode("_g")).withColumn("y", F.explode("_g")).where(shared & (F.col("x.u") < F.col("y.u"))))
    lengths = named.groupBy("n").agg(F.count("*").alias("_c")).orderBy(F.desc("_c"), "n").take(2)
    if len(lengths) < 2:
        return same.distinct()
    usual = lengths[0]["n"]
    piece = lambda i: F.substr(F.col("u"), (F.floor(F.col("n") * i / (most + 1)) + 1).cast("int"), (F.floor(F.col("n") * (i + 1) / (most + 1)) - F.floor(F.col("n") * i / (most + 1))).cast("int"))
    pieces = named.withColumn("k", F.explode(F.array(*(piece(i) for i in range(most + 1)))))
    sizes = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(usual + 2)), lambda n: F.floor(n / (most + 1)).cast("int")))
    spots = named.withColumn("_m", F.explode(sizes)).where("_m <= n").withColumn("k", F.explode(F.transform(F.sequence(F.lit(1), F.col("n") - F.col("_m") + 1), lambda i: F.substr(F.col("u"), i, F.col("_m")))))
    odd, any_ = F.col("n") != usual, F.lit(True)
    others = [out(pair(pieces.where(l), spots.where(r), ["k"]).where(shared & (F.col("x.n") != F.col("y.n"))), "x.") for l, r in ((odd, any_), (any_, odd))]
    return same.unionByName(others[0]).unionByName(others[1]).distinct()


def parts_of(reads: DataFrame, keys: list[str], umi: str, trans: str, most: int, split: int) -> DataFrame:
    """reads with _part: a number within its cell, equal for tags that may meet in the clustering. Cells up to ``split`` reads have one part,
    and if all are such, rows stay where they are.

    Tags of different components never meet, so any union of components clusters as it does within the cell.
    """
    sizes = stored(reads.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > split), "cells")
    if not sizes.head(1):
        return reads.withColumn("_part", F.lit(0).cast("long"))
    node = lambda *c: F.xxhash64(*keys, *c)
    each = reads.join(sizes, keys, "left_semi").select(*keys, umi, F.explode_outer(trans).alias("_t")).distinct()
    tags = stored(each.groupBy(*keys, umi).agg(F.collect_list("_t").alias(trans)), "tags")
    roots = components(near_tags(tags, keys, umi, trans, most, split).select(node("a").alias("a"), node("b").alias("b")))
    part = F.when(F.col("_n").isNull(), 0).otherwise(F.pmod(F.coalesce("root", "_node"), F.ceil(F.col("_n") / split))).cast("long")
    return by_key(reads.withColumn("_node", node(umi)).join(sizes, keys, "left").join(roots.withColumnRenamed("node", "_node"), "_node", "left").select(*reads.columns, part.alias("_part")), *keys, "_part")


def molecules(reads: DataFrame, keys: list[str], umi: str = "umi", read: str = "qname", trans: str = "trans", perfect: str = "is_perfect", order: str = "pos", most: int = 1, split: int = SPLIT, dealt: bool = False) -> DataFrame:
    """keys, umi, trans, reads: the molecules of each cell (or cell and region, by ``keys``).

    Clustering is sequential within tags that may meet. Cells of over ``split`` reads are split into such parts, so that no cell
    gathers in one task; a task goes through its parts one by one, in the order of ``order``. dealt: reads are dealt by keys already,
    over tasks enough, and stay so; were they not, the numbering would deal them.
    """
    types = dict(reads.dtypes)

    def lists(column: pa.ListArray) -> list[list]:
        """Null lists are empty."""
        values, ends = column.values.to_pylist(), column.offsets.to_pylist()
        return [values[a:b] for a, b in zip(ends[:-1], ends[1:])]

    def settle(key: tuple, held: list[tuple]) -> tuple[tuple, list]:
        tags: dict[str, list] = {}
        for u, r, t, p in held:
            tags.setdefault(u, []).append((r, frozenset(t or ()), bool(p)))
        return key, cluster(list(tags.items()), most)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, done, n = None, [], [], 0

        def made() -> pa.RecordBatch:
            same = [pa.array([key[i] for key, found in done for _ in found], kinds[i]) for i in range(len(keys))]
            flat = [f for _, found in done for f in found]
            lists = [pa.array([f[j] for f in flat], pa.list_(pa.string())) for j in (1, 2)]
            return pa.record_batch([*same, pa.array([f[0] for f in flat], pa.string()), *lists], [*keys, "umi", "trans", "reads"])

        for batch in batches:
            kinds = [batch.schema.field(i).type for i in range(len(keys))]
            for row in zip(*(lists(c) if pa.types.is_list(c.type) else c.to_pylist() for c in batch.columns)):
                if row[len(keys)] == 1:  # a part begins
                    if held:
                        done.append(settle(now, held))
                        n += len(held)
                    now, held = row[: len(keys)], []
                    if n > 10_000:
                        yield made()
                        done, n = [], 0
                held.append(row[len(keys) + 1 :])
        if held:
            done.append(settle(now, held))
        if done:
            yield made()

    parts = parts_of(reads, keys, umi, trans, most, split)
    nth = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(order))
    rows = (parts if dealt else by_key(parts, *keys, "_part")).withColumn("_nth", nth).sortWithinPartitions(*keys, "_part", order)
    rows = rows.select(*keys, "_nth", umi, read, trans, perfect)
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys) + ", umi string, trans array<string>, reads array<string>"
    return rows.mapInArrow(run, schema)


def bc_umi_table(found: DataFrame, genes: DataFrame) -> DataFrame:
    """Molecules with genes: gene ids in the order of their transcripts, each once. genes: trans, gene.

    Each different list of transcripts is looked up once; molecules that are equal stay apart.
    """
    each = found.select("trans").distinct().select("trans", F.posexplode_outer("trans").alias("_i", "_t"))
    named = each.join(genes.select(F.col("trans").alias("_t"), F.col("gene").alias("_g")), "_t", "left")
    lists = named.groupBy("trans").agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("_i", F.coalesce("_g", F.lit("NA")).alias("_g")))), lambda x: x["_g"])).alias("genes"))
    return found.join(lists, "trans", "left").select(*found.columns, "genes")


def in_region(rows: DataFrame, spans: DataFrame, chrom, start: int | None = None, stop: int | None = None, trans: str = "trans") -> DataFrame:
    """Rows of which any transcript overlaps the region; spans: trans, chrom, start, stop (closed), region half-open.

    Each different list of transcripts is looked up once.
    """
    inside = spans.where(F.col("chrom") == chrom)
    if start is not None:
        inside = inside.where((F.col("start") <= stop) & (F.col("stop") >= start + 1))
    lists = rows.select(trans).distinct().select(trans, F.explode(trans).alias("_t"))
    hits = lists.join(inside.select(F.col("trans").alias("_t")).distinct(), "_t", "left_semi").select(trans).distinct()
    return rows.join(hits, trans, "left_semi").select(*rows.columns)


def match_summary(reads: DataFrame, perfect: str, exact: str) -> DataFrame:
    """Reads by whether their tag was perfect and their barcode matched exactly or with errors."""
    return reads.groupBy(F.when(F.col(perfect), "perfect").otherwise("imperfect").alias("tag"), F.when(F.col(exact), "exact").otherwise("corrected").alias("match")).agg(F.count("*").alias("n"))
