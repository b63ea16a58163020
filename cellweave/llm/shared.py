"""Helpers that several corpus operators share: scratch tables, ordered offsets, components.

Scratch tables live under ``spark.checkpoint.dir`` (the one folder that the driver and every
executor share), so no step depends on an executor that may be lost.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text that one numpy step handles at a time; keeps temporaries inside the cache and bounded.
SLICE_BYTES = 1 << 19


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; a local one only where none is set and all runs on one machine (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='cellweave-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written once to the shared folder and read back: cuts lineage, survives executors."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def need(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")


def numbered_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """df with columns c0, c1, ... that no helper's name meets, and the new name of each old one; ``toDF(*df.columns)`` undoes it."""
    names = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), dict(zip(df.columns, names))


def free(df: DataFrame, name: str) -> str:
    """A name like this that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def set_aside(df: DataFrame, *made: str) -> tuple[DataFrame, dict[str, str]]:
    """df, in which columns that are called like a result to be made have underscores in front instead, and the name that each column has now."""
    results = {m.lower() for m in made}
    taken = results | {c.lower() for c in df.columns}
    names = {c: c for c in df.columns}
    for c in df.columns:
        while names[c].lower() in results or (names[c] != c and names[c].lower() in taken):
            names[c] = f"_{names[c]}"
        taken.add(names[c].lower())
    return (df if all(a == b for a, b in names.items()) else df.toDF(*names.values())), names


def give_back() -> None:
    """Returns freed memory to the system: Python workers idle on beside the next stage's JVM work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], text: int = 1, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the text of each holds about ``limit`` bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)
    give_back()


def salted_join(many: DataFrame, few: DataFrame, key: str, salt_of: str, how: str = "inner", salts: int = 16) -> DataFrame:
    """many ⋈ few on key, each key of many dealt over ``salts`` tasks by the column salt_of."""
    left = many.withColumn("_salt", F.pmod(F.xxhash64(salt_of), F.lit(salts)))
    right = few.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return left.join(right, [key, "_salt"], how).drop("_salt")


#: Rows of one key beyond this share of all are dealt over HOT_SALTS tasks; at most that many keys have so many.
HOT_SHARE, HOT_SALTS = 2048, 32


def hot_keys(counts: DataFrame, key: str, n: str = "n") -> DataFrame:
    """The keys of a stored table (key, n) that hold over 1 in HOT_SHARE of all rows: HOT_SHARE rows at most, broadcast."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    return F.broadcast(counts.where(F.col(n) > total / HOT_SHARE).select(key, F.lit(True).alias("hot")))


def hot_join(many: DataFrame, few: DataFrame, keys: list[str], salt_of: list[str], how: str = "inner") -> DataFrame:
    """many ⋈ few on keys; both have a column ``hot``, and hot rows of many are dealt over HOT_SALTS tasks. Keeps many's ``hot``."""
    left = many.withColumn("_salt", F.when(F.col("hot"), F.pmod(F.xxhash64(*salt_of), F.lit(HOT_SALTS))).otherwise(0).cast("int"))
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(HOT_SALTS - 1))).otherwise(F.array(F.lit(0)))
    return left.join(few.withColumn("_salt", F.explode(salts)).drop("hot"), [*keys, "_salt"], how).drop("_salt")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node of its component.

    Contraction: every node hooks to its smallest neighbour (a partial aggregate, so hubs do not
    gather in a task), the hooks are followed to their end by pointer doubling, and the edges are
    rewritten between the ends, until none is left. Each round is a stored table. Null ends and
    loops are ignored; no edges give no rows.
    """
    edges = stored(
        edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a is not null and b is not null and a <> b").distinct(),
        "edges",
    )
    found = None
    while edges.head(1):
        both = edges.union(edges.select("b", "a").toDF("a", "b"))
        hooks = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root"))
        hooks = stored(hooks, "hooks")
        while True:
            step = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            hooks = stored(hooks.join(step, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "hooks")
            moved = hooks.where("moved").head(1)
            hooks = hooks.drop("moved")
            if not moved:
                break
        ends = hooks.select(F.col("node"), F.col("root").alias("end"))
        if found is None:
            found = hooks
        else:
            found = found.join(ends.select(F.col("node").alias("root"), "end"), "root", "left").select("node", F.coalesce("end", "root").alias("root"))
        edges = edges.join(ends.select(F.col("node").alias("a"), F.col("end").alias("a2")), "a").join(ends.select(F.col("node").alias("b"), F.col("end").alias("b2")), "b")
        edges = stored(edges.select(F.col("a2").alias("a"), F.col("b2").alias("b")).where("a <> b").distinct(), "edges")
    if found is None:
        return edges.sparkSession.createDataFrame([], "node long, root long")
    return stored(found, "components")
