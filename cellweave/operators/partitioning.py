"""How rows are dealt to Python functions that work on groups."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_key(rows: DataFrame, *keys: str) -> DataFrame:
    """rows dealt by keys over all shuffle partitions. Adaptive planning would merge small ones into
    few tasks, by bytes; groups that Python works on cost time, not bytes."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


#: Rows of a task, where rows are dealt by a key.
ROWS = 200_000


def tasks_for(rows: DataFrame, each: int = ROWS) -> int:
    """Tasks for rows that are dealt by a key: one for ``each`` rows and one a core at least, so that a task's share does not grow with the
    rows. Adaptive planning deals by compressed bytes, of which a task's limit holds millions of rows."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // each))


def dealt_join(left: DataFrame, right: DataFrame, one: str, two: str, tasks: int) -> DataFrame:
    """left ⋈ right on one = two, both dealt over ``tasks``; the result stays dealt by ``one``, which later groups and windows that hold it need not repeat."""
    return left.repartition(tasks, one).join(right.repartition(tasks, two), F.col(one) == F.col(two))


def part_of(rows: DataFrame, column: str) -> Column:
    """A coarse key in the order of the column: the first letters of a text, or the high part of a number."""
    return F.substring(column, 1, 6) if dict(rows.dtypes)[column] == "string" else F.floor(F.col(column) / 4096)


def ranged(rows: DataFrame, *order: str) -> DataFrame:
    """rows, stored, with _part: they are dealt by ranges of ``order``, and parts rise with it; rows that are equal in it share a part."""
    return stored(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")


def before(parts: DataFrame, value: str, name: str) -> DataFrame:
    """_part, and the sum of ``value`` over the parts before it; parts: a row for each, of which there are as many as tasks."""
    return parts.select("_part", F.coalesce(F.sum(value).over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(name))


def values_numbered(rows: DataFrame, column: str, name: str) -> DataFrame:
    """column, name: the different values with their number from 1, in order; each part of a range is numbered by itself, behind those before it."""
    values = ranged(rows.select(column).distinct(), column)
    sizes = before(values.groupBy("_part").agg(F.count("*").alias("_n")), "_n", "_before")
    nth = F.row_number().over(Window.partitionBy("_part").orderBy(column))
    return values.withColumn("_nth", nth).join(sizes, "_part").select(column, (F.col("_before") + F.col("_nth")).cast("int").alias(name))


def numbered(rows: DataFrame, place: str, name: str, ties: list[str] | None = None, span: int = 1 << 16) -> DataFrame:
    """rows with their number from 0 in the order of a whole number ``place``, then of ``ties``.

    Rows are counted by stretches of ``span`` places; the sums of these counts place each stretch, and
    rows are numbered within theirs alone, so no task sorts them all.
    """
    dealt = rows.withColumn("_part", F.floor(F.col(place) / span))
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    nth = F.row_number().over(Window.partitionBy("_part").orderBy(place, *(ties or []))) - 1
    return dealt.withColumn("_nth", nth).join(before, "_part").withColumn(name, F.col("_before") + F.col("_nth")).select(*rows.columns, name)


def stored(rows: DataFrame, name: str) -> DataFrame:
    """rows, written once below ``spark.checkpoint.dir`` and read again: cuts lineage and survives lost executors.

    Where the setting is missing and all runs on one machine, as in tests, a temporary folder is set.
    """
    spark = rows.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='cellweave-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """node, root of every node of the edges (a, b: whole numbers); root is the least node of its component.

    Each round gives a node the least root among its neighbours' and then the root of that root; roots are
    least values of partial aggregates, so a node with many neighbours gathers in no task.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    found = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"), "roots")
    while True:
        near = both.join(found.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("_near"))
        step = found.join(near, found["node"] == near["a"]).select("node", F.col("root").alias("_old"), F.least("root", "_near").alias("_next"))
        above = found.select(F.col("node").alias("_next"), F.col("root").alias("_above"))
        moved = step.join(above, "_next").select("node", F.least("_next", "_above").alias("root"), (F.least("_next", "_above") < F.col("_old")).alias("_moved"))
        moved = stored(moved, "roots")
        found = moved.drop("_moved")
        if not moved.where("_moved").head(1):
            return found
