"""Abundance of transcripts: expectation-maximisation, sparse matrices, expression by cluster."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .partitioning import by_key, stored, values_numbered

#: Rounds at most, and the change of all shares together below which it stops.
ROUNDS, TOLERANCE = 10_000, 1e-6


def fit(sets: list[list[int]], weights: np.ndarray, n: int, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> np.ndarray:
    """Share of each transcript in each set, from the last expectation: one row a set, n columns."""
    member = np.zeros((len(sets), n))
    for i, s in enumerate(sets):
        member[i, s] = 1
    share = np.full(n, 1 / n)
    for _ in range(rounds + 1):
        split = member * share
        split /= split.sum(axis=1, keepdims=True)
        new = weights @ split
        new /= new.sum()
        done = np.abs(new - share).sum() < tolerance
        share = new
        if done:
            break
    return split


def abundance(molecules: DataFrame, gene: str = "gene", cluster: str = "cluster", trans: str = "trans", extra: list[str] | None = None) -> DataFrame:
    """gene, cluster, trans, extra columns, abundance: molecules spread over their transcripts.

    molecules has an array of transcripts. Those with one set count together, so a task gets the
    different sets of a gene and cluster and not its molecules. Shares are fitted over all extra
    columns (haplotype, cell) together and reported for each. Transcripts of other clusters take
    part with equal first shares. Zeros are not reported.
    """
    extra = extra or []
    sets = molecules.withColumn("_set", F.array_sort(F.array_distinct(trans))).where(F.size("_set") > 0)
    counted = stored(sets.groupBy(gene, cluster, "_set", *extra).agg(F.count("*").alias("_n")), "sets")  # read three times
    names = counted.select(gene, F.explode("_set").alias("_t")).distinct().groupBy(gene).agg(F.array_sort(F.collect_list("_t")).alias("_names"))
    shared = counted.groupBy(gene, cluster, "_set").agg(F.sum("_n").alias("_n")).join(names, gene)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        labels = list(frame["_names"].iloc[0])
        place = {t: i for i, t in enumerate(labels)}
        split = fit([[place[t] for t in s] for s in frame["_set"]], frame["_n"].to_numpy(float), len(labels))
        rows = [(frame[gene].iloc[0], frame[cluster].iloc[0], s, t, split[i, place[t]]) for i, s in enumerate(frame["_set"]) for t in s]
        return pd.DataFrame(rows, columns=[gene, cluster, "_set", trans, "_share"])

    types = dict(molecules.dtypes)
    shares = by_key(shared, gene, cluster).groupBy(gene, cluster).applyInPandas(run, f"{gene} {types[gene]}, {cluster} {types[cluster]}, _set array<string>, {trans} string, _share double")
    spread = counted.join(shares, [gene, cluster, "_set"])
    return spread.groupBy(gene, cluster, trans, *extra).agg(F.sum(F.col("_n") * F.col("_share")).alias("abundance")).where("abundance > 0")


def sparse(rows: DataFrame, feature: str = "gene", cell: str = "bc", value: str = "value") -> DataFrame:
    """feature, cell and value with 1-based indices in the order of the names, numbered by ranges of names."""
    indexed = rows.join(values_numbered(rows, feature, "feature_idx"), feature).join(values_numbered(rows, cell, "cell_idx"), cell)
    return indexed.select("feature_idx", "cell_idx", feature, cell, value)


def _each_cell(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, _value, _some: each key once, so that it can be counted where it lies. Different values of an expression, as counted by Spark, are dealt anew."""
    return rows.groupBy(*keys).agg(F.sum(value).alias("_value"), F.max(F.col(value) > 0).alias("_some"))


def by_cluster(rows: DataFrame, sizes: DataFrame, feature: str = "gene", cluster: str = "cluster", cell: str = "bc", value: str = "value") -> DataFrame:
    """feature, cluster, total, cpm and pct: the share of the cluster's cells, also those without counts, that have the feature.

    rows: one value for each feature and cell; sizes: cluster, n_cells. Rows that are dealt by cell stay so until each task has summed its own.
    """
    each = _each_cell(rows, [feature, cluster, cell], value)
    sums = each.groupBy(feature, cluster).agg(F.sum("_value").alias("total"), F.count(F.when(F.col("_some"), F.col(cell))).alias("cells"))
    whole = F.sum("total").over(Window.partitionBy(cluster))
    return sums.join(sizes, cluster).select(feature, cluster, "total", F.when(whole > 0, 1e6 * F.col("total") / whole).otherwise(0.0).alias("cpm"), (F.col("cells") / F.col("n_cells")).alias("pct"))


def cell_qc(rows: DataFrame, feature: str = "gene", cell: str = "bc", value: str = "value", min_cells: int = 3, min_features: int = 200, most_marked: float = 25.0, marked: str = "^MT-") -> DataFrame:
    """cell, n_features, total, marked_pct of the cells that pass, over features in enough cells.

    The names of these features are broadcast: dealt by feature, the values of a common one would meet in one task. An inner join, as a
    semi-join would move below the sums, and rows that are joined before would be joined twice.
    """
    each = _each_cell(rows, [cell, feature], value)
    common = each.where("_some").groupBy(feature).agg(F.count(cell).alias("_n")).where(F.col("_n") >= min_cells).select(feature)
    sums = each.join(F.broadcast(common), feature).groupBy(cell).agg(
        F.count(F.when(F.col("_some"), F.col(feature))).alias("n_features"),
        F.sum("_value").alias("total"),
        F.sum(F.when(F.col(feature).rlike(marked), F.col("_value")).otherwise(0)).alias("_marked"),
    )
    return sums.select(cell, "n_features", "total", F.expr("100D * _marked / nullif(total, 0)").alias("marked_pct")).where((F.col("n_features") >= min_features) & (F.col("marked_pct") < most_marked))


def log_normalized(rows: DataFrame, cell: str = "bc", value: str = "value", scale: float = 1e4) -> DataFrame:
    total = F.sum(value).over(Window.partitionBy(cell))
    return rows.withColumn("normalized", F.log1p(scale * F.col(value) / total))
