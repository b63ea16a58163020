"""Tests of independence and proportion: native statistics, p-values where Spark has no function."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..operators.partitioning import before, ranged, stored

#: ln k! for small k; beyond, Stirling's series is as exact as a double.
EXACT = 256
LN_FACTORIAL = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, EXACT)))])


def ln_factorial(k: np.ndarray) -> np.ndarray:
    k = np.asarray(k, float)
    x = np.maximum(k, 1) + 1
    series = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return np.where(k < EXACT, LN_FACTORIAL[np.minimum(k, EXACT - 1).astype(int)], series)


def chi2_tails(statistic: np.ndarray, df: int) -> np.ndarray:
    """Upper tails of the chi-square distribution; closed sums for whole degrees of freedom, each term by its logarithm."""
    half = np.asarray(statistic, float) / 2
    if df < 1:
        return np.full(half.shape, np.nan)
    if df % 2:
        head, steps = np.array([math.erfc(math.sqrt(h)) if h >= 0 else math.nan for h in half]), np.arange(1, (df + 1) // 2) - 0.5
        ln = math.log(math.pi) / 2 + np.cumsum(np.log(steps))
    else:
        head, steps = np.zeros(len(half)), np.arange(df // 2, dtype=float)
        ln = ln_factorial(steps)
    with np.errstate(divide="ignore", invalid="ignore"):
        powers = np.where(steps == 0, 0.0, steps * np.log(half)[:, None])
        tail = head + np.exp(powers - half[:, None] - ln).sum(axis=1)
    return np.where(np.isnan(half), np.nan, np.minimum(1.0, tail))


def chi2_tail(statistic: float, df: int) -> float:
    return float(chi2_tails(np.array([statistic]), df)[0])


def fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    """All tables with these margins that are at most as likely as this one, within one part in ten million."""
    row, column, total = a + b, a + c, a + b + c + d
    k = np.arange(max(0, row + column - total), min(row, column) + 1)
    ln = -(ln_factorial(k) + ln_factorial(row - k) + ln_factorial(column - k) + ln_factorial(total - row - column + k))
    p = np.exp(ln - ln.max())
    return float(min(1.0, p[p <= p[a - k[0]] * (1 + 1e-7)].sum() / p.sum()))


def binomial_tail(x: int, n: int) -> float:
    """P(X >= x) for n fair trials."""
    k = np.arange(x, n + 1)
    return float(min(1.0, np.exp(ln_factorial(np.array(n)) - ln_factorial(k) - ln_factorial(n - k) - n * math.log(2)).sum()))


def each_once(f, *columns: pd.Series) -> pd.Series:
    """f of whole numbers, for each different row of a batch once; null where a number is missing."""
    table = np.column_stack([np.asarray(c, float) for c in columns])
    known = ~np.isnan(table).any(axis=1)
    rows, place = np.unique(np.trunc(table[known]).astype(np.int64), axis=0, return_inverse=True)
    out = np.full(len(table), np.nan)
    out[known] = np.array([f(*r) for r in rows.tolist()], float)[place.ravel()]
    return pd.Series(out)


@F.pandas_udf(DoubleType())
def chi2_p(statistic: pd.Series, df: pd.Series) -> pd.Series:
    """Null where statistic or df is missing or not a number."""
    values, degrees = np.asarray(statistic, float), np.asarray(df, float)
    out = np.full(len(values), np.nan)
    for d in np.unique(degrees[~np.isnan(degrees)]):
        out[degrees == d] = chi2_tails(values[degrees == d], int(d))
    return pd.Series(out)


@F.pandas_udf(DoubleType())
def fisher_p(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    """Counts are truncated to whole numbers; null where one is missing."""
    return each_once(fisher_two_sided, a, b, c, d)


@F.pandas_udf(DoubleType())
def binomial_p(x: pd.Series, n: pd.Series) -> pd.Series:
    """Null where a number is missing."""
    return each_once(binomial_tail, x, n)


def chi2(rows: DataFrame, keys: list[str], item: str, left: str, right: str) -> DataFrame:
    """keys, statistic, df, delta of a 2 x k table: one row of rows per item with its two counts.

    Counts are truncated for the statistic and not for delta, the largest difference of the two
    shares. Yates' correction holds for 2 x 2 tables, by at most |O - E|. NaN where a margin is 0.
    """
    by = Window.partitionBy(*keys)
    table = rows.select(*keys, item, F.col(left).cast("double").alias("_l"), F.col(right).cast("double").alias("_r")).withColumns({"_a": F.floor("_l").cast("double"), "_b": F.floor("_r").cast("double")})
    table = table.withColumns({"_k": F.count("*").over(by), "_sa": F.sum("_a").over(by), "_sb": F.sum("_b").over(by), "_sl": F.sum("_l").over(by), "_sr": F.sum("_r").over(by)})
    table = table.withColumns({"_ea": F.expr("_sa * (_a + _b) / nullif(_sa + _sb, 0)"), "_eb": F.expr("_sb * (_a + _b) / nullif(_sa + _sb, 0)")})
    yates = F.when(F.col("_k") == 2, F.least(F.lit(0.5), F.abs(F.col("_a") - F.col("_ea")))).otherwise(0.0)
    table = table.withColumn("_y", yates).withColumn("_term", F.expr("pow(abs(_a - _ea) - _y, 2) / nullif(_ea, 0) + pow(abs(_b - _eb) - _y, 2) / nullif(_eb, 0)"))
    out = table.groupBy(*keys).agg(
        F.when(F.count("_term") == F.count("*"), F.sum("_term")).otherwise(F.lit(float("nan"))).alias("statistic"),
        (F.count("*") - 1).cast("long").alias("df"),
        F.max(F.expr("abs(_l / nullif(_sl, 0) - _r / nullif(_sr, 0))")).alias("delta"),
    )
    return out


def bh(rows: DataFrame, p: str, keys: list[str], order: list[str], name: str = "fdr") -> DataFrame:
    """rows with Benjamini-Hochberg values within keys; NaN and null p stay out and get NaN.

    The values of one scope of keys are sorted in one task: there is one for each gene and cluster. Without keys all rows are
    one scope, of any size: they are stored, as they are read more than once, and see ``bh_whole``.
    """
    rows = rows if keys else stored(rows, "tested")
    good = rows.where(F.col(p).isNotNull() & ~F.isnan(p))
    rest = rows.where(F.col(p).isNull() | F.isnan(p)).withColumn(name, F.lit(float("nan")))
    if not keys:
        return good.join(bh_whole(good, p, name), p).select(*rows.columns, name).unionByName(rest)
    by = Window.partitionBy(*keys)
    rising = by.orderBy(p, *order)
    raw = good.withColumn("_q", F.col(p) * F.count("*").over(by) / F.row_number().over(rising))
    fixed = raw.withColumn(name, F.least(F.lit(1.0), F.min("_q").over(rising.rowsBetween(0, Window.unboundedFollowing)))).drop("_q")
    return fixed.unionByName(rest)


def bh_whole(rows: DataFrame, p: str, name: str) -> DataFrame:
    """p, name: the value of each different p over all rows, by ranges of p.

    A value's rank is the number of rows up to it: a sum within its range behind the totals of those before. The least
    quotient from a value on is that within its range, or of a later range's least. Only totals of ranges meet in a task.
    """
    counts = ranged(rows.groupBy(p).agg(F.count("*").alias("_n")), p)
    parts = counts.groupBy("_part").agg(F.sum("_n").alias("_n"))
    total = F.sum("_n").over(Window.partitionBy(F.lit(0)))
    parts = before(parts, "_n", "_before").join(parts.select("_part", total.alias("_all")), "_part")
    up = Window.partitionBy("_part").orderBy(p)
    ranks = counts.withColumn("_up", F.sum("_n").over(up.rowsBetween(Window.unboundedPreceding, 0))).join(parts, "_part")
    raw = ranks.select("_part", p, (F.col(p) * F.col("_all") / (F.col("_before") + F.col("_up"))).alias("_q"))
    later = Window.orderBy("_part").rowsBetween(1, Window.unboundedFollowing)
    least = raw.groupBy("_part").agg(F.min("_q").alias("_q")).select("_part", F.min("_q").over(later).alias("_later"))
    here = F.min("_q").over(up.rowsBetween(0, Window.unboundedFollowing))
    return raw.withColumn("_here", here).join(least, "_part").select(p, F.least(F.lit(1.0), "_here", "_later").alias(name))


def ln_factorial_sql(x: str) -> str:
    return f"lgamma(({x}) + 1)"


