"""The test tables seen as reads of a single-cell experiment, in Spark and as SQL.

bc: the customer; umi: the order; gene: the brand; trans: brand and type, with a planted cell-type signal (one
cluster has SMALL for most of LARGE in some genes); hap: from the line's status, with a planted allele signal;
cluster: the market segment; chrom, start, stop: the part and the days of shipping. Every line is a read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.partitioning import dealt_join, tasks_for


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dealt by bc, over as many tasks as the lines need."""
    lines, orders, cells, parts = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "part"))
    tasks = tasks_for(lines)
    rows = dealt_join(lines, parts, "l_partkey", "p_partkey", tasks)
    rows = dealt_join(dealt_join(rows, orders, "l_orderkey", "o_orderkey", tasks), cells, "o_custkey", "c_custkey", tasks)
    start = F.datediff(F.to_date("l_shipdate"), F.lit("1992-01-01").cast("date"))
    return rows.select(
        F.col("o_custkey").alias("bc"),
        F.col("l_orderkey").alias("umi"),
        F.col("c_mktsegment").alias("cluster"),
        F.col("p_brand").alias("gene"),
        F.expr("concat(p_brand, ':', if(c_mktsegment = 'BUILDING' and p_brand like '%2' and p_type = 'LARGE' and l_linenumber <= 5, 'SMALL', p_type))").alias("trans"),
        F.expr("case when l_linenumber = 7 then 'none' when p_brand like '%1' and p_type = 'SMALL' then 'H1' when l_linestatus = 'O' then 'H1' else 'H2' end").alias("hap"),
        F.col("l_partkey").alias("chrom"),
        start.cast("long").alias("start"),
        (start + F.col("l_quantity")).cast("long").alias("stop"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("quantity"),
    )


READS = """reads AS (
  SELECT o_custkey AS bc, l_orderkey AS umi, c_mktsegment AS cluster, p_brand AS gene,
    p_brand || ':' || CASE WHEN c_mktsegment = 'BUILDING' AND p_brand LIKE '%2' AND p_type = 'LARGE' AND l_linenumber <= 5 THEN 'SMALL' ELSE p_type END AS trans,
    CASE WHEN l_linenumber = 7 THEN 'none' WHEN p_brand LIKE '%1' AND p_type = 'SMALL' THEN 'H1' WHEN l_linestatus = 'O' THEN 'H1' ELSE 'H2' END AS hap,
    l_partkey AS chrom, date_diff('day', DATE '1992-01-01', l_shipdate::DATE)::BIGINT AS start,
    (date_diff('day', DATE '1992-01-01', l_shipdate::DATE) + l_quantity)::BIGINT AS stop, l_linenumber AS line, l_quantity AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
)"""


def sequence(key: str, length: int) -> str:
    """Spark SQL: the low digits of a whole number in base 4 as letters, after a mixing product."""
    return f"array_join(transform(sequence(0, {length - 1}), i -> substr('ACGT', cast(1 + (shiftright(pmod(({key}) * 2654435761, {4**length}), cast(2 * i as int)) & 3) as int), 1)), '')"


def sequence_sql(key: str, length: int) -> str:
    return f"array_to_string(list_transform(range(0, {length}), lambda i: substr('ACGT', 1 + (((({key}) * 2654435761 % {4**length})::BIGINT >> (2 * i)::BIGINT) & 3)::BIGINT, 1)), '')"
