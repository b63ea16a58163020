"""Reads as they arrive: the same tables from a folder that files are added to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import READ_FIELDS


def read_stream(spark: SparkSession, folder: str, files_a_trigger: int = 16) -> DataFrame:
    """Reads with tags from every TSV file that is added to folder."""
    rows = spark.readStream.option("sep", "\t").option("comment", "#").option("maxFilesPerTrigger", files_a_trigger).schema(READ_FIELDS).csv(folder)
    return rows.withColumn("is_perfect", F.col("is_perfect") == "1")


def running_counts(reads: DataFrame, bc_len: int = 16, umi_len: int = 12) -> DataFrame:
    """bc, umi_count of perfect reads so far; the state is one row a barcode and molecule tag."""
    perfect = reads.where(F.col("is_perfect") & (F.length("bc") == bc_len) & (F.length("umi") == umi_len))
    return perfect.dropDuplicates(["bc", "umi"]).groupBy("bc").agg(F.count("*").alias("umi_count"))
