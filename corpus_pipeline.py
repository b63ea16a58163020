"""A corpus pipeline of five stages: quality, near copies, repeated passages, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each as Parquet in
the shared folder and reads it again for the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm import mixing, packing, quality, simhash, suffix_dedup
from cellweave.llm.shared import free, numbered_names, stored

#: Near copies share this much of their sets of five-word shingles, at least.
SIMILARITY = 0.8


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules keep.

    Null, empty and blank texts go, as the base test fails them. Each row is judged alone: repeated rows and rows
    without a doc_id stay or go like others. Long texts are counted whole. An empty table gives none; other columns,
    of any name, pass through, as in all stages but the last.
    """
    return quality.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row: that of the smallest doc_id, null last, equal ones by place.

    Rows with a null or repeated doc_id are rows like any other: they go if a near copy stays. Null, empty and blank
    texts have no shingles and are copies of one another. Near copies have a Jaccard similarity of 0.8 at least; what
    is linked through others is one group. An empty table gives no rows.
    """
    row = free(docs, "row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = simhash.by_similarity(rows, shingle=5, row=row, **simhash.settings_for(SIMILARITY))
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    return rows.join(first.select(F.col("first.row").alias(row)), row, "left_semi").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that start anywhere else too.

    Every row stays, with n_chars counted anew; null texts become empty. Rows with null or repeated doc_ids are rows
    like any other: each is cut by its own text. Long texts are cut whole. An empty table gives no rows.
    """
    return suffix_dedup.strip_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it.

    Null sources are one source, the last. Texts without words have size 0 and take part in their source's order alone.
    Repeated rows and rows without a doc_id count each. An empty table gives no rows.
    """
    plain, names = numbered_names(docs)
    mixed = mixing.mix(plain.withColumn("size", mixing.n_words(names["text"])), doc_id=names["doc_id"], source=names["source"])
    return mixed.where("copies > 0").withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*plain.columns).toDF(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens.

    Null and empty texts give the end id alone; repeated rows are packed once each; a null doc_id stays null; an empty
    table gives no rows; other columns are left out.
    """
    return packing.pack(docs).drop("ids")


STAGES = [("quality rules", quality_rules), ("near copies", near_copies), ("repeated passages", repeated_passages), ("source mix", source_mix), ("packing", packed)]
#: Tokens and fingerprints have no SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
