"""The registered queries of the corpus operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import divergence, language, media, mixing, packing, phrases, quality, simhash, substring, suffix_dedup, token_files, urls, warc
from .shared import stored


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", F.col("n").alias("n_bytes"), "n_removed", "n_spans", "kept_sha256")


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digest(media.media_table(documents(spark, sf_dir)))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(documents(spark, sf_dir))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(documents(spark, sf_dir), shingle=3, lanes=1, radius=3)
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", F.col("n").alias("n_words"), "n_removed", "kept_sha256")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", mixing.n_words("text").alias("size"))
    mixed = mixing.mix(stored(docs, "sizes"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(pages(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir)).drop("ids")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.table(documents(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(pages(spark, sf_dir).select("page_id", "url")).drop("url")


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_media_columns, op3_token_files, op4_simhash, op5_substring_dedup, op6_mixing, op7_warc, op8_packing, op9_quality, op10_url_rules,
        op11_language_id, op12_phrases, op13_divergence,
    )
}
ORACLE_SQL = {"op1_suffix_dedup": suffix_dedup.SQL, "op5_substring_dedup": substring.SQL, "op6_mixing": mixing.SQL, "op7_warc": warc.SQL, "op9_quality": quality.sql(), "op10_url_rules": urls.SQL, "op12_phrases": phrases.SQL, "op13_divergence": divergence.SQL}
