"""Registered queries of the corpus operators: each applies one operator to its whole table.

Keys are ``opN_<name>``; ``ORACLES`` holds SQL where SQL can express the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, mixing, neardup, packing, quality, repetition, resampling, runs, secrets, token_files, urls, vectors, warc
from tidemark.llm.common import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_embedding_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_digest(table(spark, sf_dir, "pages"), new_path(spark, "archives"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op6_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_rules(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.in_holdout(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-files")
    token_files.write_token_files(token_files.encode_texts(table(spark, sf_dir, "documents"), plain=False), path)
    return token_files.stream_digest(spark, path).select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op11_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.codec_digest(table(spark, sf_dir, "documents"))


def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("string").alias("text"))
    return runs.run_digest(docs.withColumn("text", runs.looped(F.col("text"), F.col("doc_id"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_source_mixture": op2_source_mixture,
    "op3_embedding_multi_index": op3_embedding_multi_index,
    "op4_warc_archives": op4_warc_archives,
    "op5_url_filter": op5_url_filter,
    "op6_repetition_rules": op6_repetition_rules,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_secret_scan": op9_secret_scan,
    "op10_token_files": op10_token_files,
    "op11_byte_level_bpe": op11_byte_level_bpe,
    "op12_target_resampling": op12_target_resampling,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {"op3_embedding_multi_index": vectors.ORACLE}
