"""A corpus pipeline of five stages: quality, near-duplicates, secrets, mixture, packing.

Each stage takes the documents that its predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, neardup, packing, quality, secrets
from tidemark.llm.common import new_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more; it learns from the labels of the documents it is given."""
    weights = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs.select(*COLUMNS), weights).where("score >= 0.5").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id."""
    return neardup.without_near_duplicates(docs.select(*COLUMNS))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets replaced by their kind."""
    scanned = secrets.scan(docs.select(*COLUMNS), into="_spans")
    text = secrets.redacted(F.col("text"), F.col("_spans"))
    found = F.size("_spans") > 0
    return scanned.withColumn("_clean", text).select("doc_id", F.col("_clean").alias("text"), "lang", "source", F.when(found, F.length("_clean").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose sources, languages and topics have more even shares of the words."""
    return mixing.sampled_documents(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 1024 tokens."""
    return packing.pack_documents(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_quality),
    ("near-duplicates", drop_near_duplicates),
    ("secret scan", redact_secrets),
    ("mixture", mix_sources),
    ("packing", pack_sequences),
]

#: Hashing, training and local search are not expressible in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to ``documents``; each stage's result is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        path = new_path(spark, name.replace(" ", "-"))
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
