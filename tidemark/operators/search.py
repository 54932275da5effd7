"""Substring search over many elements by trigram postings, with the rows that a scan of all texts gives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.shared import written

FIELDS = ("short_code", "name", "description")
GRAM = 3
#: Parts that the elements are dealt to by their id; a search reads those that hold candidates.
BLOCKS = 64


def grams(text: Column) -> Column:
    """The distinct runs of three characters of a lower-cased text; none for shorter ones."""
    low = F.lower(text)
    starts = F.sequence(F.lit(1), F.length(low) - (GRAM - 1))
    return F.when(F.length(low) >= GRAM, F.array_distinct(F.transform(starts, lambda i: F.substr(low, i, F.lit(GRAM)))))


def write_search_index(elements: DataFrame, path: str, blocks: int = BLOCKS) -> None:
    """Writes elements (element, id, short_code, name, description) in blocks, and for each trigram who holds it.

    Postings (gram, element, block, id) are in the order of their grams, so a search reads a few row groups of them. A
    trigram counts within one field; null fields have none; rows that repeat are kept and have one posting.
    """
    dealt = elements.select("element", "id", *FIELDS, F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"))
    dealt.repartition("element", "block").write.partitionBy("element", "block").parquet(f"{path}/elements")
    each = F.explode(F.array_distinct(F.flatten(F.array_compact(F.array(*(grams(F.col(c)) for c in FIELDS)))))).alias("gram")
    postings = dealt.select(each, "element", "block", "id").distinct()
    postings.repartitionByRange("gram", "element", "block").sortWithinPartitions("gram", "element", "block").write.parquet(f"{path}/postings")


def candidates(spark: SparkSession, path: str, text: str) -> DataFrame | None:
    """Rows (element, block, id) that hold all trigrams of a text, or None where it is too short to have any."""
    low = text.lower()
    wanted = sorted({low[k : k + GRAM] for k in range(len(low) - GRAM + 1)})
    if not wanted:
        return None
    postings = spark.read.schema("gram string, element string, block int, id long").parquet(f"{path}/postings")
    held = postings.where(F.col("gram").isin(wanted)).groupBy("element", "block", "id").agg(F.count("*").alias("_n"))
    return held.where(F.col("_n") == len(wanted)).drop("_n")


def search_indexed(spark: SparkSession, path: str, text: str, limit: int) -> DataFrame:
    """Elements whose code, name or description holds the text, without case; of each kind up to half the limit.

    Postings are intersected first; the texts of candidates alone are verified, and only blocks with candidates are read.
    A text of under three characters has no trigram, so all texts are read for it.
    """
    low = F.lit(text.lower())
    rows = spark.read.schema("id long, short_code string, name string, description string, element string, block int").parquet(f"{path}/elements")
    found = candidates(spark, path, text)
    if found is not None:
        found = written(found, "candidates")
        blocks = [r.block for r in found.select("block").distinct().collect()]  # at most as many as there are blocks
        rows = rows.where(F.col("block").isin(blocks)).join(found, ["element", "block", "id"], "left_semi")
    hit = F.contains(F.lower("short_code"), low) | F.contains(F.lower("name"), low) | F.contains(F.lower("description"), low)
    hits = rows.where(hit).select("element", "id", *FIELDS)
    first = lambda kind: hits.where(F.col("element") == kind).orderBy("short_code", "id").limit(limit // 2)
    return first("node").unionByName(first("arc"))
