"""Operator 10: token ids in Parquet list columns, with chosen encodings, row groups and page indexes.

A file set holds ``key``, ``shard``, ``start_in_shard``, ``n_tokens`` and the list ``ids``. Shards follow each other in
ascending key order, so the place of any document in the whole stream is its shard's start plus its start there.
Metadata can be read without the ids (column pruning), and single documents without the others (row groups and pages
are skipped by the key's statistics, as rows are in key order).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage, text_slices
from tidemark.llm.tokens import default_tokenizer, encoder

ENCODINGS = ("dictionary", "delta")
META = ["key", "shard", "start_in_shard", "n_tokens"]


def encode_texts(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, key: str = "doc_id", text: str = "text", plain: bool = True) -> DataFrame:
    """One row per document, in ascending key order over shards: key, shard, start_in_shard, n_tokens, ids.

    ``end_id`` ends every document. A null text is empty and has the end id alone; null keys come first; rows with equal
    keys are all kept, in the order of their texts' hashes, and may be dealt to several shards. Other columns are ignored. ``plain`` reads the strings of
    special tokens as ordinary text; otherwise each gets its one id, as the tokenizer gives it.
    """
    path = tokenizer or default_tokenizer()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at, shard = encoder(path, plain), 0, TaskContext.get().partitionId()
        for batch in batches:
            for part in text_slices(batch):
                ids, size = own.encode(part.column("text"))
                ends = np.cumsum(size + 1)
                full = np.empty(len(ids) + len(size), np.int32)
                full[ends - 1] = end_id
                full[np.repeat(np.arange(len(size)), size) + np.arange(len(ids))] = ids
                offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(np.full(len(size), shard, np.int32)), pa.array(at + ends - size - 1), pa.array(size + 1), pa.ListArray.from_arrays(offsets, pa.array(full))],
                    names=[*META, "ids"],
                )
                at += int(ends[-1])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).withColumn("h", F.xxhash64("text"))
    return rows.repartitionByRange("key", "h").sortWithinPartitions("key", "h").mapInArrow(encode, "key long, shard int, start_in_shard long, n_tokens long, ids array<int>")


def write_token_files(tokens: DataFrame, path: str, encoding: str = "dictionary", row_group_mb: int = 32, page_rows: int = 2000) -> None:
    """Writes encoded documents. ``dictionary``: ids are indexes into a dictionary page; ``delta``: bit-packed differences.

    Row groups hold about ``row_group_mb``, pages at most ``page_rows`` documents, and every column has page indexes.
    """
    if encoding not in ENCODINGS:
        raise ValueError(f"encoding must be one of {ENCODINGS}")
    writer = tokens.write.option("parquet.block.size", row_group_mb << 20).option("parquet.page.row.count.limit", page_rows)
    if encoding == "delta":
        writer = writer.option("parquet.writer.version", "PARQUET_2_0").option("parquet.enable.dictionary", "false")
    writer.parquet(path)


def read_tokens(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """Documents with their ids; ``where`` on the key reaches the files as a pushed filter."""
    files = spark.read.schema("key long, shard int, start_in_shard long, n_tokens long, ids array<int>").parquet(path)
    return files if where is None else files.where(where)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Everything but the ids, which are not read."""
    return read_tokens(spark, path).select(*META)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each shard, from the metadata; one row per shard."""
    totals = read_metadata(spark, path).groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    return totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start"))


def stream_digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: key, start (ids of all documents before it), n_tokens, ids_crc32."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            raw = memoryview(np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")).tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("shard"), batch.column("start_in_shard"), pa.array(np.diff(ends)), pa.array(crc, pa.int64())], names=["key", "shard", "start_in_shard", "n_tokens", "ids_crc32"])

    rows = read_tokens(spark, path).mapInArrow(digest, "key long, shard int, start_in_shard long, n_tokens long, ids_crc32 long")
    starts = stage(shard_starts(spark, path), "shard-starts")
    return rows.join(starts, "shard").select("key", (F.col("shard_start") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids_crc32")
