"""Shared pieces: the folder all executors see, written stages, and arrays of words from Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
SLICE_BYTES = 2 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; on one machine (a local master) a temporary one where that is unset."""
    found = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError(f"set {SETTING} to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set(SETTING, found)
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes a result to the shared folder and reads it again.

    This cuts the lineage, gives the planner a known size, and a lost executor costs nothing that was written.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch, without copying, into runs of rows that hold about ``most`` bytes of text.

    A single longer text is a slice of its own, whole.
    """
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(size) - size) // most
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def filled(texts: pa.Array) -> pa.Array:
    """Null texts become empty; the type allows more than 2 GB."""
    return pc.fill_null(texts.cast(pa.large_string()), "")


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words (runs without ASCII white space) of each text: codes into the distinct words, those words, words per text."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    flat = lists.flatten()
    count = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    blank = pc.index(coded.dictionary, "").as_py()
    if blank >= 0:
        keep = codes != blank
        count = segment_sum(keep.astype(np.int64), count)
        codes = codes[keep]
    return codes, coded.dictionary, count


def hashed(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each distinct word, the same in every process."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False)


def segment_sum(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sum of each run of ``count`` values; 0 for an empty run."""
    ends = np.concatenate([[0], np.cumsum(values)])
    at = np.concatenate([[0], np.cumsum(count)])
    return ends[at[1:]] - ends[at[:-1]]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit integers (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
