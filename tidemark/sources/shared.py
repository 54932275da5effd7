"""A folder that driver and executors share, for files between steps, and row numbers over whole tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; on one machine (a local master) a temporary one where that is unset."""
    setting = "spark.checkpoint.dir"
    base = spark.conf.get(setting, None) or spark.sparkContext.getConf().get(setting)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {setting} to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set(setting, base)
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


_run: ContextVar[str | None] = ContextVar("run", default=None)


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for all that is written between steps in this block; it is deleted at its end.

    Results of steps are lazy and read those files, so they must be written or collected inside the block. Blocks may be
    nested; without one, files stay in the shared folder until someone clears it.
    """
    path = f"{_run.get() or shared_dir(spark)}/run-{uuid.uuid4().hex}"
    token = _run.set(path)
    try:
        yield path
    finally:
        _run.reset(token)
        delete_path(spark, path)


def shared_path(spark: SparkSession, name: str) -> str:
    """A path that no other step uses, in the run's folder, or else in the shared one."""
    return f"{_run.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder, wherever it is stored."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again, which cuts the lineage and holds no memory."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_numbers(df: DataFrame, order: Sequence[str], into: str) -> DataFrame:
    """Adds row numbers from 1 in the given order, over the whole table.

    Rows are sorted by range and numbered within each partition; what stands before a partition comes from a table with
    one row for each of them, so no task gets the whole table.
    """
    part, at = f"{into}_part", f"{into}_at"
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = written(ranged.withColumns({part: F.spark_partition_id(), at: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "numbered")
    counts = ranged.groupBy(part).agg(F.count("*").alias("n"))
    before = counts.select(part, (F.sum("n").over(Window.orderBy(part)) - F.col("n")).alias("before"))
    return ranged.join(before, part).withColumn(into, F.col("before") + F.col(at) + 1).drop(part, at, "before")
