"""A storage-partitioned layout of series: one conversion, and statistics by (scenario, entity) need no shuffle after it.

A table is partitioned by scenario and bucketed by entity (or variable) in as many buckets as it is told, each sorted.
Rows of one entity lie in one bucket, so every aggregation whose keys hold the bucketed column reads its groups from
one task. Scenarios are replaced one by one, as files of others are not touched.
"""

from __future__ import annotations

from collections.abc import Sequence
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.exports import read_dss_csv
from tidemark.sources.shared import delete_path, shared_path


class SeriesTable:
    """A bucketed table of series, registered in the session's catalog under ``name``, with its files at ``path``.

    As a context it is dropped, with its files, at the end; else it stays until ``drop``.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, bucketed: str, order: str, buckets: int):
        self.spark, self.name, self.path, self.bucketed, self.order, self.buckets = spark, name, path, bucketed, order, buckets

    @classmethod
    def create(cls, rows: DataFrame, bucketed: str = "entity", order: str = "ts", buckets: int | None = None, name: str | None = None, path: str | None = None) -> SeriesTable:
        """Writes rows with ``scenario``; of each scenario every bucket is one file.

        ``buckets`` defaults to ``spark.sql.shuffle.partitions``; size it so that a bucket of all scenarios fits a task.
        Rows that repeat are kept; a null entity has a bucket like any other.
        """
        spark = rows.sparkSession
        path = path or shared_path(spark, "series")
        own = cls(spark, name or path.rsplit("/", 1)[-1].replace("-", "_"), path, bucketed, order, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
        own._dealt(rows).write.partitionBy("scenario").bucketBy(own.buckets, bucketed).sortBy(bucketed, order).format("parquet").option("path", path).option("partitionOverwriteMode", "dynamic").saveAsTable(own.name)
        return own

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """Dealt as buckets are, so a task writes one of them, for all scenarios."""
        return rows.repartition(self.buckets, self.bucketed)

    def replace(self, rows: DataFrame) -> None:
        """Overwrites the scenarios in ``rows``; others keep their files."""
        columns = [c for c in self.read().columns if c != "scenario"]
        self._dealt(rows).select(*columns, "scenario").write.mode("overwrite").insertInto(self.name)  # dynamic, as the table says
        self.spark.catalog.refreshTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS `{self.name}`")
        delete_path(self.spark, self.path)

    def __enter__(self) -> SeriesTable:
        return self

    def __exit__(self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None) -> None:
        self.drop()


def convert_exports(spark: SparkSession, paths: str | Sequence[str], table: SeriesTable | None = None, wanted: DataFrame | None = None, buckets: int | None = None) -> SeriesTable:
    """Wide exports as a table of (variable, ts, value, units, annual) by scenario, split into cells this once.

    With a ``table`` the exports' scenarios are replaced in it.
    """
    rows = read_dss_csv(spark, paths, wanted).drop("file")
    if table is None:
        return SeriesTable.create(rows, "variable", "ts", buckets)
    table.replace(rows)
    return table
