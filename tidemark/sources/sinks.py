"""Writing results: wide exports, upserts, replacement of scenarios, plain files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.scalars import map_of
from tidemark.sources.exports import LABELS
from tidemark.sources.shared import written


#: The place of the line of 1970-01-01; lines of the header have places from 0.
DAY_ZERO = 10_000_000


def dss_lines(series: DataFrame) -> DataFrame:
    """Rows (scenario, place, line) of wide exports from (scenario, variable, ts, value, units): header, then dates.

    Columns are in order of name; dates without any value are left out; a missing cell is NaN; of values for one cell
    the largest stays. No plan gets as wide as the export: a line is put together from a map of its cells.
    """
    columns = series.groupBy("scenario", "variable").agg(F.max("units").alias("units"))
    heads = columns.groupBy("scenario").agg(F.array_sort(F.collect_list(F.struct("variable", "units"))).alias("columns"))
    text = {"a": F.lit("MODEL"), "c": F.lit("SERIES"), "e": F.lit("1MON"), "f": F.lit("L2020A"), "type": F.lit("PER-AVER")}

    def head(label: str):
        cell = (lambda c: c["variable"]) if label == "b" else (lambda c: F.coalesce(c["units"], F.lit(""))) if label == "units" else (lambda c: text[label])
        return F.concat_ws(",", F.lit(label), F.array_join(F.transform("columns", cell), ","))

    header = heads.select("scenario", F.posexplode(F.array(*map(head, LABELS))).alias("place", "line")).withColumn("place", F.col("place").cast("long"))
    days = series.where("value is not null").groupBy("scenario", "ts").agg(map_of(F.collect_list(F.struct(F.col("variable").alias("key"), "value"))).alias("cells"))
    cells = F.array_join(F.transform("columns", lambda c: F.coalesce(F.try_element_at(F.col("cells"), c["variable"]).cast("string"), F.lit("NaN"))), ",")
    body = days.join(heads, "scenario").select(
        "scenario", (F.unix_date("ts") + DAY_ZERO).cast("long").alias("place"),
        F.concat_ws(",", F.date_format("ts", "yyyy-MM-dd"), cells).alias("line")
    )
    return header.unionByName(body)


def write_dss_csv(series: DataFrame, path: str) -> None:
    """One file for each scenario in ``path``/scenario=…, for readers that take an export as one file.

    A scenario's lines come from one task; ``write_dss_parts`` is the form for long exports.
    """
    lines = dss_lines(series)
    lines.repartition("scenario").sortWithinPartitions("scenario", "place").select("scenario", F.col("line").alias("value")).write.partitionBy("scenario").text(path)


#: Lines of a part of an export; 10,000 columns make a line of some 100 KB.
PART_LINES = 500
MANIFEST = "scenario string, part long, first_place long, lines long"


def write_dss_parts(series: DataFrame, path: str, part_lines: int = PART_LINES) -> None:
    """Each scenario's export as parts in ``path``/lines/scenario=…/part=…, written by many tasks, with a manifest.

    A part holds all lines of a range of dates, of ``part_lines`` days at most, in order; the header is part 0. The
    manifest (``MANIFEST``, in ``path``/manifest) gives the parts' order; it is written last, so a reader
    that finds it finds every part. Parts put end to end in its order are the export that ``write_dss_csv`` writes.
    """
    part = F.when(F.col("place") < len(LABELS), 0).otherwise(F.floor(F.col("place") / part_lines) + 1)
    lines = dss_lines(series).withColumn("part", part.cast("long"))
    rows = lines.repartition("scenario", "part").sortWithinPartitions("scenario", "part", "place")
    rows.select("scenario", "part", F.col("line").alias("value")).write.partitionBy("scenario", "part").text(f"{path}/lines")
    back = _parts(series.sparkSession, path)
    back.groupBy("scenario", "part").agg(F.min("place").alias("first_place"), F.count("*").alias("lines")).write.json(f"{path}/manifest")


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """Rows (scenario, part, place, value); a line's place is told by its label or date."""
    found = spark.read.schema("value string, scenario string, part long").text(f"{path}/lines")
    first = F.substring_index("value", ",", 1)
    label = F.array_position(F.array(*map(F.lit, LABELS)), first) - 1
    return found.withColumn("place", F.when(F.col("part") == 0, label).otherwise(F.unix_date(F.to_date(first)) + DAY_ZERO).cast("long"))


def read_dss_parts(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file, block, at, cells) as ``exports.read_lines`` gives them, a scenario's parts as one file.

    ``at`` ascends, with the first date at the number of header lines. Parts that the manifest doesn't list, or that
    have not the lines it says, are an error.
    """
    listed = spark.read.schema(MANIFEST).json(f"{path}/manifest")
    lines = _parts(spark, path)
    there = lines.groupBy("scenario", "part").agg(F.count("*").alias("_lines"))
    wrong = there.join(listed, ["scenario", "part"], "full").where("not (_lines <=> lines)").count()
    if wrong:
        raise ValueError(f"{wrong} parts are not as the manifest says")
    began = listed.where("part > 0").groupBy("scenario").agg(F.min("first_place").alias("_first"))
    at = F.when(F.col("part") == 0, F.col("place")).otherwise(F.col("place") - F.col("_first") + len(LABELS))
    return lines.join(began, "scenario", "left").select(
        F.concat(F.lit(f"{path}/"), "scenario").alias("file"), F.lit(0).cast("long").alias("block"), at.alias("at"),
        F.split("value", ",", -1).alias("cells")
    )


def upsert(target: DataFrame, updates: DataFrame, key: Sequence[str], defaults: dict | None = None) -> DataFrame:
    """Target rows without an update, and all updates; of updates with one key the last in column order stays.

    Keys that are null are equal to each other. This reads the whole target; ``upsert_table`` is the form for a table
    that is partitioned, and where a table format has MERGE, that is better still.
    """
    keys = list(key)
    rest = [c for c in updates.columns if c not in keys]
    last = updates.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_u")).select(*keys, *(F.col(f"_u.{c}").alias(c) for c in rest))
    for column, value in (defaults or {}).items():
        last = last.withColumn(column, F.coalesce(column, F.lit(value)) if column in last.columns else F.lit(value))
    return unmatched(target, last, keys).unionByName(last, allowMissingColumns=True)


#: Touched partitions whose values are put into the filter of the scan; beyond that they are joined, which reads all of them.
MOST_TOUCHED = 2000


def upsert_table(spark: SparkSession, path: str, updates: DataFrame, key: Sequence[str], partition: Sequence[str], defaults: dict | None = None) -> int:
    """Upserts into the Parquet table at ``path``, partitioned by ``partition``; how many partitions were rewritten.

    Copy on write: only partitions with an update are read, merged and overwritten; files of others are not touched. The
    key holds the partition columns, as a row would have to move otherwise. Merged partitions are written aside first, and
    the table is overwritten from there by dynamic partition overwrite. Null is a key, and a partition, like any other.
    Without updates nothing happens; where ``path`` holds no table yet, it is made.
    """
    if missing := set(partition) - set(key):
        raise ValueError(f"the key must hold the partition columns, {', '.join(sorted(missing))} too")
    news = written(updates, "updates")
    touched = news.select(*partition).distinct()
    count = touched.count()
    if not count:
        return 0
    target = _table(spark, path, updates, partition)
    if target is None:
        merged = upsert(news.limit(0), news, key, defaults)
    else:
        if count <= MOST_TOUCHED:
            these = reduce(lambda a, b: a | b, (reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.lit(row[c])) for c in partition)) for row in touched.collect()))
            own = target.where(these)
        else:
            own = target.join(
                touched.select(*(F.col(c).alias(f"_{c}") for c in partition)),
                reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in partition)), "left_semi"
            )
        merged = upsert(own, news, key, defaults)
    aside = written(merged, "merged")
    aside.repartition(*partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)
    return count


def _table(spark: SparkSession, path: str, like: DataFrame, partition: Sequence[str]) -> DataFrame | None:
    """The table at ``path`` with its partition columns as ``like`` has them, or None where nothing is there."""
    try:
        found = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return spark.read.schema(StructType([like.schema[f.name] if f.name in partition else f for f in found.schema])).parquet(path)


def unmatched(rows: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key, nulls included, is not in ``other``."""
    there = other.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
    return rows.join(there, reduce(lambda a, b: a & b, (rows[k].eqNullSafe(there[f"_{k}"]) for k in keys)), "left_anti")


def replace_scenario(path: str, rows: DataFrame) -> None:
    """Overwrites the partitions of the scenarios in ``rows``; others stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("scenario").parquet(path)


def insert_new(target: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Target rows and those of ``rows`` whose key is new; null is a key like any other."""
    return target.unionByName(unmatched(rows, target, list(key)), allowMissingColumns=True)


FORMATS = ("csv", "json", "parquet", "orc")


def write_results(df: DataFrame, fmt: str, path: str) -> None:
    """Statistics as files; CSV has a header."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {', '.join(FORMATS)}")
    writer = df.write.mode("overwrite")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)
