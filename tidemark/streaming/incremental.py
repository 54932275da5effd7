"""Scenario files as a stream, and the change log between two snapshots."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException, PythonException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import scenario_from_path
from tidemark.operators import stats
from tidemark.sources import exports
from tidemark.sources.commits import CommitLog, write_once


def monthly_of(series: DataFrame) -> DataFrame:
    """Monthly distribution of every variable of every scenario."""
    rows = exports.with_series_calendar(series.withColumnRenamed("variable", "entity"))
    return stats.distribution_stats(rows, stats.MONTH, "value", "value_")


class BadScenario(ValueError):
    """Raised by a ``compute`` that finds its input at fault."""


#: SQLSTATE of data exceptions (class 22) and of errors that an expression raises on a row.
DATA_STATES = ("22", "P0001")
#: Errors of Python code in tasks that the rows it is given can cause.
DATA_ERRORS = ("ValueError", "ArithmeticError", "ZeroDivisionError", "OverflowError", "FloatingPointError", "UnicodeDecodeError", "KeyError", "IndexError", "BadScenario")
TRIES, FIRST_WAIT = 3, 1.0
#: What a machine may cause: Spark's errors, what is lost on the way to it, and those of files and memory.
FAULTS = (PySparkException, Py4JError, OSError, MemoryError)


def is_data_fault(error: BaseException) -> bool:
    """Whether the rows are at fault: a data exception by its SQLSTATE, or an error of Python code that rows can cause.

    All else (a lost executor, a full disk, no memory, a plan that doesn't resolve) isn't.
    """
    if isinstance(error, BadScenario):
        return True
    if isinstance(error, PythonException):
        named = re.findall(r"^\s*(?:[\w.]*\.)?(\w+)(?::|$)", str(error), re.MULTILINE)
        return next((n in DATA_ERRORS for n in reversed(named) if n.endswith(("Error", "Exception", "Scenario")) and n != "PythonException"), False)
    return isinstance(error, PySparkException) and (error.getSqlState() or "").startswith(DATA_STATES)


def with_retries(work: Callable[[], None], tries: int = TRIES, first_wait: float = FIRST_WAIT) -> None:
    """Runs ``work``; a fault that isn't the data's is met by trying again, after ever longer waits, and then raised."""
    for n in range(tries):
        try:
            return work()
        except FAULTS as error:
            if is_data_fault(error) or n + 1 == tries:
                raise
            time.sleep(first_wait * 2**n)


def results(spark: SparkSession, out_dir: str) -> DataFrame:
    """The committed rows of every scenario."""
    return CommitLog(spark, out_dir).read()


def errors(spark: SparkSession, out_dir: str) -> DataFrame:
    """Rows (version, file, scenario, error) of the files that were left out."""
    return CommitLog(spark, out_dir).errors()


def stream_scenarios(
    spark: SparkSession, in_dir: str, out_dir: str, compute: Callable[[DataFrame], DataFrame] = monthly_of, variables: list[str] | None = None,
    most_files: int = 100, tries: int = TRIES, first_wait: float = FIRST_WAIT
) -> None:
    """Takes in all new files of ``in_dir`` and returns when they are done; a later call takes in later files.

    Each file's scenario is replaced, and of files of one scenario the one that was written last counts, so a file that is
    sent again counts once. ``results`` and ``errors`` read what is committed. Results and errors of a batch count
    together, by one commit after all are written (see ``commits``); a batch that is run again after a crash
    is done anew if it wasn't committed, and is nothing to do if it was. Progress is kept in ``out_dir``/checkpoint.

    A file without a dated line, and one whose data are at fault (``is_data_fault``, a ``BadScenario`` of ``compute``
    included), is recorded as an error and the others go on: a batch of at most ``most_files`` is taken as a whole, and
    scenario by scenario where that fails. Any other fault is met by ``tries`` attempts and then raised: nothing of the
    batch counts, and the next call takes it in.
    """
    text = spark.readStream.schema("value string").format("text").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", most_files).load(in_dir)
    meta = {"file": "file_path", "block": "file_block_start", "written": "file_modification_time"}
    lines = text.select("value", *(F.col(f"_metadata.{c}").alias(k) for k, c in meta.items()))
    log = CommitLog(spark, out_dir)

    def stream() -> str:
        """The id of this stream, new with each checkpoint: batches of another one are other batches."""
        return json.loads(spark.read.text(f"{out_dir}/checkpoint/metadata", wholetext=True).first().value)["id"]

    def write(rows: DataFrame, folder: str) -> None:
        chosen = exports.series_meta(rows)
        if variables is not None:
            chosen = chosen.where(F.col("b").isin(*variables))
        found = compute(exports.long_series(rows, exports.first_column_wins(chosen)).drop("file", "units"))
        found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("scenario").parquet(folder)

    def make(batch: DataFrame, folder: str) -> tuple[list[str], list[tuple[str, str, str]]]:
        files = batch.groupBy("file").agg(F.max("written").alias("written"), F.bool_or(exports.is_dated(F.split("value", ",", 2))).alias("dated"))
        files = files.withColumn("scenario", scenario_from_path(F.col("file")))
        bad = [(r.file, r.scenario, "no line with a date") for r in files.where("not dated").collect()]
        latest = [tuple(r) for r in files.where("dated").groupBy("scenario").agg(F.max_by("file", F.struct("written", "file")).alias("file")).collect()]
        if not latest:
            return [], bad
        own = exports.raw_lines(batch.join(F.broadcast(spark.createDataFrame(latest, "scenario string, file string")), "file", "left_semi")).persist()
        try:
            try:
                with_retries(lambda: write(own, folder), tries, first_wait)
            except (PySparkException, BadScenario) as error:
                if not is_data_fault(error):
                    raise
                for scenario, file in latest:
                    try:
                        with_retries(lambda file=file: write(own.where(F.col("file") == file), folder), tries, first_wait)
                    except (PySparkException, BadScenario) as error:
                        if not is_data_fault(error):
                            raise
                        bad.append((file, scenario, str(error).strip().split("\n")[0][:500]))
        finally:
            own.unpersist()
        failed = {scenario for _, scenario, _ in bad}
        return [scenario for scenario, _ in latest if scenario not in failed], bad

    def take(batch: DataFrame, number: int) -> None:
        write_once(log, f"{stream()}/{number}", lambda folder: make(batch, folder))

    lines.writeStream.foreachBatch(take).option("checkpointLocation", f"{out_dir}/checkpoint").trigger(availableNow=True).start().awaitTermination()


def change_log(old: DataFrame, new: DataFrame, key: str, table: str) -> DataFrame:
    """INSERT, UPDATE and DELETE rows between two snapshots, with old and new as JSON and the fields that an UPDATE changed."""
    fields = [c for c in new.columns if c != key]
    a = old.select(F.col(key).alias("_k"), F.struct(*old.columns).alias("o"))
    b = new.select(F.col(key).alias("_k2"), F.struct(*new.columns).alias("n"))
    rows = a.join(b, F.col("_k") == F.col("_k2"), "full")
    changed = F.array_compact(F.array(*(F.when(~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")), F.lit(c)) for c in fields)))
    operation = F.when(F.col("_k").isNull(), "INSERT").when(F.col("_k2").isNull(), "DELETE").when(F.size(changed) > 0, "UPDATE")
    rows = rows.withColumns({"operation": operation, "changed": changed}).where("operation is not null")
    return rows.select(
        F.lit(table).alias("table_name"), F.coalesce("_k", "_k2").alias("record_id"), "operation", F.to_json("o").alias("old_values"),
        F.to_json("n").alias("new_values"), F.when(F.col("operation") == "UPDATE", F.col("changed")).alias("changed_fields")
    )
