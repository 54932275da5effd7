"""A log of commits that readers follow: data is written first, under a name of its own, and counts once it is committed.

A commit is one small file ``log/<version>.json``, put there by a rename that fails where the version exists. It names the
folder of its data, the scenarios in it, and the work it stands for; a scenario's rows are those of its last commit.
What was written and never committed is seen by no reader, and work that is committed is not done again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

ENTRY = "version long, work string, data string, scenarios array<string>, errors array<struct<file:string,scenario:string,error:string>>"
MOST_CONFLICTS = 20


class CommitLog:
    """The log of one table at ``path``, in a folder that the driver and all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.path).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
        self._keep = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)  # of rename: replace nothing

    def entries(self) -> DataFrame:
        """Rows of ``ENTRY``, one for each commit."""
        if not self._files.util().exists(self._path(f"{self.path}/log")):
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).json(f"{self.path}/log/*.json")

    def done(self, work: str) -> bool:
        return not self.entries().where(F.col("work") == work).isEmpty()

    def new_folder(self) -> str:
        """A name under ``data`` that no other attempt has, relative to the table."""
        return f"data/batch={uuid.uuid4().hex}"

    def has_rows(self, data: str) -> bool:
        top = self._path(f"{self.path}/{data}")
        return self._files.util().exists(top) and any(s.getPath().getName().startswith("scenario=") for s in self._files.util().listStatus(top))

    def commit(self, work: str, data: str | None, scenarios: list[str], errors: list[tuple[str, str, str]]) -> int | None:
        """Makes the folder ``data`` count from now on; the version, or None where ``work`` was committed before."""
        named = [dict(zip(("file", "scenario", "error"), e, strict=True)) for e in errors]
        draft = f"{self.path}/drafts/{uuid.uuid4().hex}.json"
        for _ in range(MOST_CONFLICTS):
            if self.done(work):
                return None
            version = (self.entries().agg(F.max("version")).first()[0] or 0) + 1
            line = json.dumps({"version": version, "work": work, "data": data, "scenarios": sorted(scenarios), "errors": named})
            self._write(draft, line)
            try:
                self._files.rename(self._path(draft), self._path(f"{self.path}/log/{version:012d}.json"), self._keep)
            except Exception as error:
                if "FileAlreadyExistsException" not in str(error):
                    raise
                continue  # another writer took this version
            return version
        raise RuntimeError(f"no free version in {MOST_CONFLICTS} tries")

    def _write(self, path: str, text: str) -> None:
        where = self._path(path)
        for folder in (where.getParent(), self._path(f"{self.path}/log")):
            self._files.mkdir(folder, None, True)
        system = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        out = system.create(where, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def live(self) -> DataFrame:
        """Rows (scenario, data): the folder that holds each scenario's rows, that of its last commit; null if it has none."""
        each = self.entries().select("version", "data", F.explode("scenarios").alias("scenario"))
        return each.groupBy("scenario").agg(F.max_by("data", "version").alias("data"))

    def read(self) -> DataFrame:
        """The rows that count, with ``scenario`` as text. Only folders of live scenarios are listed, and only their files read."""
        live = [(r.scenario, r.data) for r in self.live().where("data is not null").collect()]
        if not live:
            raise FileNotFoundError(f"nothing is committed in {self.path}")
        paths = sorted({f"{self.path}/{data}" for _, data in live})
        reader = self.spark.read.option("basePath", f"{self.path}/data")
        own = {"batch": StringType(), "scenario": StringType()}  # not as Spark would guess from the folders' names
        schema = StructType([StructField(f.name, own.get(f.name, f.dataType)) for f in reader.parquet(*paths).schema])
        place = F.concat_ws("/", "batch", "scenario")
        return reader.schema(schema).parquet(*paths).where(place.isin([f"{data.partition('=')[2]}/{scenario}" for scenario, data in live])).drop("batch")

    def errors(self) -> DataFrame:
        """Rows (version, file, scenario, error) of all commits."""
        return self.entries().select("version", F.explode("errors").alias("e")).select("version", "e.*")

    def vacuum(self) -> int:
        """Deletes folders that hold no live scenario, and drafts; how many. No writer may be at work."""
        keep = {r.data for r in self.live().select("data").distinct().collect()}
        gone = 0
        for part in ("data", "drafts"):
            top = self._path(f"{self.path}/{part}")
            if self._files.util().exists(top):
                for status in self._files.util().listStatus(top):
                    if f"{part}/{status.getPath().getName()}" not in keep:
                        self._files.delete(status.getPath(), True)
                        gone += 1
        return gone


def write_once(log: CommitLog, work: str, make: Callable[[str], tuple[list[str], list[tuple[str, str, str]]]]) -> int | None:
    """Does a piece of work once: ``make`` writes into the folder it is given and returns its scenarios and errors.

    The rows are partitioned by scenario; a scenario that is returned and has no row there has none from now on.

    A run that is broken off at any point leaves readers as they were and is done anew; one that was committed is not.
    """
    if log.done(work):
        return None
    data = log.new_folder()
    scenarios, errors = make(f"{log.path}/{data}")
    return log.commit(work, data if log.has_rows(data) else None, scenarios, errors)
