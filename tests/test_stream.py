"""The scenario stream under crashes and faults, and the commit log below it."""

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.sources.commits import CommitLog, write_once
from tidemark.streaming import incremental

HEAD = ["a,M", "b,V1", "c,K", "e,1MON", "f,L", "type,T", "units,TAF"]


def send(folder, scenario, *values, name=""):
    folder.mkdir(exist_ok=True)
    (folder / f"{scenario}_DV{name}.csv").write_text("\n".join([*HEAD, *(f"{1921 + k}-10-31,{v}" for k, v in enumerate(values))]))


def run(spark, base, **options):
    incremental.stream_scenarios(spark, str(base / "in"), str(base / "out"), first_wait=0.0, **options)


def found(spark, base):
    rows = {(r.scenario, r.value_avg) for r in incremental.results(spark, str(base / "out")).collect()}
    return rows, {(r.scenario, r.error) for r in incremental.errors(spark, str(base / "out")).collect()}


def folders(base):
    return {p.name for p in (base / "out" / "data").iterdir()}


def test_crash_between_write_and_commit(spark, tmp_path, monkeypatch):
    send(tmp_path / "in", "s0001", 1, 3)
    (tmp_path / "in" / "s0009_DV.csv").write_text("nothing,here")
    real = CommitLog.commit

    def broken(self, *a):
        raise OSError("the driver dies here")

    monkeypatch.setattr(CommitLog, "commit", broken)
    with pytest.raises(StreamingQueryException):
        run(spark, tmp_path)
    assert len(folders(tmp_path)) == 1
    with pytest.raises(FileNotFoundError):
        incremental.results(spark, str(tmp_path / "out"))
    assert incremental.errors(spark, str(tmp_path / "out")).collect() == []
    monkeypatch.setattr(CommitLog, "commit", real)
    run(spark, tmp_path)
    assert found(spark, tmp_path) == ({("s0001", 2.0)}, {("s0009", "no line with a date")})
    log = CommitLog(spark, str(tmp_path / "out"))
    assert len(folders(tmp_path)) == 2 and log.vacuum() == 1 and len(folders(tmp_path)) == 1
    assert found(spark, tmp_path)[0] == {("s0001", 2.0)}


def test_crash_after_commit_is_not_done_again(spark, tmp_path, monkeypatch):
    send(tmp_path / "in", "s0001", 1, 3)
    real, computed = CommitLog.commit, []

    def broken(self, *a):
        real(self, *a)
        raise OSError("the driver dies here")

    def compute(series):
        computed.append(1)
        return incremental.monthly_of(series)

    monkeypatch.setattr(CommitLog, "commit", broken)
    with pytest.raises(StreamingQueryException):
        run(spark, tmp_path, compute=compute)
    monkeypatch.setattr(CommitLog, "commit", real)
    run(spark, tmp_path, compute=compute)
    assert len(computed) == 1 and len(folders(tmp_path)) == 1
    assert found(spark, tmp_path) == ({("s0001", 2.0)}, set())
    assert [r.version for r in CommitLog(spark, str(tmp_path / "out")).entries().collect()] == [1]


def test_data_faults_are_recorded_and_machine_faults_are_raised(spark, tmp_path):
    send(tmp_path / "in", "s0001", 1, 3)
    send(tmp_path / "in", "s0002", -5, 3)
    send(tmp_path / "in", "s0003", 7)

    def strict(series):
        value = F.when(F.col("value") < 0, F.raise_error("below zero").cast("double")).otherwise(F.col("value"))
        return incremental.monthly_of(series.withColumn("value", value))

    tried = []

    def lost(series):
        tried.append(1)
        raise Py4JError("executor lost")

    with pytest.raises(StreamingQueryException, match="executor lost"):
        run(spark, tmp_path, compute=lost, tries=2)
    assert len(tried) == 2
    run(spark, tmp_path, compute=strict)
    rows, bad = found(spark, tmp_path)
    assert rows == {("s0001", 2.0), ("s0003", 7.0)}
    assert [s for s, _ in bad] == ["s0002"] and "below zero" in next(iter(bad))[1]


def test_a_fault_that_passes_is_tried_again(spark, tmp_path):
    send(tmp_path / "in", "s0001", 1, 3)
    tried = []

    def flaky(series):
        tried.append(1)
        if len(tried) < 3:
            raise OSError("disk is full")
        return incremental.monthly_of(series)

    run(spark, tmp_path, compute=flaky)
    assert len(tried) == 3 and found(spark, tmp_path) == ({("s0001", 2.0)}, set())


def test_scenarios_sent_again_fail_or_empty(spark, tmp_path):
    def compute(series):
        if series.where("value = 13").count():
            raise incremental.BadScenario("thirteen")
        return incremental.monthly_of(series)

    send(tmp_path / "in", "s0001", 1)
    send(tmp_path / "in", "0020", 5)
    send(tmp_path / "in", "s0003", 7)
    run(spark, tmp_path, compute=compute)
    first = found(spark, tmp_path)[0]
    assert {v for _, v in first} == {1.0, 5.0, 7.0}
    send(tmp_path / "in", "s0001", 13, name="2")  # fails: the older rows stay
    send(tmp_path / "in", "s0003", "NaN", name="2")  # has no value any more
    run(spark, tmp_path, compute=compute)
    rows, bad = found(spark, tmp_path)
    assert rows == {r for r in first if r[1] != 7.0} and {s for s, _ in bad} == {"s0001"}


@pytest.mark.parametrize(("error", "is_data"), [(ValueError("bad"), True), (KeyError("k"), True), (MemoryError("no memory"), False), (OSError("disk"), False)])
def test_python_errors_in_tasks_are_told_apart(spark, error, is_data):
    @F.udf("int")
    def fail(x):
        raise error

    with pytest.raises(Exception) as caught:
        spark.range(1).select(fail("id")).collect()
    assert incremental.is_data_fault(caught.value) == is_data


def test_sql_errors_are_told_apart(spark):
    for expression, is_data in (("cast('x' as int) + id", True), ("1 div id", True), ("raise_error('no')", True), ("no_such_column", False)):
        with pytest.raises(Exception) as caught:
            spark.range(1).selectExpr(expression).collect()
        assert incremental.is_data_fault(caught.value) == is_data
    with pytest.raises(Exception) as caught:
        spark.read.parquet("/no/such/path")
    assert not incremental.is_data_fault(caught.value)


def test_commit_log_versions(spark, tmp_path, monkeypatch):
    log = CommitLog(spark, str(tmp_path))
    make = lambda n: lambda folder: (spark.createDataFrame([("s", n), ("007", n)], "scenario string, n int").write.partitionBy("scenario").parquet(folder), (["s", "007"], []))[1]
    assert write_once(log, "a", make(1)) == 1 and write_once(log, "a", make(9)) is None and write_once(log, "b", make(2)) == 2
    assert sorted(map(tuple, log.read().select("scenario", "n").collect())) == [("007", 2), ("s", 2)]
    assert log.commit("c", None, ["s"], []) == 3  # s has no rows any more
    assert [tuple(r) for r in log.read().select("scenario", "n").collect()] == [("007", 2)]
    real, other = log._write, CommitLog(spark, str(tmp_path))

    def late(path, text):  # another writer takes the version first
        if other.commit("other", None, [], []) is not None:
            assert other.entries().count() == 4
        real(path, text)

    monkeypatch.setattr(log, "_write", late)
    assert log.commit("d", None, [], []) == 5
    assert sorted(r.work for r in other.entries().collect()) == ["a", "b", "c", "d", "other"]
