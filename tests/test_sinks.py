"""Sinks that rewrite part of a table: what they touch, and what they leave alone."""

import datetime
import os

import pytest

from tidemark.operators import network
from tidemark.sources import exports, shared, sinks

SCHEMA = "scenario string, k int, v string"


def stamps(path):
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, files in os.walk(path) for f in files if f.endswith(".parquet")}


def content(spark, path):
    return sorted(map(str, map(tuple, spark.read.schema(SCHEMA).parquet(path).select("scenario", "k", "v").collect())))


def test_upsert_table_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda rows: spark.createDataFrame(rows, SCHEMA)
    assert sinks.upsert_table(spark, path, make([("0001", 1, "a"), ("0002", 1, "b"), (None, 1, "c"), ("0003", None, "d")]), ["scenario", "k"], ["scenario"]) == 4
    before = stamps(path)
    assert sinks.upsert_table(spark, path, make([("0002", 1, "B"), ("0002", 2, None), (None, 1, "C"), ("new", 5, "n"), ("0002", 1, "A")]), ["scenario", "k"], ["scenario"], {"v": "system"}) == 3
    after = stamps(path)
    kept = {f: t for f, t in before.items() if "0001" in f or "0003" in f}
    assert len(kept) == 2 and kept.items() <= after.items() and not {f for f in before if f not in kept} & set(after)
    want = [("0001", 1, "a"), ("0002", 1, "B"), ("0002", 2, "system"), ("0003", None, "d"), (None, 1, "C"), ("new", 5, "n")]
    assert content(spark, path) == sorted(map(str, want))
    assert sinks.upsert_table(spark, path, make([]), ["scenario", "k"], ["scenario"]) == 0 and stamps(path) == after
    with pytest.raises(ValueError, match="scenario"):
        sinks.upsert_table(spark, path, make([]), ["k"], ["scenario"])


def test_upsert_table_beyond_the_filter(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "MOST_TOUCHED", 1)
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 1, "x"), ("b", 1, "x"), ("c", 1, "x")], SCHEMA).write.partitionBy("scenario").parquet(path)
    before = stamps(path)
    assert sinks.upsert_table(spark, path, spark.createDataFrame([("a", 1, "y"), ("b", 2, "y")], SCHEMA), ["scenario", "k"], ["scenario"]) == 2
    assert content(spark, path) == sorted(map(str, [("a", 1, "y"), ("b", 1, "x"), ("b", 2, "y"), ("c", 1, "x")]))
    assert {f: t for f, t in before.items() if "=c" in f}.items() <= stamps(path).items()


def test_only_touched_partitions_are_scanned(spark, tmp_path, monkeypatch):
    path, seen = str(tmp_path / "t"), []
    spark.createDataFrame([("a", 1, "x"), ("b", 1, "x"), ("c", 1, "x")], SCHEMA).write.partitionBy("scenario").parquet(path)
    real = sinks.upsert
    monkeypatch.setattr(sinks, "upsert", lambda target, *a: seen.append(target._jdf.queryExecution().executedPlan().toString()) or real(target, *a))
    sinks.upsert_table(spark, path, spark.createDataFrame([("b", 1, "y")], SCHEMA), ["scenario", "k"], ["scenario"])
    assert "PartitionFilters: [(scenario" in seen[0] and "<=> b" in seen[0]


def test_one_export_by_many_tasks(spark, tmp_path):
    months = [datetime.date(1990 + k // 12, k % 12 + 1, 28) for k in range(240)]
    rows = [("s0001", f"V{v}", d, float(k * v), "CFS") for k, d in enumerate(months) for v in (1, 2)] + [("s0002", "V1", datetime.date(1960, 1, 31), 5.0, None)]
    series = spark.createDataFrame(rows, "scenario string, variable string, ts date, value double, units string")
    whole, parts = str(tmp_path / "whole"), str(tmp_path / "parts")
    sinks.write_dss_csv(series, whole)
    sinks.write_dss_parts(series, parts, part_lines=1000)
    manifest = sorted(spark.read.schema(sinks.MANIFEST).json(f"{parts}/manifest").collect())
    own = [r for r in manifest if r.scenario == "s0001"]
    assert len(own) in (8, 9) and sum(r.lines for r in own) == 247 and own[0].lines == 7
    text = ""
    for r in own:  # parts put end to end are the export
        (file,) = (tmp_path / "parts" / "lines" / "scenario=s0001" / f"part={r.part}").glob("*.txt")
        text += file.read_text()
    (one,) = (tmp_path / "whole" / "scenario=s0001").glob("*.txt")
    assert text == one.read_text()
    lines = sinks.read_dss_parts(spark, parts)
    assert {r.data_start for r in exports.detect_header_rows(lines).collect()} == {7}
    back = exports.long_series(lines, exports.series_meta(lines)).select("scenario", "variable", "ts", "value")
    assert sorted(map(tuple, back.collect())) == sorted(r[:4] for r in rows)
    file.unlink()
    with pytest.raises(ValueError, match="1 parts"):
        sinks.read_dss_parts(spark, parts)


def test_a_run_leaves_nothing_behind(spark, tmp_path):
    arcs = spark.createDataFrame([(1, 1, 2), (2, 2, 3)], "id long, from_id long, to_id long")
    with shared.run_folder(spark) as folder:
        found = network.reach(arcs, 1)
        assert os.path.isdir(folder)
        with shared.run_folder(spark) as inner:
            shared.row_numbers(arcs, ["id"], "n").write.parquet(str(tmp_path / "numbered"))
        assert inner.startswith(folder) and not os.path.exists(inner)
        assert found.count() == 3
    assert not os.path.exists(folder) and spark.read.parquet(str(tmp_path / "numbered")).count() == 2
    assert "run-" not in shared.shared_path(spark, "x")
    with pytest.raises(KeyError), shared.run_folder(spark) as folder:
        shared.written(arcs, "arcs")
        raise KeyError
    assert not os.path.exists(folder)
