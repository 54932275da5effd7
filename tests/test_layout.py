"""The bucketed layout of series, and comparisons by digest: what is not shuffled or joined."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions.calendar import with_water_calendar
from tidemark.operators import families, quality, stats
from tidemark.plans.bindings import obs, reservoirs
from tidemark.sources.layout import SeriesTable

SF = "/root/testdata/sf0.001"
D = datetime.date


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_statistics_from_buckets_have_no_shuffle(spark):
    held = reservoirs(spark, SF)
    with SeriesTable.create(obs(spark, SF), buckets=3) as table:
        rows = table.read()
        for df in (stats.storage_monthly(rows, held), stats.spill_monthly(rows, held), stats.annual_totals(rows, ["delivery"]), stats.distribution_stats(rows, stats.MONTH, "storage")):
            assert "hashpartitioning" not in plan(df) and "Bucketed: true" in plan(df)
        assert "hashpartitioning" in plan(stats.storage_monthly(obs(spark, SF), held))
        key = lambda df: sorted(map(str, df.collect()))
        columns = obs(spark, SF).columns
        assert key(rows.select(*columns)) == key(obs(spark, SF))
        assert key(families.reservoir_period_summary(rows, held)) == key(families.reservoir_period_summary(obs(spark, SF), held))
        path, name = table.path, table.name
    assert not os.path.exists(path) and not spark.catalog.tableExists(name)


def test_scenarios_are_replaced_one_by_one(spark):
    schema = "scenario string, entity string, ts date, value double"
    make = lambda rows: spark.createDataFrame(rows, schema)
    table = SeriesTable.create(make([("a", "x", D(2000, 1, 31), 1.0), ("a", None, D(2000, 1, 31), 2.0), ("b", "x", D(2000, 1, 31), 3.0), ("b", "x", D(2000, 1, 31), 3.0)]), buckets=2)
    files = lambda: {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(table.path) if "scenario=b" in d for f in fs if f.endswith(".parquet")}
    before = files()
    table.replace(make([("a", "y", D(2001, 1, 31), 9.0), ("c", "x", None, None)]))
    assert before and files() == before
    got = sorted(map(str, (tuple(r) for r in table.read().select("scenario", "entity", "value").collect())))
    assert got == sorted(map(str, [("a", "y", 9.0), ("b", "x", 3.0), ("b", "x", 3.0), ("c", "x", None)]))
    assert "hashpartitioning" not in plan(table.read().groupBy("scenario", "entity").count())
    table.drop()


def cells(spark, rows):
    return spark.createDataFrame(rows, "b string, c string, date date, value double")


def plain_compare(ref, test):
    """The comparison as one join of all cells."""
    lo = max(min(r[2] for r in side if r[2]) for side in (ref, test))
    hi = min(max(r[2] for r in side if r[2]) for side in (ref, test))
    out = []
    for b, c, d, v in ref:
        for b2, c2, d2, w in test:
            if None not in (b, c, d) and (b, c, d) == (b2, c2, d2) and lo <= d <= hi:
                diff = None if v is None or w is None else abs(v - w)
                nan = v == v or w == w or v is None or w is None  # Spark holds NaN equal to itself
                out.append(str((b, c, d, v, w, diff, (v is None and w is None) or not nan or (diff is not None and diff <= 1e-6 + 1e-6 * abs(w)))))
    return sorted(out)


def test_comparison_by_digest_equals_a_join_of_all_cells(spark):
    month = lambda y, m: D(y, m, 28)
    ref = [(b, "c", month(y, m), float(y * m)) for b in ("same", "near", "far", "gone") for y in (2000, 2001, 2002) for m in (1, 5, 9)]
    test = [(b, c, d, v + {"near": 1e-7, "far": 2.0}.get(b, 0.0) if d.year == 2001 else v) for b, c, d, v in ref if b != "gone"]
    nan, inf = float("nan"), float("inf")
    ref += [("twice", "c", month(2001, 1), 1.0), ("twice", "c", month(2001, 1), 2.0), ("nan", "c", month(2001, 1), nan), ("inf", "c", month(2001, 2), inf), ("miss", "c", month(2001, 1), None), (None, "c", month(2001, 1), 1.0), ("x", None, month(2001, 1), 1.0), ("x", "c", None, 1.0), ("one", "c", month(2001, 3), None)]
    test += [("twice", "c", month(2001, 1), 2.0), ("twice", "c", month(2001, 1), 1.0), ("nan", "c", month(2001, 1), nan), ("inf", "c", month(2001, 2), inf), ("miss", "c", month(2001, 1), None), (None, "c", month(2001, 1), 1.0), ("x", None, month(2001, 1), 1.0), ("x", "c", None, 1.0), ("one", "c", month(2001, 3), 0.0), ("new", "c", month(2001, 3), 0.0)]
    got = quality.compare_series(cells(spark, ref), cells(spark, test))
    assert sorted(str(tuple(r)) for r in got.collect()) == plain_compare(ref, test)
    kinds = {(r.b, r.block): r.kind for r in quality.block_kinds(cells(spark, ref), cells(spark, test)).collect()}
    assert kinds == {**{("gone", y): "alone" for y in (2000, 2001, 2002)}, ("new", 2001): "alone", **{(b, 2001): "differing" for b in ("near", "far", "twice", "nan", "inf", "one")}}


def test_equal_columns_never_reach_the_cell_join(spark, monkeypatch):
    ref = spark.range(5000).select(F.concat(F.lit("v"), (F.col("id") % 20).cast("string")).alias("b"), F.lit("c").alias("c"), F.date_add(F.lit("2000-01-01"), (F.col("id") / 20).cast("int")).alias("date"), F.rand(3).alias("value")).cache()
    test = ref.withColumn("value", F.when((F.col("b") == "v7") & (F.col("date") == "2000-02-02"), 99.0).otherwise(F.col("value")))
    met = []
    real = type(ref).join
    def join(self, other, on=None, how=None):  # noqa: E306
        if isinstance(on, list) and on == list(quality.KEY):
            met.append((self, other))
        return real(self, other, on, how)

    monkeypatch.setattr(type(ref), "join", join)
    got = quality.compare_series(ref, test)
    monkeypatch.setattr(type(ref), "join", real)
    assert got.count() == 5000 and [tuple(r) for r in got.where("not equal").select("b", F.col("date").cast("string")).collect()] == [("v7", "2000-02-02")]
    ((left, right),) = met
    assert [{(r.b, r.n) for r in side.groupBy("b").agg(F.count("*").alias("n")).collect()} for side in (left, right)] == [{("v7", 250)}] * 2
    ref.unpersist()


def test_water_calendar_survives_the_table(spark):
    rows = with_water_calendar(spark.createDataFrame([("a", 1, D(2000, 10, 31))], "scenario string, entity int, ts date"))
    with SeriesTable.create(rows, buckets=1) as table:
        assert table.read().first().water_year == 2001
    with pytest.raises(Exception):
        table.read().count()
