"""Exact quantiles against percentile, demand in one pass, and search by trigrams against a scan."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import search, selection, series, stats


def shown(df):
    return sorted(str([round(x, 12) if isinstance(x, float) else [None if v is None else round(v, 9) + 0.0 for v in x] if isinstance(x, list) else x for x in r]) for r in df.collect())


@pytest.mark.parametrize("keys", [[], ["a"], ["a", "b"]])
def test_selection_equals_percentile(spark, keys):
    rng = random.Random(1)
    values = [None, 0.0, -0.0, 5.0, 5.0, 5.0, math.inf]  # a third of the rows is one value
    rows = [(rng.choice(["x", "x", "x", "y", None]), rng.randrange(3), rng.choice([*values, rng.uniform(-9, 9), rng.uniform(-9, 9)])) for _ in range(4_000)]
    rows += [("one", 0, 2.5), ("none", 0, None), ("_v", 1, 1.0), ("_v", 1, 2.0)]
    df = spark.createDataFrame(rows, "a string, b int, v double").withColumnRenamed("v", "_v").repartition(5)
    levels = [*stats.LEVELS, 0.333]
    want = df.where("_v is not null").groupBy(*keys).agg(F.percentile("_v", levels).alias("quantiles"), F.count("_v").alias("sample_count"))
    assert shown(selection.exact_quantiles(df, keys, "_v", levels)) == shown(want)
    assert selection.exact_quantiles(df.where("_v > 1e308 and _v < 0"), keys, "_v", levels).collect() == []
    with pytest.raises(ValueError):
        selection.exact_quantiles(df, keys, "_v", [1.5])


def test_a_group_is_split_over_tasks(spark, monkeypatch):
    kept, real = [], selection.written
    monkeypatch.setattr(selection, "written", lambda df, name: kept.append(real(df, name)) or kept[-1])
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).cast("double").alias("v"), F.lit("g").alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one partition
    try:
        (row,) = selection.exact_quantiles(df.repartition(4), ["k"], "v", [0.0, 0.5, 1.0]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert row.sample_count == 20_000
    sizes = [r["count"] for r in kept[0].groupBy("_part").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 0.5 * 20_000


def test_demand_shuffles_named_variables_once(spark):
    day = datetime.date(2000, 1, 31)
    rows = [("s", v, day, x) for v, x in (("d1", 10.0), ("s1", 5.0), ("a1", 50.0), ("d2", 4.0), ("a2", 0.0), ("d3", None), ("a3", 100.0), ("s9", 7.0), ("other", 1.0))]
    points = spark.createDataFrame(rows, "scenario string, variable string, ts date, value double")
    terms = spark.createDataFrame([("X", "d1", "s1", "a1"), ("X", "d2", None, "a2"), ("Y", "d1", "s1", "a1"), ("Y", "d1", "s1", "a1"), ("Z", "d3", None, "a3"), ("gone", "d9", "s9", "a1")], "district string, delivery_variable string, shortage_variable string, allocation_variable string")
    out = series.back_calculate_demand(points, terms)
    got = {r.district: (r.demand, r.delivery, r.pct_of_demand) for r in out.collect()}
    assert got == {"X": (30.0, 14.0, 14.0 * 100 / 30.0), "Y": (60.0, 20.0, 20.0 * 100 / 60.0), "Z": (0.0, None, None)}
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("REPARTITION_BY_COL") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_search_by_trigrams_equals_a_scan(spark, tmp_path):
    rows = [(kind, k, f"{kind[0]}{k}", f"Lake {'é' * (k % 3)}Oroville {k % 50}" if k % 7 else None, f"arm {k}" if k % 5 else "") for kind in ("node", "arc") for k in range(600)] + [("node", 3, "n3", "Lake Oroville 3", "twice")]
    elements = spark.createDataFrame(rows, "element string, id long, short_code string, name string, description string")
    path = str(tmp_path / "index")
    search.write_search_index(elements, path, blocks=8)
    kinds = [elements.where(F.col("element") == kind).drop("element") for kind in ("node", "arc")]
    for text in ("oroVILLE 4", "ÉO", "éOro", "n3", "arm 59", "zzz", "", "e o", "m 1", "aaaaaa"):
        want = [tuple(r) for r in series.search_elements(*kinds, text, 5_000).collect()]
        assert [tuple(r) for r in search.search_indexed(spark, path, text, 5_000).collect()] == want
        assert [tuple(r) for r in search.search_indexed(spark, path, text, 4).collect()] == [tuple(r) for r in series.search_elements(*kinds, text, 4).collect()]
    found = search.candidates(spark, path, "arm 59")
    assert found.count() < 40 and search.candidates(spark, path, "ar") is None
    plan = search.search_indexed(spark, path, "arm 599", 10)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "block#" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    search.write_search_index(elements.limit(0), str(tmp_path / "none"), blocks=2)
