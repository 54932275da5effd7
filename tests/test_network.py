"""Reach from many starts over a bucketed network, and boxes along a space-filling curve."""

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.operators import network


def plain_reach(steps, start, depth):
    seen, front = {start: 0}, {start}
    for d in range(1, depth + 1):
        front = {b for a, b in steps if a in front} - set(seen)
        seen |= dict.fromkeys(front, d)
    return {(start, n, d) for n, d in seen.items()}


@pytest.mark.parametrize("direction", network.DIRECTIONS)
def test_reach_from_many_equals_one_by_one(spark, direction):
    rng = random.Random(1)
    arcs = [(k, rng.choice([None, 0, 0, rng.randrange(40)]), rng.randrange(40)) for k in range(70)]  # node 0 is a hub
    down = {(a, b) for _, a, b in arcs if a is not None and a != b}
    steps = {"downstream": down, "upstream": {(b, a) for a, b in down}, "both": down | {(b, a) for a, b in down}}[direction]
    starts = [0, 3, 3, None, 17, 99]
    df = spark.createDataFrame(arcs, "id long, from_id long, to_id long")
    got = network.reach_from(df, spark.createDataFrame([(s,) for s in starts], "source long"), direction, 3)
    want = set().union(*(plain_reach(steps, s, 3) for s in {0, 3, 17, 99}))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    assert {(17, r.node, r.distance) for r in network.reach(df, 17, direction, 3).collect()} == plain_reach(steps, 17, 3)
    assert network.reach_from(df, spark.createDataFrame([], "source long"), direction).collect() == []
    assert network.reach_from(df.limit(0), spark.createDataFrame([(1,)], "source long"), direction).count() == 1


def test_edges_are_not_shuffled_after_they_are_bucketed(spark, monkeypatch):
    arcs = spark.range(2_000).select("id", (F.col("id") / 2).cast("long").alias("from_id"), F.col("id").alias("to_id"))
    plans, real, before = [], network.onward, {t.name for t in spark.catalog.listTables()}
    monkeypatch.setattr(network, "onward", lambda front, edges: plans.append(real(front, edges)._jdf.queryExecution().executedPlan().toString()) or real(front, edges))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        network.reach_from(arcs, spark.range(5, 9).withColumnRenamed("id", "source"), "downstream", 4)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(plans) == 4
    for plan in plans:  # one shuffle, of the frontier; the edges come in buckets
        assert plan.count("Exchange hashpartitioning(node") == 1 and "Exchange hashpartitioning(here" not in plan and "Bucketed: true" in plan
    assert {t.name for t in spark.catalog.listTables()} == before


def inside(box, lon, lat):
    return box[0] <= lon <= box[2] and box[1] <= lat <= box[3]


def test_ranges_of_the_curve_cover_the_box(spark):
    rng = random.Random(2)
    points = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(300)] + [(-180.0, -90.0), (180.0, 90.0), (0.0, 0.0)]
    boxes = [(-125.0, 32.0, -114.0, 42.0), (-180.0, -90.0, 180.0, 90.0), (0.0, 0.0, 0.0, 0.0), (10.0, 10.0, 5.0, 5.0), (170.0, 80.0, 200.0, 95.0)]
    boxes += [(x, y, x + rng.uniform(0, 60), y + rng.uniform(0, 40)) for x, y in points[:20]]
    df = spark.createDataFrame(points, "lon double, lat double")
    placed = [(r.lon, r.lat, r.place) for r in df.withColumn("place", network.curve_place(F.col("lon"), F.col("lat"))).collect()]
    for box in boxes:
        ranges = network.curve_ranges(box)
        assert len(ranges) <= network.MOST_RANGES
        for lon, lat, place in placed:
            assert not inside(box, lon, lat) or any(a <= place <= b for a, b in ranges)
    small = network.curve_ranges((-122.0, 37.0, -121.0, 38.0))
    assert sum(b - a + 1 for a, b in small) < 4 * (65536 / 360) * (65536 / 180)  # little beyond the box


def test_a_box_skips_most_row_groups(spark, tmp_path):
    rng = random.Random(3)
    rows = [(k, None if k % 50 == 0 else rng.uniform(-125, -114), rng.uniform(32, 42), "x" * 50 + str(rng.random())) for k in range(20_000)]
    path, box = str(tmp_path / "nodes"), (-122.0, 37.0, -121.0, 38.0)
    nodes = spark.createDataFrame(rows, "id long, lon double, lat double, name string")
    network.write_located(nodes, path, row_group_kb=8)
    got = network.read_box(spark, path, box)
    assert sorted(r.id for r in got.collect()) == sorted(k for k, lon, lat, _ in rows if lon is not None and inside(box, lon, lat))
    assert "PushedFilters" in (plan := got._jdf.queryExecution().executedPlan().toString()) and "Equal(curve," in plan
    ranges, groups, read = network.curve_ranges(box), 0, 0
    for file in (tmp_path / "nodes").glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.to_arrow_schema().get_field_index("curve")
        for k in range(meta.num_row_groups):
            stats = meta.row_group(k).column(at).statistics
            groups += 1
            read += stats.has_min_max and any(a <= stats.max and stats.min <= b for a, b in ranges)
    assert groups >= 50 and read <= 0.2 * groups
