"""River networks: lists, searches by place, degrees, paths and reach. Nodes have (id, …), arcs (id, from_id, to_id)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.shared import delete_path, shared_path, written

DIRECTIONS = ("upstream", "downstream", "both")


def node_list(nodes: DataFrame, types: DataFrame, regions: DataFrame, region: str | None = None, limit: int = 1000) -> DataFrame:
    """Located nodes with type, region and a JSON object of attributes, by id, the first ``limit``."""
    rows = nodes.where("lon is not null and lat is not null").join(types, "type_id", "left").join(regions, "region_id", "left")
    rows = rows if region is None else rows.where(F.col("region") == region)
    return rows.select(
        "id", "short_code", "type", "region", "lon", "lat", F.to_json(F.struct("short_code", "type", "region")).alias("attributes")
    ).orderBy("id").limit(limit)


def map_category(code: Column, is_reservoir: Column) -> Column:
    return (
        F.when(
            is_reservoir | code.isin("STR", "STR-SIM", "STR-NSM"), "reservoir"
        ).when(F.startswith(code, F.lit("PS")), "pump_station").when(F.startswith(code, F.lit("WTP")), "water_treatment")
        .when(code == "WWTP", "wastewater_treatment").when(F.startswith(code, F.lit("PR-")), "project").when(F.startswith(code, F.lit("S-")), "source").otherwise("other")
    )


def in_box(nodes: DataFrame, box: Sequence[float]) -> DataFrame:
    west, south, east, north = box
    return nodes.where(F.col("lon").between(west, east) & F.col("lat").between(south, north))


def categorised(nodes: DataFrame, reservoirs: DataFrame) -> DataFrame:
    own = reservoirs.select("id", "capacity_taf", F.lit(True).alias("_r"))
    out = nodes.join(own, "id", "left")
    held = F.coalesce("_r", F.lit(False))
    code = F.coalesce("type", F.lit(""))
    return out.withColumns({"is_reservoir": held | code.isin("STR", "STR-SIM", "STR-NSM"), "map_category": map_category(code, held)}).drop("_r")


#: Longitudes and latitudes are cut into 2^16 steps each, so a place on the curve has 32 bits.
CURVE_BITS = 16
#: Most ranges of the curve that a box is covered by; with fewer, some places outside the box are read too.
MOST_RANGES = 24
WORLD = (-180.0, -90.0, 180.0, 90.0)


def curve_steps(lon: Column, lat: Column) -> tuple[Column, Column]:
    step = lambda x, low, high: F.greatest(F.lit(0), F.least(F.lit((1 << CURVE_BITS) - 1), F.floor((x - low) / (high - low) * (1 << CURVE_BITS)))).cast("long")
    return step(lon, WORLD[0], WORLD[2]), step(lat, WORLD[1], WORLD[3])


def curve_place(lon: Column, lat: Column) -> Column:
    """The place on a Z-shaped curve through all places: the bits of both steps in turn. Null without a position."""
    x, y = curve_steps(lon, lat)
    bits = [F.shiftleft(F.shiftright(v, k).bitwiseAND(F.lit(1)), 2 * k + odd) for odd, v in enumerate((x, y)) for k in range(CURVE_BITS)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def curve_ranges(box: Sequence[float], most: int = MOST_RANGES) -> list[tuple[int, int]]:
    """Ranges of the curve, both ends in, that cover a box: squares inside it whole, squares on its edge cut ever finer."""
    span = [(WORLD[2] - WORLD[0]) / (1 << CURVE_BITS), (WORLD[3] - WORLD[1]) / (1 << CURVE_BITS)]
    top = (1 << CURVE_BITS) - 1
    low = [min(max(int((box[i] - WORLD[i]) // span[i]), 0), top) for i in (0, 1)]
    high = [min(max(int((box[i + 2] - WORLD[i]) // span[i]), 0), top) for i in (0, 1)]
    whole: list[tuple[int, int]] = []
    edge = [(0, 0, CURVE_BITS, 0)]  # x, y, size as a power of two, place of its first corner
    while edge and len(whole) + 4 * len(edge) <= 4 * most:
        finer = []
        for x, y, k, place in edge:
            x2, y2 = x + (1 << k) - 1, y + (1 << k) - 1
            if x2 < low[0] or x > high[0] or y2 < low[1] or y > high[1]:
                continue
            if low[0] <= x and x2 <= high[0] and low[1] <= y and y2 <= high[1]:
                whole.append((place, place + (1 << 2 * k) - 1))
                continue
            half = 1 << (k - 1)
            finer += [(x + half * (q & 1), y + half * (q >> 1), k - 1, place + (q << 2 * (k - 1))) for q in range(4)]
        edge = finer
    cut = whole + [
        (place, place + (1 << 2 * k) - 1) for x, y, k,
        place in edge if not (x + (1 << k) - 1 < low[0] or x > high[0] or y + (1 << k) - 1 < low[1] or y > high[1])
    ]
    joined: list[tuple[int, int]] = []
    for a, b in sorted(cut):
        if joined and a <= joined[-1][1] + 1:
            joined[-1] = (joined[-1][0], max(b, joined[-1][1]))
        else:
            joined.append((a, b))
    while len(joined) > most:  # the smallest gap is read too
        gap = min(range(1, len(joined)), key=lambda i: joined[i][0] - joined[i - 1][1])
        joined[gap - 1 : gap + 1] = [(joined[gap - 1][0], joined[gap][1])]
    return joined


def write_located(nodes: DataFrame, path: str, row_group_kb: int = 1024) -> None:
    """Writes nodes (…, lon, lat) in the order of the curve, with ``curve``; nodes without a position come first."""
    ordered = nodes.withColumn("curve", curve_place(F.col("lon"), F.col("lat")))
    ordered.repartitionByRange("curve").sortWithinPartitions("curve").write.option("parquet.block.size", row_group_kb << 10).parquet(path)


def read_box(spark: SparkSession, path: str, box: Sequence[float]) -> DataFrame:
    """The nodes in a box out of what ``write_located`` wrote: row groups off the box's part of the curve are not read."""
    ranges = reduce(lambda a, b: a | b, (F.col("curve").between(a, b) for a, b in curve_ranges(box)))
    return in_box(spark.read.parquet(path).where(ranges), box).drop("curve")


def nodes_in_bbox(nodes: DataFrame, reservoirs: DataFrame, box: Sequence[float], limit: int) -> DataFrame:
    """Points in a box: storage first, then projects, pumps, sources; larger capacities first, then by name."""
    code = F.coalesce("type", F.lit(""))
    rank = F.when(F.startswith(code, F.lit("STR")), 1).when(F.startswith(code, F.lit("PR-")), 2).when(F.startswith(code, F.lit("PS")), 3).when(F.startswith(code, F.lit("S-")), 4).otherwise(5)
    rows = categorised(in_box(nodes, box), reservoirs)
    return rows.orderBy(rank, F.desc(F.coalesce("capacity_taf", F.lit(0.0))), "name", "id").limit(limit)


def nodes_by_degree(nodes: DataFrame, arcs: DataFrame, reservoirs: DataFrame, box: Sequence[float], limit: int) -> DataFrame:
    """Points in a box, those with most arcs first."""
    rows = categorised(in_box(nodes, box), reservoirs).join(node_degree(arcs), "id", "left").fillna(0, ["connected_arcs"])
    return rows.orderBy(F.desc("connected_arcs"), "name", "id").limit(limit)


def node_degree(arcs: DataFrame) -> DataFrame:
    """Arcs that touch each node; a loop counts once."""
    ends = F.array_distinct(F.array_compact(F.array("from_id", "to_id")))
    return arcs.select(F.explode(ends).alias("id")).groupBy("id").agg(F.count("*").alias("connected_arcs"))


def steps(arcs: DataFrame, direction: str) -> DataFrame:
    """Rows (here, there) that can be walked."""
    down = arcs.where("from_id is not null and to_id is not null").select(F.col("from_id").alias("here"), F.col("to_id").alias("there"))
    up = down.select(F.col("there").alias("here"), F.col("here").alias("there"))
    if direction == "downstream":
        out = down
    elif direction == "upstream":
        out = up
    elif direction == "both":
        out = down.unionByName(up)
    else:
        raise ValueError("direction must be upstream, downstream or both")
    return out.where("here <> there").distinct()


@contextmanager
def adjacency(arcs: DataFrame, direction: str) -> Iterator[DataFrame]:
    """The steps as a table bucketed by ``here``, which joins on ``here`` read without a shuffle; dropped at the end."""
    spark = arcs.sparkSession
    path = shared_path(spark, "steps")
    name, buckets = path.rsplit("/", 1)[-1].replace("-", "_"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps(arcs, direction).repartition(buckets, "here").write.bucketBy(buckets, "here").sortBy("here").format("parquet").option("path", path).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        delete_path(spark, path)


def onward(front: DataFrame, edges: DataFrame) -> DataFrame:
    """The frontier's rows with ``there``, one for each step from ``node``: the frontier is dealt like the edges, or
    sent to all of them where it is small."""
    return front.join(edges, F.col("node") == F.col("here")).drop("here")


def traverse(arcs: DataFrame, start: int, direction: str = "downstream", max_depth: int = 100) -> DataFrame:
    """Simple paths from a node, one row each: node, depth, path. Rounds end when no path grows.

    The number of simple paths may be exponential; ``reach`` is the form for large depths. Every level is written to the
    shared folder, so nothing is held in memory and a lost executor costs one level.
    """
    level = arcs.sparkSession.range(1).select(F.lit(start).cast("long").alias("node"), F.lit(0).alias("depth"), F.array(F.lit(start).cast("long")).alias("path"))
    out = level
    with adjacency(arcs, direction) as edges:
        for depth in range(1, max_depth + 1):
            level = onward(level, edges).where(~F.array_contains("path", F.col("there"))).select(
                F.col("there").cast("long").alias("node"), F.lit(depth).alias("depth"),
                F.array_append("path", F.col("there").cast("long")).alias("path")
            )
            level = written(level, "paths")
            if level.isEmpty():
                break
            out = out.unionByName(level)
    return out


def reach_from(arcs: DataFrame, starts: DataFrame, direction: str = "downstream", max_depth: int = 10) -> DataFrame:
    """Rows (source, node, distance): the nodes that each start (``source``) can reach, itself at 0, all in one run.

    A round takes all sources one step on, so there are as many rounds as for the farthest of them alone, at most
    ``max_depth``. The edges are bucketed once and are not shuffled after that; a node that many sources reach at once
    has a row for each. Every round is written to the shared folder. Null starts are left out, repeats count once, and a
    start that no arc touches reaches itself.
    """
    front = starts.select(F.col("source").cast("long").alias("source")).where("source is not null").distinct()
    seen = front = written(front.select("source", F.col("source").alias("node"), F.lit(0).alias("distance")), "reached")
    with adjacency(arcs, direction) as edges:
        for distance in range(1, max_depth + 1):
            there = onward(front, edges).select("source", F.col("there").cast("long").alias("node")).distinct()
            front = written(there.join(seen, ["source", "node"], "left_anti").select("source", "node", F.lit(distance).alias("distance")), "reached")
            if front.isEmpty():
                break
            seen = seen.unionByName(front)
    return seen


def reach(arcs: DataFrame, start: int, direction: str = "downstream", max_depth: int = 10) -> DataFrame:
    """Nodes that can be reached from one node with their smallest distance, the start at 0."""
    one = arcs.sparkSession.range(1).select(F.lit(start).alias("source"))
    return reach_from(arcs, one, direction, max_depth).drop("source")


def arcs_of(nodes: DataFrame, arcs: DataFrame, names: DataFrame) -> DataFrame:
    """Arcs with an end in a set of nodes (id), with the codes of both ends."""
    ids = nodes.select("id").distinct()
    touched = arcs.join(
        ids.withColumnRenamed("id", "from_id"), "from_id", "left_semi"
    ).unionByName(arcs.join(ids.withColumnRenamed("id", "to_id"), "to_id", "left_semi")).distinct()
    code = lambda end: names.select(F.col("id").alias(f"{end}_id"), F.col("short_code").alias(f"{end}_code"))
    return touched.join(code("from"), "from_id", "left").join(code("to"), "to_id", "left")


def arc_ends(arcs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Two rows for each arc: its from and its to node."""
    ends = arcs.select(
        F.col("id").alias("arc_id"),
        F.explode(F.array(
            F.struct(F.lit("from").alias("end"), F.col("from_id").alias("node_id")),
            F.struct(F.lit("to").alias("end"), F.col("to_id").alias("node_id"))
        )).alias("e")
    ).select("arc_id", "e.end", "e.node_id")
    return ends.join(nodes.select(F.col("id").alias("node_id"), "short_code"), "node_id")


#: Fixed values.
REGION_IDS = {"SAC": 1, "SJR": 2, "DELTA": 3, "TULARE": 4, "SOCAL": 5, "SC": 1}


def map_types(elements: DataFrame, types: DataFrame) -> DataFrame:
    """type_id by ``type-subtype``, else by type, else null; region_id by code."""
    pair, plain = types.select(F.col("type_code").alias("_pair"), F.col("type_id").alias("_a")), types.select(
        F.col("type_code").alias("_plain"), F.col("type_id").alias("_b")
    )
    rows = elements.withColumns({"_pair": F.concat_ws("-", "type", "sub_type"), "_plain": F.col("type")})
    region = F.create_map(*[F.lit(x) for item in REGION_IDS.items() for x in item])
    return rows.join(pair, "_pair", "left").join(plain, "_plain", "left").withColumns({
        "type_id": F.coalesce("_a", "_b"), "region_id": F.try_element_at(region, F.upper("region"))
    }).drop("_pair", "_plain", "_a", "_b")


def arc_connectivity(arcs: DataFrame) -> DataFrame:
    """connected, partial or unconnected."""
    a, b = F.col("from_id").isNotNull(), F.col("to_id").isNotNull()
    return arcs.withColumn("connectivity", F.when(a & b, "connected").when(a | b, "partial").otherwise("unconnected"))


def node_connectivity(nodes: DataFrame, arcs: DataFrame) -> DataFrame:
    """connected or isolated."""
    return nodes.join(node_degree(arcs), "id", "left").withColumn(
        "connectivity", F.when(F.col("connected_arcs") > 0, "connected").otherwise("isolated")
    ).drop("connected_arcs")


def geometry_table(arcs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Geometries of arcs and nodes with a label; rows without code or geometry are left out."""
    own = lambda df, kind: df.select(F.lit(kind).alias("element"), "short_code", "wkt")
    return own(arcs, "arc").unionByName(own(nodes, "node")).where("short_code is not null and short_code <> '' and wkt is not null and wkt <> ''")


def units_by_zone_prefix(nodes: DataFrame) -> DataFrame:
    """Units of each three-character zone prefix, and how many have a geometry."""
    return nodes.where(F.col("short_code").rlike(r"^[0-9]{2}[NS_]")).groupBy(F.substring("short_code", 1, 3).alias("prefix")).agg(
        F.count("*").alias("units"), F.count("wkt").alias("with_geometry")
    )
