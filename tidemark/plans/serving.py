"""Queries of the serving operators (F) and of the network (G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import network as N
from tidemark.operators import serving as V
from tidemark.operators import stats
from tidemark.plans.bindings import OBS, obs
from tidemark.plans.registry import big, query, r, table
from tidemark.sources.shared import shared_path

VALUES = ("delivery_avg", "q50", "exc_p90")
STAT_SQL = (
    f"stat AS (SELECT scenario, entity, {big('water_month')} AS water_month, {r('avg(delivery)')} AS delivery_avg, "
    f"{r('quantile_cont(delivery, 0.5)')} AS q50, nullif({r('quantile_cont(delivery, 0.1)')}, 0.0) AS exc_p90 FROM obs WHERE delivery IS NOT NULL "
    "GROUP BY 1, 2, water_month)"
)
NAMES = (
    "names AS (SELECT s_suppkey AS entity, s_name AS name, n_name AS nation, r_name AS region FROM supplier JOIN nation ON s_nationkey = "
    "n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_suppkey % 10 <> 7)"
)


def monthly(spark, sf):
    return stats.distribution_stats(obs(spark, sf), stats.MONTH, "delivery", "delivery_")


def names(spark, sf):
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, sf, "supplier").where("s_suppkey % 10 <> 7").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("entity"), F.col("s_name").alias("name"), F.col("n_name").alias("nation"), F.col("r_name").alias("region")
    )


@query(
    "f1_nest_monthly",
    f"WITH {OBS}, {STAT_SQL}, {NAMES} SELECT scenario, entity, name, water_month, delivery_avg, q50, exc_p90 FROM stat LEFT JOIN names USING (entity)"
)
def f1(spark, sf):
    nested = V.nest_monthly(monthly(spark, sf), names(spark, sf), VALUES)
    return nested.select("scenario", "entity", "name", F.explode("monthly").alias("water_month", "s")).select("scenario", "entity", "name", "water_month", "s.*")


@query(
    "f2_group_members",
    "WITH m AS (SELECT n_regionkey AS group_id, n_name AS name, n_nationkey AS o FROM nation WHERE n_nationkey % 7 <> 0 AND n_regionkey <> 2) "
    "SELECT CAST(r_regionkey AS BIGINT) AS group_id, r_name AS label, coalesce(list(name ORDER BY o) FILTER (WHERE name IS NOT NULL), []) AS "
    "members, count(name) AS member_count FROM region LEFT JOIN m ON group_id = r_regionkey GROUP BY 1, 2"
)
def f2(spark, sf):
    n = table(spark, sf, "nation")
    members = n.select(
        F.col("n_regionkey").alias("group_id"), F.col("n_nationkey").alias("entity"), F.col("n_nationkey").alias("display_order"),
        ((F.col("n_nationkey") % 7 != 0) & (F.col("n_regionkey") != 2)).alias("is_active")
    )
    return V.group_members(
        table(spark, sf, "region").select(F.col("r_regionkey").alias("group_id"), F.col("r_name").alias("label")), members,
        n.select(F.col("n_nationkey").alias("entity"), F.col("n_name").alias("name"))
    )


@query("f3_scenario_entities", f"WITH {OBS} SELECT scenario, list_sort(list(DISTINCT entity)) AS entities, count(DISTINCT entity) AS entity_count FROM obs GROUP BY 1")
def f3(spark, sf):
    return V.scenario_entities(obs(spark, sf))


@query(
    "f4_scenario_bundle",
    f"WITH {OBS}, {STAT_SQL}, sh AS (SELECT scenario, entity, water_month, {r('avg(shortage)')} AS a FROM obs WHERE shortage IS NOT NULL GROUP "
    "BY 1, 2, 3) SELECT scenario, 'storage' AS kind, CAST(entity AS VARCHAR) AS entity, water_month, q50 AS value FROM stat WHERE scenario IN "
    f"('A', 'R') UNION ALL SELECT scenario, 'urban', CAST(entity AS VARCHAR), {big('water_month')}, a FROM sh WHERE scenario IN ('A', 'R')"
)
def f4(spark, sf):
    rows = obs(spark, sf)
    bundle = V.scenario_bundle(
        ["A", "R"], {"storage": (monthly(spark, sf), ("q50",)), "urban": (stats.shortage_monthly(rows), ("shortage_avg_taf",))}, ["storage", "urban"]
    )
    value = F.coalesce(F.get_json_object("s", "$.q50"), F.get_json_object("s", "$.shortage_avg_taf")).cast("double")
    return bundle.select(
        "scenario", "kind", "entity", F.explode("monthly").alias("water_month", "s")
    ).select("scenario", "kind", "entity", "water_month", value.alias("value"))


@query(
    "f5_scenario_detail",
    "WITH l AS (SELECT DISTINCT c_nationkey AS scenario, c_mktsegment AS name FROM customer WHERE c_custkey % 9 = 0), b AS (SELECT DISTINCT "
    "s_nationkey AS scenario, 'S' || s_suppkey % 5 AS name FROM supplier WHERE s_nationkey <> 4) SELECT CAST(n_nationkey AS BIGINT) AS "
    "scenario, r_name AS climate, coalesce((SELECT list_sort(list(name)) FROM l WHERE l.scenario = n_nationkey), []) AS themes, "
    "coalesce((SELECT list_sort(list(name)) FROM b WHERE b.scenario = n_nationkey), []) AS operations FROM nation LEFT JOIN region ON "
    "r_regionkey = n_regionkey AND r_regionkey <> 1"
)
def f5(spark, sf):
    links = {
        "themes": table(spark, sf, "customer").where("c_custkey % 9 = 0").select(F.col("c_nationkey").alias("scenario"), F.col("c_mktsegment").alias("name")),
        "operations": table(spark, sf, "supplier").where("s_nationkey <> 4").select(
            F.col("s_nationkey").alias("scenario"), F.concat(F.lit("S"), (F.col("s_suppkey") % 5).cast("string")).alias("name")
        ),
    }
    scenarios = table(spark, sf, "nation").select(F.col("n_nationkey").alias("scenario"), F.col("n_regionkey").alias("climate_id"))
    return V.scenario_detail(
        scenarios,
        table(spark, sf, "region").where("r_regionkey <> 1").select(F.col("r_regionkey").alias("climate_id"), F.col("r_name").alias("climate")), links
    ).drop("climate_id")


GROUPS = (
    "g AS (SELECT r_regionkey AS group_id, CASE r_regionkey WHEN 0 THEN 'var_swp_contractor' WHEN 1 THEN 'var_gw_only' WHEN 2 THEN 'other' ELSE "
    "'var_' || r_name END AS group_code, r_regionkey AS display_order, r_regionkey <> 4 AS is_active FROM region)"
)


@query(
    "f6_units_by_group",
    f"WITH {GROUPS}, m AS (SELECT n_regionkey AS group_id, s_suppkey AS entity, s_suppkey AS unit_order FROM supplier JOIN nation ON s_nationkey "
    "= n_nationkey WHERE s_suppkey % 8 <> 0), e AS (SELECT s_suppkey AS entity, CASE WHEN s_suppkey % 3 = 0 THEN repeat(s_name || ' ', 4) END "
    "AS agency, CASE s_suppkey % 4 WHEN 0 THEN 'SAC' WHEN 1 THEN 'SJR' ELSE 'TUL' END AS region FROM supplier WHERE s_suppkey % 5 <> 0) "
    f"SELECT group_code, {big('display_order')} AS display_order, unit_order, entity, CASE WHEN coalesce(agency, '') <> '' THEN entity || ' - ' "
    "|| left(agency, 50) ELSE CAST(entity AS VARCHAR) END AS display_name, CASE WHEN group_code = 'var_swp_contractor' THEN 'SWP' WHEN "
    "group_code = 'var_gw_only' THEN 'GW' WHEN region IN ('SAC', 'SJR') THEN 'CVP' END AS project, CASE WHEN entity % 2 = 0 THEN 'D_' || entity "
    "END AS variable FROM g JOIN m USING (group_id) LEFT JOIN e USING (entity) WHERE is_active AND group_code LIKE 'var\\_%' ESCAPE '\\'",
)
def f6(spark, sf):
    k, g = F.col("s_suppkey"), F.col("r_regionkey")
    groups = table(spark, sf, "region").select(
        g.alias("group_id"),
        F.when(g == 0, "var_swp_contractor").when(g == 1, "var_gw_only").when(g == 2, "other").otherwise(F.concat(F.lit("var_"), F.col("r_name"))).alias("group_code"),
        g.alias("display_order"), (g != 4).alias("is_active")
    )
    s = table(spark, sf, "supplier")
    members = s.join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_regionkey").alias("group_id"), k.alias("entity"), k.alias("display_order"), (k % 8 != 0).alias("is_active")
    )
    entities = s.where("s_suppkey % 5 <> 0").select(
        k.alias("entity"), F.when(k % 3 == 0, F.repeat(F.concat("s_name", F.lit(" ")), 4)).alias("agency"),
        F.when(k % 4 == 0, "SAC").when(k % 4 == 1, "SJR").otherwise("TUL").alias("region")
    )
    return V.units_by_group(groups, members, entities, s.where("s_suppkey % 2 = 0").select(k.alias("entity"), F.concat(F.lit("D_"), k.cast("string")).alias("variable")))


@query(
    "f7_single_unit_record",
    f"WITH {OBS}, u AS (SELECT scenario, entity, count(*) AS n FROM obs WHERE entity = 12 GROUP BY 1, 2), d AS (SELECT scenario, count(DISTINCT "
    "water_month) AS months FROM obs WHERE entity = 12 AND delivery IS NOT NULL GROUP BY 1) SELECT u.scenario, u.entity, u.n, "
    f"'Supplier#000000012' AS name, coalesce(d.months, 0) AS delivery_months, {big('0')} AS shortage_months FROM u LEFT JOIN d USING (scenario)"
)
def f7(spark, sf):
    one = obs(spark, sf).where("entity = 12")
    period = one.groupBy("scenario", "entity").agg(F.count("*").alias("n"))
    unit = table(spark, sf, "supplier").where("s_suppkey = 12").select(F.col("s_suppkey").alias("entity"), F.col("s_name").alias("name"))
    out = V.single_unit_record(unit, period, stats.distribution_stats(one, stats.MONTH, "delivery", "delivery_"), stats.shortage_monthly(one.where("false")), VALUES)
    return out.select("scenario", "entity", "n", "name", F.size("delivery").alias("delivery_months"), F.size("shortage").alias("shortage_months"))


@query(
    "f8_stats_with_entity",
    f"WITH {OBS}, {STAT_SQL}, {NAMES} SELECT scenario, entity, water_month, q50, name, nation, region FROM stat LEFT JOIN names USING (entity) WHERE scenario = 'A'"
)
def f8(spark, sf):
    rows = monthly(spark, sf).where("scenario = 'A'").select("scenario", "entity", "water_month", "q50")
    return V.stats_with_entity(rows, names(spark, sf), ["region", "entity", "water_month"])


MEMBERS = (
    "m AS (SELECT s_suppkey AS entity, 'g' || s_suppkey % 3 AS \"group\", 2 AS display_order FROM supplier WHERE s_suppkey % 4 <> 0 UNION ALL "
    "SELECT s_suppkey, 'all', 1 FROM supplier WHERE s_suppkey % 2 = 0)"
)
for _name, _group in (("all", None), ("one", "g1")):
    query(
        f"f9_mapping_with_groups_{_name}",
        (
            f"WITH {NAMES}, {MEMBERS}, g AS (SELECT entity, list(\"group\" ORDER BY display_order, \"group\") AS groups FROM m GROUP BY 1) SELECT "
            "s_suppkey AS entity, 'D_' || s_suppkey AS variable, name, nation, region, coalesce(groups, []) AS groups FROM supplier LEFT JOIN names "
            "ON names.entity = s_suppkey LEFT JOIN g ON g.entity = s_suppkey"
        ) + (f" WHERE s_suppkey IN (SELECT entity FROM m WHERE \"group\" = '{_group}')" if _group else "")
    )(lambda spark, sf, group=_group: _mapping(spark, sf, group))


def _mapping(spark, sf, group):
    s, k = table(spark, sf, "supplier"), F.col("s_suppkey")
    members = s.where("s_suppkey % 4 <> 0").select(
        k.alias("entity"), F.concat(F.lit("g"), (k % 3).cast("string")).alias("group"), F.lit(2).alias("display_order")
    ).unionByName(s.where("s_suppkey % 2 = 0").select(k.alias("entity"), F.lit("all").alias("group"), F.lit(1).alias("display_order")))
    return V.mapping_with_groups(s.select(k.alias("entity"), F.concat(F.lit("D_"), k.cast("string")).alias("variable")), names(spark, sf), members, group)


for _name, _table, _where in (("family", "orders", "o_orderkey % 3 = 1"), ("no_family", "other", "true")):
    query(
        f"f10_current_version_{_name}", f"SELECT o_orderkey AS k, o_orderkey % 3 AS version_id FROM orders WHERE {_where}"
    )(lambda spark, sf, name=_table: _versioned(spark, sf, name))


def _versioned(spark, sf, name):
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 3).alias("version_id"))
    region = table(spark, sf, "region")
    families = region.where("r_regionkey = 0").select(F.lit("orders").alias("table"), F.lit("data").alias("family"))
    versions = region.select(
        F.col("r_regionkey").cast("long").alias("version_id"), F.when(F.col("r_regionkey") < 3, "data").otherwise("other").alias("family"),
        F.col("r_regionkey").isin(1, 4).alias("is_active")
    )
    return V.current_version_rows(rows, name, families, versions)


# Network: nodes are customers in the order of a heap, k // 2 -> k, so depth grows with the table; some arcs lead back,
# and some have a missing end or are loops.

ARCS = (
    "arcs AS (SELECT c_custkey * 2 AS id, CASE WHEN c_custkey % 97 <> 0 THEN c_custkey // 2 END AS from_id, c_custkey AS to_id FROM customer UNION "
    "ALL SELECT c_custkey * 2 + 1, c_custkey, CASE WHEN c_custkey % 60 = 0 THEN c_custkey ELSE c_custkey // 5 END FROM customer WHERE c_custkey % "
    "20 = 0)"
)
PLACED = (
    "nodes AS (SELECT s_suppkey AS id, 'N' || s_suppkey AS short_code, s_name AS name, CASE s_suppkey % 8 WHEN 0 THEN 'STR' WHEN 1 THEN 'PS-A' WHEN "
    "2 THEN 'WTP1' WHEN 3 THEN 'WWTP' WHEN 4 THEN 'PR-X' WHEN 5 THEN 'S-1' WHEN 6 THEN 'CH' END AS type, CASE WHEN s_suppkey % 11 <> 0 THEN "
    "-125.0::DOUBLE + s_suppkey % 10 END AS lon, CASE WHEN s_suppkey % 11 <> 0 THEN 32.0::DOUBLE + s_suppkey % 9 END AS lat FROM supplier)"
)
HELD = "held AS (SELECT s_suppkey AS id, abs(s_acctbal) AS capacity_taf FROM supplier WHERE s_suppkey % 6 = 0)"
CATEGORY = (
    "CASE WHEN h.id IS NOT NULL OR n.type IN ('STR', 'STR-SIM', 'STR-NSM') THEN 'reservoir' WHEN n.type LIKE 'PS%' THEN 'pump_station' WHEN n.type "
    "LIKE 'WTP%' THEN 'water_treatment' WHEN n.type = 'WWTP' THEN 'wastewater_treatment' WHEN n.type LIKE 'PR-%' THEN 'project' WHEN n.type LIKE "
    "'S-%' THEN 'source' ELSE 'other' END"
)
FOUND = f"SELECT n.id, n.short_code, n.name, n.type, n.lon, n.lat, h.capacity_taf, h.id IS NOT NULL OR coalesce(n.type, '') = 'STR' AS is_reservoir, {CATEGORY} AS map_category"
BOX = (-124.0, 33.0, -118.0, 38.0)
IN_BOX = "n.lon BETWEEN -124 AND -118 AND n.lat BETWEEN 33 AND 38"


def arcs(spark, sf):
    c, k = table(spark, sf, "customer"), F.col("c_custkey")
    back = F.when(k % 60 == 0, k).otherwise(F.expr("c_custkey div 5"))
    return c.select(
        (k * 2).alias("id"), F.when(k % 97 != 0, F.expr("c_custkey div 2")).alias("from_id"), k.alias("to_id")
    ).unionByName(c.where("c_custkey % 20 = 0").select((k * 2 + 1).alias("id"), k.alias("from_id"), back.alias("to_id")))


def nodes(spark, sf):
    k = F.col("s_suppkey")
    kind = F.when(k % 8 == 0, "STR").when(k % 8 == 1, "PS-A").when(k % 8 == 2, "WTP1").when(k % 8 == 3, "WWTP").when(k % 8 == 4, "PR-X").when(k % 8 == 5, "S-1").when(k % 8 == 6, "CH")
    at = lambda c: F.when(k % 11 != 0, c)
    return table(spark, sf, "supplier").select(
        k.alias("id"), F.concat(F.lit("N"), k.cast("string")).alias("short_code"), F.col("s_name").alias("name"), kind.alias("type"),
        at(k % 10 - 125.0).alias("lon"), at(k % 9 + 32.0).alias("lat")
    )


def held(spark, sf):
    return table(spark, sf, "supplier").where("s_suppkey % 6 = 0").select(F.col("s_suppkey").alias("id"), F.abs("s_acctbal").alias("capacity_taf"))


def big_arcs(spark, sf):
    """Arcs between suppliers by customers, many for each node."""
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(k.alias("id"), F.when(k % 23 != 0, k % 100).alias("from_id"), F.when(k % 29 != 0, k * 7 % 90).alias("to_id"))


BIG_ARCS = "arcs AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 23 <> 0 THEN c_custkey % 100 END AS from_id, CASE WHEN c_custkey % 29 <> 0 THEN c_custkey * 7 % 90 END AS to_id FROM customer)"
DEGREE = (
    "degree AS (SELECT id, count(*) AS connected_arcs FROM (SELECT from_id AS id FROM arcs WHERE from_id IS NOT NULL UNION ALL SELECT to_id FROM "
    "arcs WHERE to_id IS NOT NULL AND to_id IS DISTINCT FROM from_id) GROUP BY 1)"
)


@query(
    "g1_node_list",
    f"WITH {PLACED}, x AS (SELECT n.id, short_code, type, r_name AS region, lon, lat FROM nodes n LEFT JOIN region ON r_regionkey = n.id % 6 "
    f"WHERE lon IS NOT NULL) SELECT id, short_code, type, region, lon, lat, '{{\"short_code\":\"' || short_code || '\"' || CASE WHEN type IS "
    "NULL THEN '' ELSE ',\"type\":\"' || type || '\"' END || CASE WHEN region IS NULL THEN '' ELSE ',\"region\":\"' || region || '\"' END || "
    f"'}}' AS attributes FROM x ORDER BY id LIMIT 50"
)
def g1(spark, sf):
    rows = nodes(spark, sf).withColumns({"type_id": F.col("id") % 8, "region_id": F.col("id") % 6})
    types = rows.select("type_id", "type").distinct()
    regions = table(spark, sf, "region").select(F.col("r_regionkey").cast("long").alias("region_id"), F.col("r_name").alias("region"))
    return N.node_list(rows.drop("type"), types, regions, limit=50)


@query(
    "g2_nodes_in_bbox",
    f"WITH {PLACED}, {HELD} {FOUND} FROM nodes n LEFT JOIN held h USING (id) WHERE {IN_BOX} ORDER BY CASE WHEN n.type LIKE 'STR%' THEN 1 WHEN "
    "n.type LIKE 'PR-%' THEN 2 WHEN n.type LIKE 'PS%' THEN 3 WHEN n.type LIKE 'S-%' THEN 4 ELSE 5 END, coalesce(h.capacity_taf, 0) DESC, "
    "n.name, n.id LIMIT 20"
)
def g2(spark, sf):
    return N.nodes_in_bbox(nodes(spark, sf), held(spark, sf), BOX, 20)


@query(
    "g3_nodes_by_degree",
    f"WITH {PLACED}, {HELD}, {BIG_ARCS}, {DEGREE} {FOUND}, coalesce(d.connected_arcs, 0) AS connected_arcs FROM nodes n LEFT JOIN held h USING "
    f"(id) LEFT JOIN degree d USING (id) WHERE {IN_BOX} ORDER BY coalesce(d.connected_arcs, 0) DESC, n.name, n.id LIMIT 20"
)
def g3(spark, sf):
    return N.nodes_by_degree(nodes(spark, sf), big_arcs(spark, sf), held(spark, sf), BOX, 20)


@query("g4_node_degree", f"WITH {BIG_ARCS}, {DEGREE} SELECT * FROM degree")
def g4(spark, sf):
    return N.node_degree(big_arcs(spark, sf))


STEPS = {
    "downstream": "SELECT DISTINCT from_id AS a, to_id AS b FROM arcs WHERE from_id <> to_id",
    "upstream": "SELECT DISTINCT to_id AS a, from_id AS b FROM arcs WHERE from_id <> to_id",
    "both": "SELECT from_id AS a, to_id AS b FROM arcs WHERE from_id <> to_id UNION SELECT to_id, from_id FROM arcs WHERE from_id <> to_id"
}
for _way, _start, _depth, _far in (("downstream", 1, 10, 40), ("upstream", 100, 10, 40), ("both", 100, 5, 8)):
    query(
        f"g5_traverse_{_way}",
        f"WITH RECURSIVE {ARCS}, steps AS ({STEPS[_way]}), walk(node, depth, path) AS (SELECT CAST({_start} AS BIGINT), CAST(0 AS BIGINT), "
        f"[CAST({_start} AS BIGINT)] UNION ALL SELECT CAST(b AS BIGINT), depth + 1, list_append(path, CAST(b AS BIGINT)) FROM walk JOIN steps ON "
        f"a = node WHERE depth < {_depth} AND NOT list_contains(path, CAST(b AS BIGINT))) SELECT node, depth, array_to_string(path, '>') AS path "
        "FROM walk",
    )(
        lambda spark, sf, way=_way, start=_start,
        depth=_depth: N.traverse(arcs(spark, sf), start, way, depth).withColumn("path", F.array_join(F.col("path").cast("array<string>"), ">"))
    )
    query(
        f"g6_reach_{_way}",
        f"WITH RECURSIVE {ARCS}, steps AS ({STEPS[_way]}), walk(node, distance) AS (SELECT CAST({_start} AS BIGINT), CAST(0 AS BIGINT) UNION "
        f"SELECT CAST(b AS BIGINT), distance + 1 FROM walk JOIN steps ON a = node WHERE distance < {_far}) SELECT node, min(distance) AS "
        "distance FROM walk GROUP BY 1",
    )(lambda spark, sf, way=_way, start=_start, far=_far: N.reach(arcs(spark, sf), start, way, far))


FROM_MANY = (
    f"WITH RECURSIVE {ARCS}, steps AS ({STEPS['upstream']}), walk(source, node, distance) AS (SELECT c_custkey, c_custkey, CAST(0 AS BIGINT) FROM "
    "customer WHERE c_nationkey = 3 UNION SELECT source, CAST(b AS BIGINT), distance + 1 FROM walk JOIN steps ON a = node WHERE distance < 40)"
)


@query("g6_reach_from_many", f"{FROM_MANY} SELECT source, node, min(distance) AS distance FROM walk GROUP BY 1, 2")
def g6_many(spark, sf):
    """Everything upstream of all nodes of one nation, in one run."""
    starts = table(spark, sf, "customer").where("c_nationkey = 3").select(F.col("c_custkey").alias("source"))
    return N.reach_from(arcs(spark, sf), starts, "upstream", 40)


LOCATED = "placed AS (SELECT o_orderkey AS id, -124.5 + (o_custkey * 37 % 1009) / 100.0::DOUBLE AS lon, 32.0 + (o_orderkey * 53 % 997) / 100.0::DOUBLE AS lat FROM orders WHERE o_orderkey % 11 <> 0)"


@query("g2_nodes_by_curve", f"WITH {LOCATED} SELECT id, lon, lat FROM placed WHERE lon BETWEEN -122.3 AND -120.9 AND lat BETWEEN 37.1 AND 38.7")
def g2_curve(spark, sf):
    """Nodes written along a space-filling curve and read back by a box, whose ranges are filters on the scan."""
    k, at = F.col("o_orderkey"), lambda c: F.when(F.col("o_orderkey") % 11 != 0, c)
    path = shared_path(spark, "located")
    N.write_located(
        table(spark, sf, "orders").select(
            k.alias("id"), at(F.lit(-124.5) + (F.col("o_custkey") * 37 % 1009) / 100).alias("lon"),
            at(F.lit(32.0) + (k * 53 % 997) / 100).alias("lat")
        ),
        path
    )
    return N.read_box(spark, path, (-122.3, 37.1, -120.9, 38.7))


@query(
    "g7_arcs_of",
    f"WITH {ARCS} SELECT {big('id')} AS id, {big('from_id')} AS from_id, {big('to_id')} AS to_id, a.c_name AS from_code, b.c_name AS to_code "
    "FROM arcs LEFT JOIN customer a ON a.c_custkey = from_id LEFT JOIN customer b ON b.c_custkey = to_id WHERE from_id IN (SELECT c_custkey "
    "FROM customer WHERE c_nationkey = 7) OR to_id IN (SELECT c_custkey FROM customer WHERE c_nationkey = 7)"
)
def g7(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("short_code"), "c_nationkey")
    return N.arcs_of(c.where("c_nationkey = 7"), arcs(spark, sf), c)


@query(
    "g8_arc_ends",
    f"WITH {BIG_ARCS}, e AS (SELECT id AS arc_id, 'from' AS \"end\", from_id AS node_id FROM arcs UNION ALL SELECT id, 'to', to_id FROM arcs) "
    "SELECT arc_id, \"end\", node_id, 'N' || s_suppkey AS short_code FROM e JOIN supplier ON s_suppkey = node_id"
)
def g8(spark, sf):
    return N.arc_ends(big_arcs(spark, sf), nodes(spark, sf))


@query(
    "g9_map_types",
    "WITH t AS (SELECT n_nationkey AS type_id, CASE WHEN n_nationkey % 2 = 0 THEN p_type ELSE p_type || '-' || n_nationkey END AS type_code "
    "FROM nation JOIN (SELECT DISTINCT p_type, dense_rank() OVER (ORDER BY p_type) AS k FROM part) ON k = n_nationkey % 6 + 1 WHERE n_nationkey "
    "< 12) SELECT p_partkey AS id, CAST(coalesce(a.type_id, b.type_id) AS BIGINT) AS type_id, CAST(CASE p_size % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 "
    "WHEN 2 THEN 1 END AS BIGINT) AS region_id FROM part LEFT JOIN t a ON a.type_code = p_type || '-' || p_size LEFT JOIN t b ON b.type_code = "
    "p_type"
)
def g9(spark, sf):
    from pyspark.sql import Window

    p = table(spark, sf, "part")
    kinds = p.select("p_type").distinct().withColumn("k", F.row_number().over(Window.orderBy("p_type")))
    k = F.col("n_nationkey")
    types = table(spark, sf, "nation").where("n_nationkey < 12").join(kinds, k % 6 + 1 == F.col("k")).select(
        k.alias("type_id"), F.when(k % 2 == 0, F.col("p_type")).otherwise(F.concat_ws("-", "p_type", k.cast("string"))).alias("type_code")
    )
    s = F.col("p_size") % 4
    rows = p.select(
        F.col("p_partkey").alias("id"), F.col("p_type").alias("type"), F.col("p_size").cast("string").alias("sub_type"),
        F.when(s == 0, "SAC").when(s == 1, "SJR").when(s == 2, "SC").otherwise("??").alias("region")
    )
    return N.map_types(rows, types).select("id", "type_id", "region_id")


@query(
    "g10_arc_connectivity",
    f"WITH {BIG_ARCS} SELECT id, CASE WHEN from_id IS NOT NULL AND to_id IS NOT NULL THEN 'connected' WHEN from_id IS NULL AND to_id IS NULL "
    "THEN 'unconnected' ELSE 'partial' END AS connectivity FROM arcs"
)
def g10_arcs(spark, sf):
    return N.arc_connectivity(big_arcs(spark, sf)).select("id", "connectivity")


@query(
    "g10_node_connectivity",
    f"WITH {BIG_ARCS} SELECT p_partkey AS id, CASE WHEN p_partkey IN (SELECT from_id FROM arcs WHERE from_id IS NOT NULL UNION SELECT to_id FROM "
    "arcs WHERE to_id IS NOT NULL) THEN 'connected' ELSE 'isolated' END AS connectivity FROM part"
)
def g10_nodes(spark, sf):
    return N.node_connectivity(table(spark, sf, "part").select(F.col("p_partkey").alias("id")), big_arcs(spark, sf)).select("id", "connectivity")


@query(
    "g11_geometry_table",
    "SELECT 'arc' AS element, p_name AS short_code, 'LINESTRING ' || p_size AS wkt FROM part WHERE p_partkey % 4 <> 0 UNION ALL SELECT 'node', "
    "s_name, 'POINT ' || s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0"
)
def g11(spark, sf):
    arcs_ = table(spark, sf, "part").select(
        F.col("p_name").alias("short_code"),
        F.when(F.col("p_partkey") % 4 != 0, F.concat(F.lit("LINESTRING "), F.col("p_size").cast("string"))).alias("wkt")
    )
    return N.geometry_table(
        arcs_,
        table(spark, sf, "supplier").select(
            F.when(F.col("s_suppkey") % 3 != 0, F.col("s_name")).alias("short_code"),
            F.concat(F.lit("POINT "), F.col("s_suppkey").cast("string")).alias("wkt")
        )
    )


@query(
    "g12_units_by_zone_prefix",
    "WITH x AS (SELECT CASE WHEN p_size < 10 THEN '0' ELSE '' END || p_size || CASE p_partkey % 4 WHEN 0 THEN 'N' WHEN 1 THEN '_' WHEN 2 THEN "
    "'S' ELSE 'X' END || p_brand AS code, p_partkey % 5 <> 0 AS located FROM part) SELECT left(code, 3) AS prefix, count(*) AS units, count(*) "
    "FILTER (WHERE located) AS with_geometry FROM x WHERE code NOT LIKE '__X%' GROUP BY 1"
)
def g12(spark, sf):
    k = F.col("p_partkey") % 4
    code = F.concat(F.lpad(F.col("p_size").cast("string"), 2, "0"), F.when(k == 0, "N").when(k == 1, "_").when(k == 2, "S").otherwise("X"), F.col("p_brand"))
    return N.units_by_zone_prefix(table(spark, sf, "part").select(code.alias("short_code"), F.when(F.col("p_partkey") % 5 != 0, "POINT (1 1)").alias("wkt")))
