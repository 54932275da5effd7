"""Queries of the series operators (C) and of member numbering (I1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalars import rounded
from tidemark.operators import search
from tidemark.operators import series as S
from tidemark.plans.bindings import OBS, obs
from tidemark.plans.registry import big, query, r, table
from tidemark.sources.shared import shared_path

SERIES_SQL = """series AS (SELECT o_orderstatus AS scenario, 'V' || o_custkey % 60 AS variable, CAST(o_orderdate AS DATE) AS ts,
  CASE WHEN o_orderkey % 71 <> 0 THEN o_totalprice END AS value FROM orders)"""
MONTHLY_SQL = f"""{SERIES_SQL}, monthly AS (SELECT scenario, variable, CAST(date_trunc('month', ts) AS DATE) AS ts,
  CASE WHEN count(value) = count(*) THEN sum(value) END AS value FROM series GROUP BY 1, 2, 3)"""


def series(spark, sf):
    gap = F.when(F.col("o_orderkey") % 71 != 0, F.col("o_totalprice"))
    return table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("scenario"), F.concat(F.lit("V"), (F.col("o_custkey") % 60).cast("string")).alias("variable"),
        F.col("o_orderdate").cast("date").alias("ts"), gap.alias("value")
    )


def monthly(spark, sf):
    """One value for each scenario, variable and month; missing where any day's is."""
    rows = series(spark, sf).groupBy("scenario", "variable", F.trunc("ts", "month").alias("ts")).agg(
        F.sum("value").alias("s"), F.count("value").alias("n"), F.count("*").alias("all")
    )
    return rows.select("scenario", "variable", "ts", F.when(F.col("n") == F.col("all"), F.col("s")).alias("value"))


def suppliers(spark, sf):
    return table(spark, sf, "supplier")


def v(expr):
    return F.concat(F.lit("V"), expr.cast("string"))


def rounded_rows(df, *keys):
    return df.select(*keys, rounded(F.col("value")).alias("value"))


@query(
    "c1_map_entity_series",
    f"WITH {SERIES_SQL}, m AS (SELECT s_suppkey AS entity, CASE WHEN s_suppkey % 6 = 0 THEN 'NOT_FOUND' WHEN s_suppkey % 7 <> 0 THEN 'V' || "
    f"s_suppkey % 60 END AS variable FROM supplier WHERE s_suppkey % 5 <> 0) SELECT scenario, entity, ts, {r('value')} AS value FROM series JOIN "
    "m USING (variable)"
)
def c1(spark, sf):
    k = F.col("s_suppkey")
    mapping = suppliers(spark, sf).select(
        k.alias("entity"), F.when(k % 6 == 0, S.NOT_FOUND).when(k % 7 != 0, v(k % 60)).alias("delivery"), (k % 5 != 0).alias("is_active")
    )
    points = series(spark, sf).withColumn("value", rounded(F.col("value")))  # once for a point, not for each of its entities
    return S.map_entity_series(points, mapping, "delivery")


ARCS_SQL = "arcs AS (SELECT s_suppkey AS entity, unnest(['V' || s_suppkey % 60, 'V' || s_suppkey * 7 % 65]) AS variable FROM supplier)"


def _arcs(spark, sf):
    k = F.col("s_suppkey")
    return suppliers(spark, sf).select(k.alias("entity"), F.explode(F.array(v(k % 60), v(k * 7 % 65))).alias("variable"))


@query(
    "c2_sum_arcs_lenient",
    f"WITH {MONTHLY_SQL}, {ARCS_SQL}, x AS (SELECT scenario, entity, ts, coalesce(sum(value), 0.0) AS value FROM monthly JOIN arcs USING "
    f"(variable) GROUP BY 1, 2, 3) SELECT scenario, entity, ts, {r('value')} AS value FROM x"
)
def c2(spark, sf):
    return rounded_rows(S.sum_arcs(monthly(spark, sf), _arcs(spark, sf)), "scenario", "entity", "ts")


@query(
    "c3_sum_arcs_strict",
    f"WITH {MONTHLY_SQL}, {ARCS_SQL}, x AS (SELECT scenario, entity, ts, CASE WHEN count(value) = 2 THEN sum(value) END AS value FROM monthly "
    f"JOIN arcs USING (variable) GROUP BY 1, 2, 3) SELECT scenario, entity, ts, {r('value')} AS value FROM x"
)
def c3(spark, sf):
    return rounded_rows(S.sum_arcs(monthly(spark, sf), _arcs(spark, sf), strict=True), "scenario", "entity", "ts")


UNIT = (
    "CASE WHEN p_partkey % 3 = 0 THEN lpad(CAST(p_partkey % 50 AS VARCHAR), 2, '0') || CASE WHEN p_partkey % 2 = 0 THEN '_NU' ELSE '_PU' END || "
    "CAST(p_partkey AS VARCHAR) WHEN p_partkey % 3 = 1 THEN 'TOWN' || CAST(p_partkey AS VARCHAR) ELSE 'CITY_NU' || CAST(p_partkey AS VARCHAR) END"
)


@query(
    "c4_resolve_variable",
    f"WITH e AS (SELECT p_partkey AS k, {UNIT} AS entity FROM part), a AS (SELECT CASE k % 5 WHEN 0 THEN 'DN_' WHEN 1 THEN 'GP_' WHEN 2 THEN "
    "'D_' WHEN 3 THEN 'XX_' ELSE 'D_' END || entity || CASE WHEN k % 5 = 4 THEN '_NU' ELSE '' END AS variable FROM e), "
    "s AS (SELECT entity, CASE WHEN k % 22 = 0 THEN 'DN_' || entity END AS variable FROM e WHERE k % 11 = 0), "
    "t AS (SELECT entity, unnest([1, 2, 3, 4, 5, 6]) AS rank FROM e WHERE entity NOT IN (SELECT entity FROM s)), "
    "n AS (SELECT entity, rank, CASE WHEN rank = 1 AND (regexp_matches(entity, '^(\\d+[NS]?)_(PU|NU|SU)\\d*$') OR contains(entity, '_') OR "
    "entity LIKE '%3') THEN 'DN_' || entity WHEN rank = 2 AND regexp_matches(entity, '^(\\d+[NS]?)_(PU|NU|SU)\\d*$') AND contains(entity, "
    "'_NU') THEN 'GP_' || entity "
    "WHEN rank = 3 THEN 'D_' || entity || '_NU' WHEN rank = 4 THEN 'D_' || entity WHEN rank = 5 THEN 'DN_' || entity WHEN rank = 6 AND "
    "contains(entity, '_NU') THEN 'GP_' || entity END AS variable FROM t UNION ALL SELECT entity, 0, variable FROM s), "
    "b AS (SELECT entity, arg_min(variable, rank) AS variable FROM n WHERE variable IN (SELECT variable FROM a) GROUP BY entity) SELECT e.entity, b.variable FROM e LEFT JOIN b USING (entity)",
)
def c4(spark, sf):
    k = F.col("p_partkey")
    entity = F.when(
        k % 3 == 0, F.concat(F.lpad((k % 50).cast("string"), 2, "0"), F.when(k % 2 == 0, "_NU").otherwise("_PU"), k.cast("string"))
    ).when(k % 3 == 1, F.concat(F.lit("TOWN"), k.cast("string"))).otherwise(F.concat(F.lit("CITY_NU"), k.cast("string")))
    e = table(spark, sf, "part").select(k.alias("k"), entity.alias("entity"))
    n = F.col("k") % 5
    available = e.select(F.concat(
        F.when(n == 0, "DN_").when(n == 1, "GP_").when(n == 3, "XX_").otherwise("D_"), F.col("entity"), F.when(n == 4, "_NU").otherwise("")
    ).alias("variable"))
    special = e.where("k % 11 = 0").select("entity", F.when(F.col("k") % 22 == 0, F.concat(F.lit("DN_"), F.col("entity"))).alias("variable"))
    return S.resolve_variable(e, available, special)


@query(
    "c5_overlay_sources",
    f"WITH {SERIES_SQL}, o AS (SELECT scenario, variable, ts, value * 0.5 AS value FROM series WHERE variable IN ('V1', 'V2', 'V3') AND scenario "
    "<> 'F' AND day(ts) <= 20), u AS (SELECT scenario, variable, ts, value, 'CFS' AS unit FROM series WHERE (scenario, variable) NOT IN (SELECT "
    f"(scenario, variable) FROM o) UNION ALL SELECT *, 'TAF' FROM o) SELECT scenario, variable, unit, ts, {r('value')} AS value FROM u"
)
def c5(spark, sf):
    main = series(spark, sf).withColumn("unit", F.lit("CFS"))
    over = main.where("variable in ('V1', 'V2', 'V3') and scenario <> 'F' and day(ts) <= 20").withColumn("value", F.col("value") * 0.5)
    return rounded_rows(S.overlay_sources(main, over), "scenario", "variable", "unit", "ts")


@query(
    "c6_discover_entities",
    "SELECT DISTINCT p_size || '_' || p_brand AS entity, CAST(p_size AS VARCHAR) AS zone FROM part WHERE p_partkey % 4 <> 0 AND p_partkey % 4 <> 3"
)
def c6(spark, sf):
    k = F.col("p_partkey")
    name = F.concat(F.when(k % 4 == 0, "GP_").otherwise("DN_"), F.col("p_size").cast("string"), F.lit("_"), F.col("p_brand"), F.when(k % 4 == 3, "_SHORT").otherwise(""))
    return S.discover_entities(table(spark, sf, "part").select(name.alias("variable")), "DN_", ("_SHORT",))


@query(
    "c7_groundwater_pumping",
    f"WITH {OBS}, x AS (SELECT scenario, entity, pumping IS NULL AS is_calculated, greatest(coalesce(pumping, demand - coalesce(delivery, 0.0)), "
    f"0.0) AS gw FROM obs) SELECT scenario, entity, is_calculated, {r('sum(gw)', 4)} AS gw_pumping FROM x GROUP BY 1, 2, 3"
)
def c7(spark, sf):
    return S.groundwater_pumping(obs(spark, sf)).groupBy("scenario", "entity", "is_calculated").agg(rounded(F.sum("gw_pumping"), 4).alias("gw_pumping"))


@query(
    "c8_exclude_regions",
    "SELECT s_suppkey AS entity, n_name AS zone FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey AND n_nationkey <> 3 WHERE coalesce(n_name, '') NOT IN ('NATION_1', 'NATION_15')"
)
def c8(spark, sf):
    n = table(spark, sf, "nation").where("n_nationkey <> 3")
    rows = suppliers(spark, sf).join(n, F.col("n_nationkey") == F.col("s_nationkey"), "left").select(F.col("s_suppkey").alias("entity"), F.col("n_name").alias("zone"))
    return S.exclude_regions(rows, ["NATION_1", "NATION_15"])


@query(
    "c9_back_calculate_demand",
    f"WITH {MONTHLY_SQL}, terms AS (SELECT n_nationkey AS district, 'V' || n_nationkey AS dv, 'V' || n_nationkey + 25 AS sv, 'V' || (n_nationkey "
    "+ 7) % 60 AS av FROM nation UNION ALL SELECT n_nationkey, 'V' || n_nationkey + 30, 'V' || n_nationkey + 31, 'V' || n_nationkey % 3 FROM "
    "nation WHERE n_nationkey % 4 = 0), "
    "x AS (SELECT t.district, d.scenario, d.ts, d.value AS delivery, CASE WHEN a.value > 0 THEN (coalesce(d.value, 0.0) + coalesce(s.value, "
    "0.0)) / (a.value / 100) END AS need FROM terms t JOIN monthly d ON d.variable = t.dv LEFT JOIN monthly s ON s.variable = t.sv AND "
    "s.scenario = d.scenario AND s.ts = d.ts LEFT JOIN monthly a ON a.variable = t.av AND a.scenario = d.scenario AND a.ts = d.ts), "
    f"y AS (SELECT district, scenario, ts, sum(need) AS demand, sum(delivery) AS delivery FROM x GROUP BY 1, 2, 3) SELECT {big('district')} AS "
    f"district, scenario, ts, {r('demand', 4)} AS demand, {r('CASE WHEN demand > 0 THEN delivery * 100 / demand END', 4)} AS pct_of_demand FROM "
    "y",
)
def c9(spark, sf):
    k = F.col("n_nationkey")
    n = table(spark, sf, "nation")
    terms = n.select(k.alias("district"), v(k).alias("delivery_variable"), v(k + 25).alias("shortage_variable"), v((k + 7) % 60).alias("allocation_variable"))
    terms = terms.unionByName(n.where("n_nationkey % 4 = 0").select(
        k.alias("district"), v(k + 30).alias("delivery_variable"), v(k + 31).alias("shortage_variable"), v(k % 3).alias("allocation_variable")
    ))
    out = S.back_calculate_demand(monthly(spark, sf), terms)
    return out.select("district", "scenario", "ts", rounded(F.col("demand"), 4).alias("demand"), rounded(F.col("pct_of_demand"), 4).alias("pct_of_demand"))


THRESHOLD_SQL = (
    f"WITH {MONTHLY_SQL}, t AS (SELECT s_suppkey AS entity, CASE WHEN s_suppkey % 3 = 0 THEN 'V' || s_suppkey % 70 END AS variable, CASE WHEN "
    "s_suppkey % 3 = 1 THEN 1000.0::DOUBLE + s_suppkey END AS constant, s_acctbal AS dead_pool_taf FROM supplier), rows AS (SELECT DISTINCT "
    "o_orderstatus AS scenario, t.entity, CAST(date_trunc('month', o_orderdate) AS DATE) AS ts, t.dead_pool_taf FROM orders JOIN lineitem ON "
    "l_orderkey = o_orderkey JOIN t ON t.entity = l_suppkey)"
)


def _threshold(spark, sf, kind):
    k = F.col("s_suppkey")
    t = suppliers(spark, sf).select(
        k.alias("entity"), F.when(k % 3 == 0, v(k % 70)).alias("variable"), F.when(k % 3 == 1, k + 1000.0).alias("constant"),
        F.col("s_acctbal").alias("dead_pool_taf")
    )
    m = monthly(spark, sf)
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("scenario"), F.trunc("o_orderdate", "month").alias("ts"))
    seen = o.join(
        table(spark, sf, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("entity")), F.col("o_orderkey") == F.col("l_orderkey")
    ).select("scenario", "entity", "ts").distinct()
    rows = seen.join(t.select("entity", "dead_pool_taf"), "entity")
    out = S.resolve_threshold(rows, t.select("entity", "variable", "constant"), m, kind)
    return out.groupBy("scenario", "entity").agg(rounded(F.sum(f"{kind}_threshold")).alias("threshold"), F.count(f"{kind}_threshold").alias("n"))


for _kind, _last in (("flood", "NULL"), ("dead", "CASE WHEN r.dead_pool_taf > 0 THEN r.dead_pool_taf END")):
    query(
        f"c10_resolve_threshold_{_kind}",
        f"{THRESHOLD_SQL}, x AS (SELECT r.scenario, r.entity, coalesce(m.value, t.constant, {_last}) AS th FROM rows r JOIN t USING (entity) "
        f"LEFT JOIN monthly m ON m.variable = t.variable AND m.scenario = r.scenario AND m.ts = r.ts) SELECT scenario, entity, {r('sum(th)')} AS "
        "threshold, count(th) AS n FROM x GROUP BY 1, 2"
    )(lambda spark, sf, kind=_kind: _threshold(spark, sf, kind))


def _grouped(spark, sf):
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return suppliers(spark, sf).join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("r_name").alias("group"), F.col("s_suppkey").alias("entity"))


COUNTS = "SELECT scenario, entity, count(*) AS n FROM obs WHERE {} GROUP BY 1, 2"
MEMBER = "entity IN (SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = '{}')"
for _name, _args, _where in (
    ("ids", {"ids": [3, 5, 8]}, "entity IN (3, 5, 8)"), ("group", {"group": "ASIA"}, MEMBER.format("ASIA")),
    ("default", {"default_group": "AFRICA"}, MEMBER.format("AFRICA"))
):
    query(f"c11_filter_stats_{_name}", f"WITH {OBS} {COUNTS.format(_where)}")(
        lambda spark, sf,
        args=_args: S.filter_stats(obs(spark, sf), _grouped(spark, sf), **args).groupBy("scenario", "entity").agg(F.count("*").alias("n"))
    )


@query("c12_filter_farm_units", "SELECT p_partkey AS entity FROM part WHERE p_partkey % 5 = 0 AND upper(p_type) = 'ECONOMY' AND contains(lower(p_name), 'ring')")
def c12(spark, sf):
    rows = table(spark, sf, "part").select(
        F.col("p_partkey").alias("entity"),
        F.when(F.col("p_partkey") % 5 == 0, F.when(F.col("p_partkey") % 2 == 0, " ")).otherwise("sac").alias("region"),
        F.col("p_type").alias("cs3_type"), F.col("p_name").alias("provider")
    )
    return S.filter_farm_units(rows, "", "economy", "RING").select("entity")


@query(
    "c13_search_elements",
    "WITH n AS (SELECT 'node' AS element, CAST(s_suppkey AS BIGINT) AS id, 'N' || s_suppkey AS short_code, s_name AS name, CAST(NULL AS "
    "VARCHAR) AS description FROM supplier WHERE contains('n' || s_suppkey, '9') OR contains(lower(s_name), '9') ORDER BY short_code, id LIMIT "
    "10), "
    "a AS (SELECT 'arc' AS element, p_partkey AS id, 'A' || p_partkey AS short_code, p_name AS name, p_brand AS description FROM part WHERE "
    "contains('a' || p_partkey, '9') OR contains(lower(p_name), '9') OR contains(lower(p_brand), '9') ORDER BY short_code, id LIMIT 10) SELECT "
    "* FROM n UNION ALL SELECT * FROM a",
)
def c13(spark, sf):
    nodes = suppliers(spark, sf).select(
        F.col("s_suppkey").alias("id"), F.concat(F.lit("N"), F.col("s_suppkey").cast("string")).alias("short_code"), F.col("s_name").alias("name"),
        F.lit(None).cast("string").alias("description")
    )
    arcs = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.concat(F.lit("A"), F.col("p_partkey").cast("string")).alias("short_code"), F.col("p_name").alias("name"),
        F.col("p_brand").alias("description")
    )
    return S.search_elements(nodes, arcs, "9", 20)


@query(
    "c13_search_indexed",
    "WITH n AS (SELECT 'node' AS element, CAST(c_custkey AS BIGINT) AS id, 'N' || c_custkey AS short_code, c_name AS name, c_mktsegment AS "
    "description FROM customer WHERE contains('n' || c_custkey, '#0000012') OR contains(lower(c_name), '#0000012') OR "
    "contains(lower(c_mktsegment), '#0000012') ORDER BY short_code, id LIMIT 1000), "
    "a AS (SELECT 'arc' AS element, p_partkey AS id, 'A' || p_partkey AS short_code, p_name AS name, p_brand AS description FROM part WHERE "
    "contains('a' || p_partkey, '#0000012') OR contains(lower(p_name), '#0000012') OR contains(lower(p_brand), '#0000012') ORDER BY short_code, "
    "id LIMIT 1000) SELECT * FROM n UNION ALL SELECT * FROM a",
)
def c13_indexed(spark, sf):
    """Elements indexed by trigrams, then searched."""
    element = lambda kind, df, key, name, about: df.select(F.lit(kind).alias("element"), F.col(key).cast("long").alias("id"), F.concat(F.lit(kind[0].upper()), F.col(key).cast("string")).alias("short_code"), F.col(name).alias("name"), F.col(about).alias("description"))
    path = shared_path(spark, "search")
    search.write_search_index(
        element(
            "node", table(spark, sf, "customer"), "c_custkey", "c_name", "c_mktsegment"
        ).unionByName(element("arc", table(spark, sf, "part"), "p_partkey", "p_name", "p_brand")),
        path
    )
    return search.search_indexed(spark, path, "#0000012", 2000)


for _name, _mod in (("some", 4), ("none", 1000)):
    query(
        f"c14_active_or_all_{_name}",
        f"WITH x AS (SELECT c_custkey AS k, c_custkey % 1000 = 1 AND {_mod} = 4 AS is_active, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END "
        "AS t, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS n FROM customer) SELECT k, coalesce(t, n, 'C' || k) AS display_name FROM x WHERE "
        "is_active OR NOT EXISTS (SELECT 1 FROM x WHERE is_active)",
    )(
        lambda spark, sf, mod=_mod: S.active_or_all(
            table(spark, sf, "customer").select(
                F.col("c_custkey").alias("k"), ((F.col("c_custkey") % 1000 == 1) & F.lit(mod == 4)).alias("is_active"),
                F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).alias("short_title"),
                F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("name"),
                F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("short_code")
            )
        ).select("k", "display_name")
    )


@query(
    "i1_number_members",
    f"SELECT p_partkey AS id, p_brand AS \"group\", {big('row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey)')} AS display_order FROM part WHERE regexp_matches(p_name, '^small|ring$')"
)
def i1(spark, sf):
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("group"), F.col("p_name").alias("name"))
    return S.number_members(rows, "^small|ring$").select("id", "group", "display_order")
