"""Queries of the tier operators (E)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import wba_id_to_map_id
from tidemark.operators import tiers as T
from tidemark.plans.registry import big, query, r, table

LOC = """loc AS (SELECT scenario, indicator, location, CAST(nullif(first % 10, 0) AS INTEGER) AS level, first // 10 AS pos FROM (
  SELECT o_orderstatus AS scenario, 'I' || o_custkey % 4 AS indicator, 'L' || o_custkey % 97 AS location,
    min(o_orderkey * 10 + CASE WHEN o_orderkey % 31 <> 0 THEN least(CAST(left(o_orderpriority, 1) AS INTEGER), 4) ELSE 0 END) AS first FROM orders GROUP BY 1, 2, 3))"""
DEF = "def AS (SELECT 'I' || n AS indicator, 'Indicator ' || n AS name, CASE WHEN n % 2 = 0 THEN 'multi_value' ELSE 'single_value' END AS tier_type, n <> 3 AS is_active FROM range(4) t(n))"
CNT = f"""{LOC}, cnt AS (SELECT scenario, indicator, count(*) FILTER (WHERE level = 1) AS tier_1_value, count(*) FILTER (WHERE level = 2) AS tier_2_value,
  count(*) FILTER (WHERE level = 3) AS tier_3_value, count(*) FILTER (WHERE level = 4) AS tier_4_value, count(level) AS total_value FROM loc GROUP BY 1, 2),
  shares AS (SELECT *, {', '.join(f"{r(f'tier_{t}_value::DOUBLE / nullif(total_value, 0)', 4)} AS norm_tier_{t}" for t in (1, 2, 3, 4))} FROM cnt)"""
COLS = "scenario, indicator, tier_1_value, tier_2_value, tier_3_value, tier_4_value, norm_tier_1, norm_tier_2, norm_tier_3, norm_tier_4, total_value"
SCORE = f"""{CNT}, s0 AS (SELECT *, coalesce(norm_tier_1, 0) AS n1, coalesce(norm_tier_2, 0) AS n2, coalesce(norm_tier_3, 0) AS n3, coalesce(norm_tier_4, 0) AS n4 FROM shares),
  s1 AS (SELECT *, n1 + n2 + n3 + n4 AS total, n1 + 2 * n2 + 3 * n3 + 4 * n4 AS mean, 2 * (n1 * n2 + 2 * n1 * n3 + 3 * n1 * n4 + n2 * n3 + 2 * n2 * n4 + n3 * n4) AS spread FROM s0),
  s2 AS (SELECT *, CASE WHEN total > 0 THEN {r('mean / total', 3)} END AS weighted_score FROM s1),
  scores AS (SELECT {COLS}, weighted_score, CASE WHEN total > 0 THEN {r('(4.0 - weighted_score) / 3.0', 3)} END AS normalized_score, CASE WHEN total > 0 THEN {r('spread / (mean * 2)', 3)} END AS gini,
    CASE WHEN total > 0 THEN {r('(4.0 - CASE WHEN n1 > 0 THEN 1 WHEN n2 > 0 THEN 2 WHEN n3 > 0 THEN 3 ELSE 4 END) / 3.0::DOUBLE', 3)} END AS band_upper,
    CASE WHEN total > 0 THEN {r('(4.0 - CASE WHEN n4 > 0 THEN 4 WHEN n3 > 0 THEN 3 WHEN n2 > 0 THEN 2 ELSE 1 END) / 3.0::DOUBLE', 3)} END AS band_lower FROM s2)"""


def locations(spark, sf):
    """Rows (scenario, indicator, location, level, pos) by the first order of each location; some levels are missing."""
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    level = F.when(k % 31 != 0, F.least(F.substring("o_orderpriority", 1, 1).cast("int"), F.lit(4))).otherwise(0)
    name = lambda p, n: F.concat(F.lit(p), (F.col("o_custkey") % n).cast("string"))
    return o.groupBy(
        F.col("o_orderstatus").alias("scenario"), name("I", 4).alias("indicator"), name("L", 97).alias("location")
    ).agg(F.min(k * 10 + level).alias("first")).select(
        "scenario", "indicator", "location", F.nullif(F.col("first") % 10, F.lit(0)).cast("int").alias("level"), F.expr("first div 10").alias("pos")
    )


def definitions(spark):
    n = F.col("id").cast("string")
    return spark.range(4).select(
        F.concat(F.lit("I"), n).alias("indicator"), F.concat(F.lit("Indicator "), n).alias("name"),
        F.when(F.col("id") % 2 == 0, "multi_value").otherwise("single_value").alias("tier_type"), (F.col("id") != 3).alias("is_active")
    )


def scores(spark, sf):
    return T.tier_scores(T.tier_counts(locations(spark, sf)))


PLACES = [f"L{i}" for i in range(97)]
INDICATORS = [f"I{i}" for i in range(4)]


def of_each(rows, make):
    """What ``make`` makes of the rows of every indicator, on end."""
    return reduce(DataFrame.unionByName, (make(rows.where(F.col("indicator") == i), i) for i in INDICATORS))


def matrix(rows):
    """Scenario by location; NA where the level is missing, and a header with a line break."""
    out = rows.groupBy("scenario").pivot("location", PLACES).agg(F.max(F.col("level").cast("string"))).fillna("NA")
    return out.withColumnRenamed("L0", "L0\n")


@query(
    "e1_unpivot_tiers",
    f"WITH {LOC} SELECT scenario, indicator, location, {big('level')} AS level FROM loc "
    "WHERE level IS NOT NULL AND scenario IN ('O', 'F')",
)
def e1(spark, sf):
    """A matrix of all 97 locations for each of the four indicators."""
    allowed = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("scenario")).where("scenario in ('O', 'F')").distinct()
    return of_each(locations(spark, sf), lambda rows, i: T.unpivot_tiers(matrix(rows), i, allowed))


@query(
    "e2_unpivot_station_matrix",
    f"WITH {LOC}, w AS (SELECT indicator, location, max(CASE WHEN scenario = 'F' THEN level END) AS a, max(CASE WHEN scenario = 'O' THEN level END) AS b, "
    "max(CASE WHEN scenario = 'P' THEN level END) AS c FROM loc GROUP BY 1, 2) "
    f"SELECT 's0042' AS scenario, indicator, location, {big('coalesce(a, b)')} AS level FROM w WHERE coalesce(a, b) IS NOT NULL "
    f"UNION ALL SELECT 's0043', indicator, location, {big('c')} FROM w WHERE c IS NOT NULL",
)
def e2(spark, sf):
    """A matrix of stations for each of the four indicators."""

    def stations(rows, i):
        w = rows.groupBy(F.col("location").alias("station")).pivot("scenario", ["F", "O", "P"]).agg(F.max("level"))
        return T.unpivot_station_matrix(w.toDF("station", "s0042(1)", "s0042(2)", "s0043"), i)

    return of_each(locations(spark, sf), stations)


@query("e3_long_tiers", f"WITH {LOC} SELECT scenario, 'AG' AS indicator, location, {big('level')} AS level FROM loc WHERE level IS NOT NULL")
def e3(spark, sf):
    return T.long_tiers(locations(spark, sf).select("scenario", F.col("location").alias("region"), F.col("level").alias("tier")), "AG")


@query(
    "e4_groundwater_levels",
    f"WITH {LOC}, x AS (SELECT indicator, scenario, CAST(substring(location, 2) AS INTEGER) AS n, level FROM loc), "
    "y AS (SELECT indicator, scenario, CASE WHEN n < 10 THEN '0' ELSE '' END || n || CASE WHEN n % 3 = 0 THEN 'N' ELSE '' END AS location, n, "
    "CASE WHEN level = 4 THEN 1 ELSE level END AS level FROM x) "
    f"SELECT indicator, scenario, location, {big('level')} AS level, CASE WHEN n % 2 = 0 THEN 'Zone ' || n ELSE location END AS display_name FROM y",
)
def e4(spark, sf):
    """Levels of the zones of each of the four indicators."""

    def levels(rows, i):
        rows = rows.withColumn("n", F.substring("location", 2, 9).cast("int"))
        zone = F.concat(F.lit("WBA"), F.col("n").cast("string"), F.when(F.col("n") % 3 == 0, "N").otherwise("")).alias("zone")
        zones = rows.select("scenario", "n", zone, F.when(F.col("level") == 4, 0).otherwise(F.col("level")).alias("level"))
        name = F.concat(F.lit("Zone "), F.col("n").cast("string")).alias("display_name")
        names = zones.where("n % 2 = 0").select(wba_id_to_map_id(F.col("zone")).alias("location"), name).distinct()
        return T.groundwater_levels(zones, names).select(F.lit(i).alias("indicator"), "scenario", "location", "level", "display_name")

    return of_each(locations(spark, sf), levels)


@query("e5_display_order", f"WITH {LOC} SELECT scenario, indicator, location, {big('row_number() OVER (PARTITION BY scenario ORDER BY pos)')} AS display_order FROM loc")
def e5(spark, sf):
    return T.display_order(locations(spark, sf), "pos").select("scenario", "indicator", "location", "display_order")


@query("e5_display_order_whole", f"WITH {LOC} SELECT scenario, indicator, location, {big('row_number() OVER (ORDER BY pos)')} AS display_order FROM loc")
def e5_whole(spark, sf):
    return T.display_order(locations(spark, sf), "pos", None).select("scenario", "indicator", "location", "display_order")


@query("e6_tier_counts", f"WITH {CNT} SELECT {COLS} FROM shares")
def e6(spark, sf):
    return T.tier_counts(locations(spark, sf))


@query(
    "e6_tier_counts_fixed",
    f"WITH {CNT} SELECT scenario, indicator, tier_1_value, tier_2_value, tier_3_value, tier_4_value, "
    f"{', '.join(f"{r(f'tier_{t}_value / 132.0::DOUBLE', 3)} AS norm_tier_{t}" for t in (1, 2, 3, 4))}, {big('132')} AS total_value FROM cnt"
)
def e6_fixed(spark, sf):
    return T.tier_counts(locations(spark, sf), 132, 3)


@query("e7_tier_scores", f"WITH {SCORE} SELECT * FROM scores")
def e7(spark, sf):
    return scores(spark, sf)


SINGLE = f"{LOC}, one AS (SELECT scenario, indicator, CASE WHEN indicator <> 'I3' THEN min(level) END AS single_tier_level FROM loc GROUP BY 1, 2)"
NORMAL = f"CASE WHEN coalesce(single_tier_level, 0) > 0 THEN {r('(4.0 - single_tier_level) / 3.0::DOUBLE', 3)} ELSE 0.0 END"


def _single(spark, sf):
    return locations(spark, sf).groupBy("scenario", "indicator").agg(F.min("level").alias("m")).select(
        "scenario", "indicator", F.when(F.col("indicator") != "I3", F.col("m")).alias("single_tier_level")
    )


@query(
    "e8_single_tier_scores",
    f"WITH {SINGLE} SELECT scenario, indicator, {big('single_tier_level')} AS single_tier_level, CAST(coalesce(single_tier_level, 0) AS DOUBLE) "
    f"AS weighted_score, {NORMAL} AS normalized_score, 0.0::DOUBLE AS gini, {NORMAL} AS band_upper, {NORMAL} AS band_lower FROM one"
)
def e8(spark, sf):
    return T.single_tier_scores(_single(spark, sf))


SIDE = ", ".join(
    f"max(CASE WHEN scenario = '{s}' THEN nullif({c}, 0.0) END) AS {c}_{n}" for n,
    s in (("a", "F"), ("b", "O")) for c in ("weighted_score", "normalized_score", "gini")
)


@query("e9_compare_scenarios", f"WITH {SCORE} SELECT indicator, {SIDE} FROM scores WHERE scenario IN ('F', 'O') GROUP BY indicator")
def e9(spark, sf):
    return T.compare_scenarios(scores(spark, sf), "F", "O")


@query(
    "e10_indicator_averages",
    f"WITH {SCORE} SELECT indicator, {r('avg(weighted_score)', 4)} AS avg_score, min(weighted_score) AS min_score, max(weighted_score) AS "
    "max_score, count(weighted_score) AS scenarios FROM scores GROUP BY 1"
)
def e10(spark, sf):
    return T.indicator_averages(scores(spark, sf))


@query(
    "e11_tier_availability",
    f"WITH {CNT} SELECT scenario, list_sort(list(DISTINCT indicator)) AS indicators, count(DISTINCT indicator) AS indicator_count FROM shares GROUP BY 1"
)
def e11(spark, sf):
    return T.tier_availability(T.tier_counts(locations(spark, sf)))


@query(
    "e12_tier_location_summary",
    f"WITH {LOC}, {DEF} SELECT indicator, name, count(*) AS location_count, count(DISTINCT level) AS levels_used FROM loc JOIN def USING (indicator) WHERE scenario = 'F' AND is_active GROUP BY 1, 2"
)
def e12(spark, sf):
    return T.tier_location_summary(locations(spark, sf), definitions(spark), "F")


@query(
    "e12_scenario_location_counts",
    f"WITH {LOC} SELECT scenario, count(DISTINCT indicator) AS tier_count, count(DISTINCT location) AS location_count FROM loc GROUP BY 1"
)
def e12_counts(spark, sf):
    return T.scenario_location_counts(locations(spark, sf))


@query(
    "e13_tier_locations",
    f"WITH {LOC}, {DEF} SELECT scenario, indicator, name, string_agg(location || ':' || coalesce(CAST(level AS VARCHAR), '-'), ',' ORDER BY pos) "
    f"AS listed, {', '.join(f'count(*) FILTER (WHERE level = {t}) AS tier_{t}_count' for t in (1, 2, 3, 4))} FROM loc JOIN def USING (indicator) "
    "GROUP BY 1, 2, 3"
)
def e13(spark, sf):
    out = T.tier_locations(locations(spark, sf).withColumnRenamed("pos", "display_order"), definitions(spark))
    listed = F.array_join(F.transform("locations", lambda s: F.concat_ws(":", s["location"], F.coalesce(s["level"].cast("string"), F.lit("-")))), ",")
    return out.withColumn("listed", listed).drop("locations")


@query(
    "e14_tier_features",
    f"WITH {LOC}, x AS (SELECT *, CASE WHEN CAST(substring(location, 2) AS INTEGER) % 2 = 0 THEN 'node' ELSE 'zone' END AS kind, CASE WHEN "
    "location IN ('L4', 'L6') THEN 'L4' ELSE location END AS g FROM loc) "
    "SELECT scenario, indicator, location, 'POINT (' || substring(g, 2) || ' 1)' AS geometry, '{\"location\":\"' || location || "
    "'\",\"location_type\":\"' || kind || '\"' || CASE WHEN level IS NULL THEN '' ELSE ',\"tier_level\":' || level END || '}' AS properties "
    "FROM x WHERE CAST(substring(g, 2) AS INTEGER) < 40",
)
def e14(spark, sf):
    n = F.substring("location", 2, 9).cast("int")
    rows = locations(spark, sf).withColumn("location_type", F.when(n % 2 == 0, "node").otherwise("zone"))
    near = rows.where(n < 40)
    geo = near.select(
        "location_type", F.col("location").alias("geometry_id"), F.concat(F.lit("POINT ("), n.cast("string"), F.lit(" 1)")).alias("geometry")
    ).where("geometry_id <> 'L6'").distinct()
    aliases = near.where("location = 'L6'").select("location", F.lit("L4").alias("geometry_id")).distinct()
    return T.tier_features(rows, geo, aliases)


STORED = (
    "stored AS (SELECT scenario, indicator, tier_1_value + CASE WHEN indicator = 'I1' THEN 1 ELSE 0 END AS tier_1_value, tier_2_value, "
    "tier_3_value, tier_4_value FROM cnt WHERE indicator <> 'I2' OR scenario <> 'P')"
)


@query(
    "e15_reconcile_tiers",
    f"WITH {CNT}, {STORED} SELECT c.scenario, c.indicator, c.tier_1_value AS found_1, c.tier_2_value AS found_2, c.tier_3_value AS found_3, "
    "c.tier_4_value AS found_4, s.tier_1_value, s.tier_2_value, s.tier_3_value, s.tier_4_value, coalesce(c.tier_1_value = s.tier_1_value, "
    "false) AS matches FROM cnt c LEFT JOIN stored s USING (scenario, indicator)"
)
def e15(spark, sf):
    rows = locations(spark, sf)
    stored = T.tier_counts(rows).where("indicator <> 'I2' or scenario <> 'P'").withColumn(
        "tier_1_value", F.col("tier_1_value") + F.when(F.col("indicator") == "I1", 1).otherwise(0)
    )
    return T.reconcile_tiers(rows, stored)


@query(
    "e16_tier_type_summary",
    f"WITH {CNT}, {DEF} SELECT tier_type, count(*) AS results, count(CASE WHEN indicator IN ('I0', 'I2') THEN 1 END) AS multi_value, count(CASE "
    "WHEN indicator NOT IN ('I0', 'I2') THEN 1 END) AS single_value FROM cnt JOIN def USING (indicator) GROUP BY 1"
)
def e16(spark, sf):
    multi = F.col("indicator").isin("I0", "I2")
    rows = T.tier_counts(locations(spark, sf)).withColumns({"single_tier_level": F.when(~multi, 1), "tier_1_value": F.when(multi, F.col("tier_1_value"))})
    return T.tier_type_summary(rows, definitions(spark))
