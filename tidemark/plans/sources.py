"""Queries of sources and sinks (A) and of the scenario stream (J1); files are written from the given tables."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from tidemark.functions import scalars
from tidemark.functions.scalars import rounded
from tidemark.operators import stats
from tidemark.plans.bindings import OBS, obs
from tidemark.plans.registry import big, query, r, table
from tidemark.plans.series import MONTHLY_SQL, monthly
from tidemark.sources import exports as X
from tidemark.sources import layout, sinks
from tidemark.sources.shared import shared_path
from tidemark.streaming import incremental

# Exports of three scenarios out of the monthly series; the scenario's id is s0001 … by order status.
NUMBERED = "CASE scenario WHEN 'F' THEN 's0001' WHEN 'O' THEN 's0002' ELSE 's0003' END"
EXPORT = (
    f"WITH {MONTHLY_SQL}, ex AS (SELECT {NUMBERED} AS scenario, variable, ts, value FROM monthly), days AS (SELECT scenario, ts FROM ex GROUP BY 1, "
    "2 HAVING count(value) > 0), vars AS (SELECT DISTINCT scenario, variable FROM ex)"
)
FULL = (
    f"{EXPORT}, cells AS (SELECT d.scenario, v.variable, d.ts, e.value FROM days d JOIN vars v USING (scenario) LEFT JOIN ex e ON e.scenario = "
    "d.scenario AND e.variable = v.variable AND e.ts = d.ts)"
)


def numbered(df):
    s = F.col("scenario")
    return df.withColumn("scenario", F.when(s == "F", "s0001").when(s == "O", "s0002").otherwise("s0003"))


def written(spark, sf):
    """A folder with one export for each scenario."""
    path = shared_path(spark, "exports")
    sinks.write_dss_csv(numbered(monthly(spark, sf)).withColumn("units", F.lit("CFS")), path)
    return path


def header_lines(spark, sf):
    """Lines of small files with different header lengths, made from part: file, block, at, cells."""
    p, k = table(spark, sf, "part"), F.col("p_partkey")
    n, header = (k / 20).cast("long"), F.lit(7) + F.col("file_no") % 3
    rows = p.select(n.alias("file_no"), (k % 20).alias("line"), "p_size")
    first = F.when(F.col("line") < header, F.concat(F.lit("h"), F.col("line").cast("string"))).otherwise(F.format_string("2001-%02d-01", F.col("line") % 12 + 1))
    return rows.select(
        F.concat(F.lit("f"), F.col("file_no").cast("string")).alias("file"), F.lit(0).cast("long").alias("block"),
        (F.col("file_no") * 100 + F.col("line")).alias("at"), F.array(first, F.col("p_size").cast("string")).alias("cells")
    )


@query("a1_read_dss_csv", f"{FULL} SELECT scenario, variable, ts, {r('value')} AS value FROM cells WHERE variable IN ('V1', 'V7', 'V10')")
def a1(spark, sf):
    wanted = table(spark, sf, "nation").where("n_nationkey in (1, 7, 10)").select(F.concat(F.lit("V"), F.col("n_nationkey").cast("string")).alias("variable"))
    out = X.read_dss_csv(spark, written(spark, sf), wanted)
    return out.select("scenario", "variable", "ts", rounded(F.col("value")).alias("value"))


@query(
    "a1_series_table",
    f"{FULL} SELECT scenario, variable AS entity, {big('(month(ts) + 2) % 12 + 1')} AS water_month, "
    f"{r('avg(CASE WHEN scenario = \'s0002\' THEN value + 1 ELSE value END)')} AS avg, count(value) AS sample_count FROM cells WHERE value IS "
    "NOT NULL GROUP BY 1, 2, 3"
)
def a1_series_table(spark, sf):
    """All exports converted once into the bucketed table, one of them sent again with other values; monthly statistics
    of every variable are read from there without a shuffle."""
    rows = numbered(monthly(spark, sf)).withColumn("units", F.lit("CFS"))
    again = shared_path(spark, "exports")
    sinks.write_dss_csv(rows.where("scenario = 's0002'").withColumn("value", F.col("value") + 1), again)
    held = layout.convert_exports(spark, again, layout.convert_exports(spark, written(spark, sf)))
    series = X.with_series_calendar(held.read().withColumnRenamed("variable", "entity"))
    return stats.distribution_stats(series, stats.MONTH, "value").select(*stats.MONTH, "avg", "sample_count")


ANNUAL = (
    f"WITH ex AS (SELECT {NUMBERED.replace('scenario', 'o_orderstatus')} AS scenario, 'V' || o_custkey % 60 AS variable, "
    "make_date(CAST(year(o_orderdate) AS INTEGER), 9, 30) AS ts, sum(o_totalprice) AS value FROM orders GROUP BY 1, 2, 3), days AS (SELECT DISTINCT "
    "scenario, ts FROM ex), vars AS (SELECT DISTINCT scenario, variable FROM ex)"
)


@query(
    "a1_read_annual",
    f"{ANNUAL} SELECT scenario, variable, ts, {big('0')} AS water_month, {big('year(ts)')} AS water_year, {big('365')} AS days_in_month, "
    f"{r('value')} AS value FROM days JOIN vars USING (scenario) LEFT JOIN ex USING (scenario, variable, ts)"
)
def a1_annual(spark, sf):
    """Exports whose first column holds bare years."""
    o = table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("scenario"), F.concat(F.lit("V"), (F.col("o_custkey") % 60).cast("string")).alias("variable"),
        F.make_date(F.year("o_orderdate"), F.lit(9), F.lit(30)).alias("ts"), "o_totalprice"
    )
    lines = sinks.dss_lines(numbered(o.groupBy("scenario", "variable", "ts").agg(F.sum("o_totalprice").alias("value"))).withColumn("units", F.lit("TAF")))
    path = shared_path(spark, "annual")
    lines.repartition("scenario").sortWithinPartitions("scenario", "place").select(
        "scenario", F.regexp_replace("line", r"^(\d{4})-09-30", "$1").alias("value")
    ).write.partitionBy("scenario").text(path)
    out = X.with_series_calendar(X.read_dss_csv(spark, path))
    return out.select("scenario", "variable", "ts", "water_month", "water_year", "days_in_month", rounded(F.col("value")).alias("value"))


@query(
    "a2_detect_header_rows",
    "SELECT 'f' || n AS file, CAST(7 + n % 3 AS BIGINT) AS data_start FROM (SELECT DISTINCT CAST(floor(p_partkey / 20) AS BIGINT) AS n FROM part)"
)
def a2(spark, sf):
    return X.detect_header_rows(header_lines(spark, sf))


META = "WITH meta AS (SELECT 'f' || p_size AS file, CAST(p_partkey % 40 + 1 AS INTEGER) AS col_idx, upper(replace(p_name, ' ', '_')) AS b FROM part)"


def meta(spark, sf):
    return table(spark, sf, "part").select(
        F.concat(F.lit("f"), F.col("p_size").cast("string")).alias("file"), (F.col("p_partkey") % 40 + 1).alias("col_idx"),
        F.upper(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("b")
    )


@query("a3_select_variables", f"{META} SELECT file, {big('col_idx')} AS col_idx, b FROM meta WHERE b IN (SELECT b FROM meta WHERE file = 'f1')")
def a3(spark, sf):
    rows = meta(spark, sf)
    padded = rows.withColumn("b", F.concat(F.lit(" "), F.col("b"), F.lit("  ")))
    return X.select_variables(padded, rows.where("file = 'f1'").select(F.col("b").alias("variable"))).select("file", "col_idx", "b")


@query("a4_first_column_wins", f"{META}, f AS (SELECT DISTINCT * FROM meta) SELECT file, b, {big('min(col_idx)')} AS col_idx FROM f GROUP BY 1, 2")
def a4(spark, sf):
    return X.first_column_wins(meta(spark, sf).distinct()).select("file", "b", "col_idx")


@query("a5_select_column_block", f"{META} SELECT file, {big('col_idx')} AS col_idx, b FROM meta WHERE col_idx >= 20 AND b LIKE 'SMALL%'")
def a5(spark, sf):
    return X.select_column_block(meta(spark, sf), 20, "SMALL").select("file", "col_idx", "b")


PATHS = (
    "WITH paths AS (SELECT 's' || lpad(CAST(o_custkey % 9000 AS VARCHAR), 4, '0') AS scenario, 'scenario/s' || lpad(CAST(o_custkey % 9000 AS "
    "VARCHAR), 4, '0') || '/' || CASE o_orderkey % 4 WHEN 0 THEN 'run' WHEN 1 THEN 'csv' WHEN 2 THEN 'old' ELSE 'verify' END || '/' || CASE "
    "o_orderkey % 3 WHEN 0 THEN 'a_output.csv' WHEN 1 THEN 'b_sv.csv' ELSE 'c.zip' END || CASE WHEN o_orderkey % 5 = 0 THEN '/' ELSE '' END AS path "
    "FROM orders)"
)


def paths(spark, sf):
    o = table(spark, sf, "orders")
    k, s = F.col("o_orderkey"), F.concat(F.lit("s"), F.lpad((F.col("o_custkey") % 9000).cast("string"), 4, "0"))
    folder = F.when(k % 4 == 0, "run").when(k % 4 == 1, "csv").when(k % 4 == 2, "old").otherwise("verify")
    name = F.when(k % 3 == 0, "a_output.csv").when(k % 3 == 1, "b_sv.csv").otherwise("c.zip")
    return o.select(s.alias("scenario"), F.concat_ws("/", F.lit("scenario"), s, folder, F.concat(name, F.when(k % 5 == 0, "/").otherwise(""))).alias("path"))


@query(
    "a6_pick_first_existing",
    f"{PATHS}, x AS (SELECT scenario, path, CASE WHEN path LIKE '%/csv/a\\_output.csv' ESCAPE '\\' THEN 1 WHEN path LIKE '%/run/%csv' THEN 2 "
    "WHEN path LIKE '%.csv' THEN 3 END AS rank FROM paths) SELECT scenario, arg_min(path, (rank, path)) AS path FROM x WHERE rank IS NOT NULL "
    "GROUP BY 1"
)
def a6(spark, sf):
    patterns = table(spark, sf, "region").where("r_regionkey < 3").select(
        F.get(F.array(F.lit(r"/csv/a_output\.csv$"), F.lit(r"/run/.*csv$"), F.lit(r"\.csv$")), F.col("r_regionkey")).alias("pattern"),
        (F.col("r_regionkey") + 1).alias("rank")
    )
    return X.pick_first_existing(paths(spark, sf), patterns)


@query(
    "a7_scenario_from_path",
    "SELECT p_partkey AS k, CASE p_partkey % 3 WHEN 0 THEN 's' || lpad(CAST(p_size AS VARCHAR), 4, '0') WHEN 1 THEN 's' || lpad(CAST(p_size AS "
    "VARCHAR), 4, '0') ELSE left(lower(regexp_replace(p_name, '[^A-Za-z0-9._-]+', '_', 'g')), 12) END AS scenario FROM part"
)
def a7(spark, sf):
    k, s = F.col("p_partkey"), F.concat(F.lit("S"), F.lpad(F.col("p_size").cast("string"), 4, "0"))
    path = F.when(
        k % 3 == 0, F.concat(F.lit("scenario/"), s, F.lit("/csv/x.csv"))
    ).when(k % 3 == 1, F.concat(F.lit("in/"), s, F.lit("_DV.csv"))).otherwise(F.concat(F.lit("in/"), F.col("p_name"), F.lit(".zip")))
    return table(spark, sf, "part").select(k.alias("k"), scalars.scenario_from_path(path).alias("scenario"))


@query(
    "a8_catalogue_files",
    f"{PATHS}, x AS (SELECT scenario, path FROM paths WHERE path NOT LIKE '%/') SELECT scenario, bool_or(path LIKE '%.zip') AS has_zip, "
    "bool_or(regexp_matches(path, 'output[^/]*\\.csv$')) AS has_output_csv, bool_or(regexp_matches(path, 'sv[^/]*\\.csv$')) AS has_sv_csv FROM "
    "x GROUP BY 1"
)
def a8(spark, sf):
    return X.catalogue_files(paths(spark, sf))


@query(
    "a9_classify_dss_paths",
    "WITH x AS (SELECT p_brand || p_size AS package, p_partkey AS position, p_partkey % 3 AS f, p_partkey % 7 AS b, p_size % 2 = 0 AS folders FROM part), "
    "p AS (SELECT *, CASE WHEN NOT folders THEN 'x/' WHEN f = 0 THEN 'DSS/Input/' WHEN f = 1 THEN 'dss/output/' ELSE 'other/' END || CASE b "
    "WHEN 0 THEN 'a_SV.dss' WHEN 1 THEN 'input' || position || '.dss' WHEN 2 THEN 'r_DV.dss' WHEN 3 THEN 'results.dss' WHEN 4 THEN "
    "'CVGroundwaterOut.dss' WHEN 5 THEN 'plain.dss' ELSE 'out.dss' END AS path FROM x), "
    "g AS (SELECT package, bool_or(folders AND (f = 0 OR (f = 1 AND b <> 4))) AS any_folder FROM p GROUP BY 1), "
    "q AS (SELECT p.*, any_folder, CASE WHEN b = 0 THEN 0 WHEN b = 1 THEN 1 END AS sr, CASE WHEN b = 2 THEN 0 WHEN b IN (3, 6) THEN 1 END AS orank FROM p JOIN g USING (package)) "
    "SELECT package, arg_min(path, (sr, position)) FILTER (WHERE sr IS NOT NULL AND (NOT any_folder OR f = 0)) AS sv_path, arg_min(path, "
    "(orank, position)) FILTER (WHERE orank IS NOT NULL AND (NOT any_folder OR f = 1)) AS output_path FROM q GROUP BY 1",
)
def a9(spark, sf):
    k = F.col("p_partkey")
    f, b = k % 3, k % 7
    folder = F.when(F.col("p_size") % 2 != 0, "x/").when(f == 0, "DSS\\Input\\").when(f == 1, "dss/output/").otherwise("other/")
    name = F.when(b == 0, "a_SV.dss").when(
        b == 1, F.concat(F.lit("input"), k.cast("string"), F.lit(".dss"))
    ).when(b == 2, "r_DV.dss").when(b == 3, "results.dss").when(b == 4, "CVGroundwaterOut.dss").when(b == 5, "plain.dss").otherwise("out.dss")
    rows = table(spark, sf, "part").select(
        F.concat("p_brand", F.col("p_size").cast("string")).alias("package"), k.alias("position"), F.concat(folder, name).alias("path")
    )
    return X.classify_dss_paths(rows).withColumns({c: F.replace(c, F.lit("\\"), F.lit("/")) for c in ("sv_path", "output_path")})


POINTS = """WITH pts AS (SELECT o_orderkey AS read_order, o_orderstatus || '|V' || o_custkey % 30 || '|FLOW|1MON|L2020A' AS series_key, o_orderkey % 11 = 0 AS short,
  CAST(CASE WHEN day(o_orderdate) = 1 THEN o_orderdate - INTERVAL 1 DAY ELSE last_day(o_orderdate) END AS DATE) AS ts, CASE WHEN o_orderkey % 13 <> 0 THEN o_totalprice END AS value FROM orders)"""


def points(spark, sf):
    k = F.col("o_orderkey")
    name = F.concat_ws(
        "/", F.lit(""), F.col("o_orderstatus"), F.concat(F.lit("V"), (F.col("o_custkey") % 30).cast("string")), F.lit("FLOW"), F.lit("01JAN1920"),
        F.lit("1MON"), F.lit("L2020A"), F.lit("")
    )
    return table(spark, sf, "orders").select(
        k.alias("read_order"), F.when(k % 11 == 0, "/A/B/").otherwise(name).alias("pathname"), F.col("o_orderdate").alias("ts"),
        F.when(k % 13 == 0, scalars.MISSING_CODE).otherwise(F.col("o_totalprice")).alias("value")
    )


@query("a10_parse_pathnames", f"{POINTS} SELECT read_order, series_key FROM pts WHERE NOT short")
def a10(spark, sf):
    return X.parse_pathnames(points(spark, sf)).select("read_order", "series_key")


@query(
    "a11_detect_series_type",
    "WITH x AS (SELECT p_size AS file, p_partkey, row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) AS n FROM part), y AS (SELECT "
    "file, CASE WHEN p_partkey % 2 = 0 AND file % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN p_partkey "
    "% 5 <> 0 THEN 1 ELSE 0 END AS o, CASE WHEN file % 2 = 1 THEN 1 ELSE 0 END + CASE WHEN p_partkey % 2 = 1 OR file % 2 = 1 THEN 1 ELSE 0 END "
    "AS i FROM x WHERE n <= 10) "
    "SELECT 'f' || file AS file, CASE WHEN sum(o) > sum(i) THEN 'calsim_output' ELSE 'sv_input' END AS series_type FROM y GROUP BY 1",
)
def a11(spark, sf):
    k, s = F.col("p_partkey"), F.col("p_size")
    even = (k % 2 == 0) & (s % 2 == 0)
    parts = [
        F.when(s % 2 == 1, "SV1").otherwise("RUN"), F.when(even, "S").otherwise("SHSTA"), F.when(k % 5 != 0, "FLOW").otherwise("flow-x"),
        F.when((k % 2 == 1) | (s % 2 == 1), "INPUT").otherwise("01JAN1920"), F.lit("1MON"), F.when(k % 3 == 0, "CFS").otherwise("L2020A")
    ]
    rows = table(spark, sf, "part").select(
        F.concat(F.lit("f"), s.cast("string")).alias("file"), k.alias("position"),
        F.concat(F.lit("/"), F.concat_ws("/", *parts), F.lit("/")).alias("pathname")
    )
    return X.detect_series_type(rows)


@query("a12_missing_code_to_null", "SELECT o_orderkey AS read_order, CASE WHEN o_orderkey % 13 <> 0 THEN o_totalprice END AS value FROM orders")
def a12(spark, sf):
    return points(spark, sf).select("read_order", scalars.missing_code_to_null(F.col("value")).alias("value"))


for _mode, _sql in (
    ("end_of_month", "CASE WHEN day(o_orderdate) = 1 THEN o_orderdate - INTERVAL 1 DAY ELSE last_day(o_orderdate) END"),
    ("start_of_month", "date_trunc('month', o_orderdate)"), ("none", "o_orderdate")
):
    query(f"a13_adjust_timestamp_{_mode}", f"SELECT o_orderkey AS k, CAST({_sql} AS DATE) AS ts FROM orders")(
        lambda spark, sf,
        mode=_mode: table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), scalars.adjusted_timestamp(F.col("o_orderdate"), mode).alias("ts"))
    )


@query(
    "a14_merge_series_points",
    f"{POINTS} SELECT series_key, ts, arg_max(CASE WHEN value IS NULL THEN -1 ELSE value END, read_order) AS value FROM pts WHERE NOT short GROUP BY 1, 2"
)
def a14(spark, sf):
    return X.clean_points(points(spark, sf)).withColumn("value", F.coalesce("value", F.lit(-1.0)))


@query("a15_clip_period", f"WITH {OBS} SELECT scenario, entity, ts, storage FROM obs WHERE ts BETWEEN DATE '1996-10-31' AND DATE '1999-09-30'")
def a15(spark, sf):
    return X.clip_period(obs(spark, sf), "1996-10-31", "1999-09-30").select("scenario", "entity", "ts", "storage")


@query("a16_write_dss_csv", f"{FULL} SELECT scenario, variable, CAST(ts AS VARCHAR) AS day, {r('value')} AS value FROM cells")
def a16(spark, sf):
    """Every cell of the files' text: names from the line that begins with b, values from the lines that begin with a date."""
    cells = spark.read.text(written(spark, sf)).select("scenario", F.split("value", ",", -1).alias("cells"))
    each = cells.select("scenario", F.get("cells", F.lit(0)).alias("day"), F.posexplode("cells").alias("at", "text")).where("at > 0")
    names = each.where("day = 'b'").select("scenario", "at", F.col("text").alias("variable"))
    days = each.where(F.col("day").rlike(r"^\d{4}-")).join(names, ["scenario", "at"])
    return days.select("scenario", "variable", "day", rounded(scalars.null_if_nan(F.col("text").cast("double"))).alias("value"))


@query("a16_write_dss_parts", f"{FULL} SELECT scenario, variable, ts, {r('value')} AS value FROM cells")
def a16_parts(spark, sf):
    """Exports in parts of a year's lines by many tasks, read back as series."""
    path = shared_path(spark, "parts")
    sinks.write_dss_parts(numbered(monthly(spark, sf)).withColumn("units", F.lit("CFS")), path, 366)
    lines = sinks.read_dss_parts(spark, path)
    out = X.long_series(lines, X.first_column_wins(X.series_meta(lines)))
    return out.select("scenario", "variable", "ts", rounded(F.col("value")).alias("value"))


@query(
    "a17_read_seed",
    "SELECT s_suppkey AS id, s_name || ', \"' || s_nationkey || '\"' AS name, s_suppkey % 2 = 0 AS flag, CASE WHEN s_suppkey % 4 = 0 THEN 0.0 "
    f"ELSE s_acctbal END AS capacity, {big('s_suppkey + s_nationkey')} AS total FROM supplier"
)
def a17(spark, sf):
    path, k = shared_path(spark, "seed"), F.col("s_suppkey")
    rows = table(spark, sf, "supplier").select(
        k.alias("id"), F.concat("s_name", F.lit(', "'), F.col("s_nationkey").cast("string"), F.lit('"')).alias("name"), (k % 2 == 0).alias("flag"),
        F.when(k % 4 != 0, F.col("s_acctbal")).alias("capacity"),
        F.concat(F.lit("{"), k.cast("string"), F.lit(","), F.col("s_nationkey").cast("string"), F.lit("}")).alias("source_ids")
    )
    rows.write.option("header", True).option("escape", '"').csv(path)
    out = X.read_seed(spark, path, "id long, name string, flag boolean, capacity double, source_ids string", ["capacity"])
    return out.withColumn("total", F.aggregate(scalars.int_array(F.col("source_ids")), F.lit(0).cast("long"), lambda a, x: a + x)).drop("source_ids")


@query(
    "a18_expand_entity_variables",
    "WITH e AS (SELECT s_suppkey AS id, 'R' || s_suppkey AS sc, s_name AS name, row_number() OVER (ORDER BY s_suppkey) AS n FROM supplier), "
    f"k(i, suffix, t, label, about) AS (VALUES (0, '', 'release_total', 'Total Release', 'Total release from {{}}'), (1, '_NCF', "
    f"'release_normal', 'Normal Release', 'Normal controlled release from {{}} (≤ release capacity)'), (2, '_FLOOD', 'release_flood', 'Flood "
    f"Spill', 'Flood spill from {{}} (above release capacity)')) SELECT {big('(n - 1) * 3 + i + 196')} AS variable_id, 'C_' || sc || suffix AS "
    f"calsim_id, name || ' ' || label AS variable_name, replace(about, '{{}}', name) AS description, id AS entity_id, t AS variable_type FROM e, "
    "k"
)
def a18(spark, sf):
    k = F.col("s_suppkey")
    return X.expand_entity_variables(table(spark, sf, "supplier").select(
        k.alias("id"), F.concat(F.lit("R"), k.cast("string")).alias("short_code"), F.col("s_name").alias("name")
    ))


def _halves(spark, sf):
    c, k = table(spark, sf, "customer"), F.col("c_custkey")
    target = c.where("c_custkey % 3 <> 0").select(k.alias("k"), F.col("c_acctbal").alias("v"), F.lit("old").alias("tag"))
    return target, c.where("c_custkey % 2 = 0").select(k.alias("k"), (F.col("c_acctbal") + 1).alias("v"), F.when(k % 4 == 0, "new").alias("tag"))


@query(
    "a19_upsert",
    "SELECT c_custkey AS k, c_acctbal + CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS v, CASE WHEN c_custkey % 2 = 1 THEN 'old' WHEN "
    "c_custkey % 4 = 0 THEN 'new' ELSE 'system' END AS tag FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0"
)
def a19(spark, sf):
    target, updates = _halves(spark, sf)
    return sinks.upsert(target, updates, ["k"], {"tag": "system"})


@query(
    "a19_upsert_table",
    "SELECT o_orderstatus AS scenario, o_orderkey AS k, o_totalprice + CASE WHEN o_orderstatus <> 'P' AND o_custkey % 3 = 0 THEN 1 ELSE 0 END "
    "AS v, CASE WHEN o_orderstatus <> 'P' AND o_custkey % 3 = 0 THEN CASE WHEN o_custkey % 2 = 0 THEN 'new' ELSE 'system' END ELSE 'old' END AS "
    "tag, CAST(2 AS BIGINT) AS rewritten FROM orders WHERE o_orderkey % 5 <> 0 OR (o_orderstatus <> 'P' AND o_custkey % 3 = 0)"
)
def a19_table(spark, sf):
    """A table partitioned by scenario of which two of three scenarios get updates and new keys."""
    path, o = shared_path(spark, "upserted"), table(spark, sf, "orders")
    rows = o.select(F.col("o_orderstatus").alias("scenario"), F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"), F.lit("old").alias("tag"), "o_custkey")
    rows.where("k % 5 <> 0").drop("o_custkey").repartition("scenario").write.partitionBy("scenario").parquet(path)
    news = rows.where("scenario <> 'P' and o_custkey % 3 = 0").select(
        "scenario", "k", (F.col("v") + 1).alias("v"), F.when(F.col("o_custkey") % 2 == 0, "new").alias("tag")
    )
    n = sinks.upsert_table(spark, path, news, ["scenario", "k"], ["scenario"], {"tag": "system"})
    return spark.read.parquet(path).withColumn("rewritten", F.lit(n))


@query(
    "a20_replace_scenario",
    f"SELECT o_orderstatus AS scenario, o_orderkey, o_custkey, {big("CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END")} AS version FROM orders WHERE o_orderstatus <> 'F' OR o_custkey % 2 = 0"
)
def a20(spark, sf):
    path = shared_path(spark, "replaced")
    o = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("scenario"), "o_orderkey", "o_custkey")
    sinks.replace_scenario(path, o.withColumn("version", F.lit(1)))
    sinks.replace_scenario(path, o.where("scenario = 'F' and o_custkey % 2 = 0").withColumn("version", F.lit(2)))
    return spark.read.parquet(path).select("scenario", "o_orderkey", "o_custkey", "version")


@query(
    "a21_insert_new",
    "SELECT c_custkey AS k, c_acctbal + CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS v FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0"
)
def a21(spark, sf):
    target, updates = _halves(spark, sf)
    return sinks.insert_new(target, updates, ["k"]).select("k", "v")


for _fmt in sinks.FORMATS:
    query(
        f"a22_write_results_{_fmt}",
        f"WITH {OBS} SELECT scenario, entity, {big('water_month')} AS water_month, {r('avg(storage)')} AS storage_avg FROM obs GROUP BY 1, 2, water_month"
    )(lambda spark, sf, fmt=_fmt: _results(spark, sf, fmt))


def _results(spark, sf, fmt):
    path = shared_path(spark, f"results-{fmt}")
    rows = stats.distribution_stats(obs(spark, sf), stats.MONTH, "storage", "storage_").select(*stats.MONTH, "storage_avg")
    sinks.write_results(rows, fmt, path)
    reader = spark.read.schema(rows.schema).format(fmt)
    return (reader.option("header", True) if fmt == "csv" else reader).load(path)


@query(
    "j1_stream_scenarios",
    f"{FULL} SELECT scenario, variable AS entity, {big('(month(ts) + 2) % 12 + 1')} AS water_month, {r('avg(value)')} AS value_avg, count(value) "
    "AS sample_count, 's0077,s0099' AS errors FROM cells WHERE value IS NOT NULL AND variable IN ('V1', 'V7', 'V10', 'V33') GROUP BY 1, 2, 3"
)
def j1(spark, sf):
    """Two drops: scenarios one by one, one sent twice in the first (its older file with other values) and again in the
    second; an annual file with a year that is none, which fails; and a file that is no export."""
    base = shared_path(spark, "stream")
    rows = numbered(monthly(spark, sf)).withColumn("units", F.lit("CFS"))

    def send(series):
        lines = sinks.dss_lines(series).repartition("scenario").sortWithinPartitions("scenario", "place")
        lines.select(F.col("scenario").alias("scenario"), F.col("line").alias("value")).write.mode("append").partitionBy("scenario").text(f"{base}/in")

    def say(scenario, *lines):
        rows = spark.createDataFrame([(scenario, n, line) for n, line in enumerate(lines)], "scenario string, n int, value string")
        rows.coalesce(1).sortWithinPartitions("n").drop("n").write.mode("append").partitionBy("scenario").text(f"{base}/in")

    for scenarios in (["s0001", "s0002"], ["s0002", "s0003"]):
        own = rows.where(F.col("scenario").isin(*scenarios))
        if "s0001" in scenarios:
            send(own.where("scenario = 's0001'").withColumn("value", F.col("value") + 1))
            time.sleep(1.1)  # files are told apart by the second in which they were written
            say("s0077", "a,x", "b,V1", "units,TAF", "1921,1.5", "1850,2")
        else:
            say("s0099", "nothing,here")
        send(own)
        incremental.stream_scenarios(spark, f"{base}/in", f"{base}/out", variables=["V1", "V7", "V10", "V33"])
    errors = incremental.errors(spark, f"{base}/out").agg(F.array_join(F.array_sort(F.collect_set("scenario")), ",").alias("errors"))
    return incremental.results(spark, f"{base}/out").select(*stats.MONTH, "value_avg", "sample_count").crossJoin(F.broadcast(errors))
