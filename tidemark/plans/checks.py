"""Queries of the checks (H) and of the change log (J2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalars import rounded
from tidemark.operators import quality as Q
from tidemark.operators import stats
from tidemark.plans.bindings import OBS, obs
from tidemark.plans.registry import big, query, r, table
from tidemark.streaming import incremental

# Cells by (b, c, date) of orders; the test side has changes at fixed keys, and leaves out some keys.
REF = (
    "ref AS (SELECT 'B' || o_custkey AS b, o_orderstatus AS c, CAST(o_orderdate AS DATE) AS date, min(o_orderkey) AS k, min(CASE WHEN o_orderkey % "
    "91 <> 0 THEN o_totalprice END) AS value FROM orders WHERE o_custkey % 10 <> 9 GROUP BY 1, 2, 3)"
)
TEST = (
    "test AS (SELECT 'B' || o_custkey AS b, o_orderstatus AS c, CAST(o_orderdate AS DATE) AS date, min(CASE WHEN o_orderkey % 71 <> 0 THEN "
    "o_totalprice + CASE WHEN o_orderkey % 50 = 0 THEN 0.5 WHEN o_orderkey % 37 = 0 THEN 40.0 ELSE 0.0 END END) AS value FROM orders WHERE "
    "o_custkey % 10 <> 8 AND o_orderdate < DATE '2001-01-01' GROUP BY 1, 2, 3)"
)
CELLS = f"""WITH {REF}, {TEST}, span AS (SELECT greatest((SELECT min(date) FROM ref), (SELECT min(date) FROM test)) AS lo, least((SELECT max(date) FROM ref), (SELECT max(date) FROM test)) AS hi),
  cells AS (SELECT b, c, date, ref.value AS ref_value, test.value AS file_value, abs(ref.value - test.value) AS abs_diff,
    (ref.value IS NULL AND test.value IS NULL) OR coalesce(abs(ref.value - test.value) <= 1e-6 + 1e-6 * abs(test.value), false) AS equal FROM ref JOIN test USING (b, c, date), span WHERE date BETWEEN lo AND hi)"""
KIND = "CASE WHEN ref_value IS NULL THEN 'missing_in_ref' WHEN file_value IS NULL THEN 'missing_in_file' WHEN abs_diff >= 1.0 THEN 'value_difference' ELSE 'tolerance_exceeded' END"


def _side(spark, sf, value, where):
    o = table(spark, sf, "orders").where(where)
    return o.groupBy(
        F.concat(F.lit("B"), F.col("o_custkey").cast("string")).alias("b"), F.col("o_orderstatus").alias("c"),
        F.col("o_orderdate").cast("date").alias("date")
    ).agg(F.min(value).alias("value"))


def sides(spark, sf):
    k, p = F.col("o_orderkey"), F.col("o_totalprice")
    ref = _side(spark, sf, F.when(k % 91 != 0, p), "o_custkey % 10 <> 9")
    changed = p + F.when(k % 50 == 0, 0.5).when(k % 37 == 0, 40.0).otherwise(0.0)
    return ref, _side(spark, sf, F.when(k % 71 != 0, changed), "o_custkey % 10 <> 8 and o_orderdate < '2001-01-01'")


def cells(spark, sf):
    return Q.compare_series(*sides(spark, sf))


@query("h1_compare_series", f"{CELLS} SELECT b, c, date, ref_value, file_value, {r('abs_diff', 6)} AS abs_diff, equal FROM cells")
def h1(spark, sf):
    return cells(spark, sf).withColumn("abs_diff", rounded(F.col("abs_diff"), 6))


@query(
    "h2_compare_summary",
    f"{CELLS}, a AS (SELECT DISTINCT b, c FROM ref), t AS (SELECT DISTINCT b, c FROM test), bad AS (SELECT b, c, count(*) AS n FROM cells WHERE NOT equal GROUP BY 1, 2) "
    "SELECT (SELECT count(*) FROM a) AS ref_columns, (SELECT count(*) FROM t) AS file_columns, (SELECT count(*) FROM a JOIN t USING (b, c)) AS "
    "common_columns, (SELECT count(*) FROM a LEFT JOIN t ON a.b = t.b AND a.c = t.c WHERE t.b IS NULL) AS only_in_ref, (SELECT count(*) FROM t "
    "LEFT JOIN a ON a.b = t.b AND a.c = t.c WHERE a.b IS NULL) AS only_in_file, "
    f"(SELECT count(*) FROM bad) AS mismatch_columns, {big('(SELECT coalesce(sum(n), 0) FROM bad)')} AS mismatch_cells, lo AS first_date, hi AS "
    "last_date, CASE WHEN (SELECT count(*) FROM bad) = 0 THEN 'PASSED' ELSE 'FAILED' END AS status FROM span",
)
def h2(spark, sf):
    return Q.compare_summary(*sides(spark, sf))


@query("h3_mismatch_detail", f"{CELLS} SELECT b, c, date, {KIND} AS mismatch_type FROM cells WHERE NOT equal")
def h3(spark, sf):
    return Q.mismatch_detail(cells(spark, sf)).select("b", "c", "date", "mismatch_type")


@query(
    "h3_mismatch_rates",
    f"{CELLS} SELECT b, c, count(*) AS cells, count(*) FILTER (WHERE NOT equal) AS mismatches, "
    f"{r('count(*) FILTER (WHERE NOT equal) * 100.0::DOUBLE / count(*)', 4)} AS mismatch_rate_pct FROM cells GROUP BY 1, 2"
)
def h3_rates(spark, sf):
    return Q.mismatch_rates(cells(spark, sf))


@query(
    "h4_mismatch_patterns",
    f"{CELLS}, m AS (SELECT *, {KIND} AS mismatch_type FROM cells WHERE NOT equal) SELECT mismatch_type, b, count(*) AS n, "
    f"{r('avg(abs_diff)', 6)} AS mean_diff, {r('quantile_cont(abs_diff, 0.5)', 6)} AS median_diff, {r('max(abs_diff)', 6)} AS max_diff FROM m "
    "GROUP BY 1, 2 ORDER BY n DESC, mismatch_type, b LIMIT 10"
)
def h4(spark, sf):
    return Q.mismatch_patterns(Q.mismatch_detail(cells(spark, sf)))


@query(
    "h4_pass_rates",
    "SELECT o_orderstatus AS scenario, count(*) AS runs, count(*) FILTER (WHERE o_custkey % 3 <> 0) AS passed, "
    f"{r('count(*) FILTER (WHERE o_custkey % 3 <> 0) * 100.0::DOUBLE / count(*)')} AS pass_rate_pct FROM orders GROUP BY 1"
)
def h4_rates(spark, sf):
    return Q.pass_rates(table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("scenario"), F.when(F.col("o_custkey") % 3 != 0, "PASSED").otherwise("FAILED").alias("status")
    ))


METRICS = (
    "m AS (SELECT CASE WHEN l_suppkey % 2 = 0 THEN 'All_Prob_S_' ELSE 'Apr_Avg_S_' END || l_suppkey AS metric, l_suppkey AS k, "
    "round(avg(l_discount), 6) AS value FROM lineitem GROUP BY l_suppkey)"
)


@query(
    "h5_verify_metrics",
    f"WITH {METRICS}, e AS (SELECT metric, CASE WHEN k % 10 = 1 THEN 0.0 WHEN k % 2 = 0 THEN value * 100 ELSE value + CASE WHEN k % 4 = 1 THEN 0.001 ELSE 0 END END AS given FROM m WHERE k % 7 <> 0), "
    "x AS (SELECT m.metric, m.value AS calculated, CASE WHEN contains(m.metric, 'Prob_') AND given > 1 THEN given / 100 ELSE given END AS "
    "expected, e.metric IS NOT NULL AS there FROM m LEFT JOIN e USING (metric)), "
    "y AS (SELECT *, CASE WHEN expected = 0 THEN abs(calculated) ELSE abs((calculated - expected) / expected) END AS error FROM x) "
    f"SELECT metric, {r('calculated', 6)} AS calculated, {r('expected', 6)} AS expected, {r('error', 6)} AS error, CASE WHEN NOT there THEN "
    "'MISSING' WHEN error < 1e-4 THEN 'PASS' ELSE 'FAIL' END AS status FROM y",
)
def h5(spark, sf):
    k = F.col("l_suppkey")
    m = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.round(F.avg("l_discount"), 6).alias("value")).select(
        F.concat(F.when(k % 2 == 0, "All_Prob_S_").otherwise("Apr_Avg_S_"), k.cast("string")).alias("metric"), k.alias("k"), "value"
    )
    n, v = F.col("k"), F.col("value")
    expected = m.where("k % 7 <> 0").select(
        "metric", F.when(n % 10 == 1, 0.0).when(n % 2 == 0, v * 100).otherwise(v + F.when(n % 4 == 1, 0.001).otherwise(0.0)).alias("value")
    )
    out = Q.verify_metrics(m.select("metric", "value"), expected)
    return out.select("metric", *(rounded(F.col(c), 6).alias(c) for c in ("calculated", "expected", "error")), "status")


PCT = "p AS (SELECT scenario, entity, water_month, quantile_cont(storage, 0.1) AS q10, quantile_cont(storage, 0.5) AS q50, quantile_cont(storage, 0.9) AS q90 FROM obs GROUP BY 1, 2, 3)"


@query(
    "h6_compare_percentiles",
    f"WITH {OBS}, {PCT} SELECT 'q10' AS percentile, count(*) AS total, {big('0')} AS failures FROM p UNION ALL SELECT 'q50', count(*), count(*) "
    "FILTER (WHERE entity % 5 = 0) FROM p UNION ALL SELECT 'q90', count(*), count(*) FILTER (WHERE entity % 9 = 0) FROM p"
)
def h6(spark, sf):
    p = stats.distribution_stats(obs(spark, sf), stats.MONTH, "storage").select(*stats.MONTH, "q10", "q50", "q90")
    e = p.withColumns({"q50": F.col("q50") * F.when(F.col("entity") % 5 == 0, 1.01).otherwise(1.0), "q90": F.when(F.col("entity") % 9 != 0, F.col("q90"))})
    return Q.compare_percentiles(p, e, stats.MONTH, ["q10", "q50", "q90"])


@query(
    "h7_orphans",
    "SELECT 'items' AS \"table\", count(*) AS orphans FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 10 "
    "<> 0) UNION ALL SELECT 'parts', count(*) FROM part WHERE p_partkey % 150 NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 10 <> "
    "0)"
)
def h7(spark, sf):
    dim = table(spark, sf, "supplier").where("s_suppkey % 10 <> 0").select(F.col("s_suppkey").alias("key"))
    return Q.orphans(
        {
            "items": table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("key")),
            "parts": table(spark, sf, "part").select((F.col("p_partkey") % 150).alias("key"))
        },
        dim, "key"
    )


@query(
    "h8_completeness",
    "WITH s AS (SELECT DISTINCT o_custkey % 20 AS scenario FROM orders), a AS (SELECT l_suppkey % 20 AS scenario, count(*) AS n FROM lineitem "
    "WHERE l_suppkey % 20 <> 3 GROUP BY 1), b AS (SELECT p_partkey % 20 AS scenario, count(*) AS n FROM part WHERE p_partkey % 20 NOT IN (3, 5) "
    "GROUP BY 1) SELECT scenario, coalesce(a.n, 0) AS storage_rows, coalesce(b.n, 0) AS urban_rows, CASE WHEN a.n IS NULL THEN 'missing "
    "storage' WHEN b.n IS NULL THEN 'missing urban' ELSE 'OK' END AS status FROM s LEFT JOIN a USING (scenario) LEFT JOIN b USING (scenario)"
)
def h8(spark, sf):
    s = table(spark, sf, "orders").select((F.col("o_custkey") % 20).alias("scenario")).distinct()
    return Q.completeness(
        s,
        {
            "storage": table(spark, sf, "lineitem").select((F.col("l_suppkey") % 20).alias("scenario")).where("scenario <> 3"),
            "urban": table(spark, sf, "part").select((F.col("p_partkey") % 20).alias("scenario")).where("scenario not in (3, 5)")
        }
    )


def _gapped(spark, sf):
    return {
        "items": table(spark, sf, "lineitem").select(F.when(F.col("l_orderkey") % 71 != 0, F.month("l_shipdate")).alias("m")),
        "orders": table(spark, sf, "orders").select((F.month("o_orderdate") + F.when(F.col("o_orderkey") % 13 == 0, 6).otherwise(0)).alias("m"))
    }


@query(
    "h9_null_audit",
    "SELECT 'items' AS \"table\", count(*) AS total, count(*) FILTER (WHERE l_orderkey % 71 = 0) AS missing FROM lineitem UNION ALL SELECT 'orders', count(*), 0 FROM orders"
)
def h9(spark, sf):
    return Q.null_audit(_gapped(spark, sf), "m")


@query(
    "h10_range_check",
    f"SELECT 'items' AS \"table\", {big('0')} AS outside UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_orderkey % 13 = 0 AND month(o_orderdate) > 6"
)
def h10(spark, sf):
    return Q.range_check(_gapped(spark, sf), "m", 1, 12)


@query(
    "h11_table_profile",
    "SELECT 'orders' AS \"table\", count(*) AS \"rows\", CAST(3 AS BIGINT) AS columns, 'o_orderkey:bigint, created_by:bigint, "
    "created_at:timestamp' AS types, true AS has_audit_columns, count(DISTINCT o_custkey) AS creators, min(o_orderdate) AS first_created, "
    "max(o_orderdate) AS last_created FROM orders "
    "UNION ALL SELECT 'region', count(*), 2, 'r_regionkey:int, r_name:string', false, NULL, NULL, NULL FROM region",
)
def h11(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("created_by"), F.col("o_orderdate").cast("timestamp").alias("created_at"))
    return Q.table_profile({"orders": o, "region": table(spark, sf, "region")})


@query(
    "h12_schema_diff",
    "WITH e AS (SELECT DISTINCT p_brand AS t, p_type AS c FROM part WHERE p_size < 10), a AS (SELECT DISTINCT p_brand AS t, p_type AS c FROM "
    "part WHERE p_size > 40) SELECT coalesce(e.t, a.t) AS \"table\", coalesce(e.c, a.c) AS \"column\", CASE WHEN a.t IS NULL THEN "
    "'only_expected' ELSE 'only_actual' END AS side FROM e FULL JOIN a ON e.t = a.t AND e.c = a.c WHERE e.t IS NULL OR a.t IS NULL"
)
def h12(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_brand").alias("table"), F.col("p_type").alias("column"), "p_size")
    return Q.schema_diff(p.where("p_size < 10"), p.where("p_size > 40"))


@query(
    "h13_attach_entity_ids",
    "SELECT count(*) AS total, count(*) FILTER (WHERE s.s_suppkey IS NULL) AS unmapped FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 6 <> 0) s ON s.s_suppkey = l_suppkey"
)
def h13(spark, sf):
    codes = table(spark, sf, "supplier").where("s_suppkey % 6 <> 0").select(F.col("s_name").alias("code"), F.col("s_suppkey").alias("id"))
    facts = table(spark, sf, "lineitem").join(
        table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "left"
    ).select(F.col("s_name").alias("code"), "l_orderkey")
    return Q.unmapped(Q.attach_entity_ids(facts, codes))


@query(
    "h14_row_counts",
    "SELECT 'lineitem' AS \"table\", count(*) AS \"rows\" FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'part', count(*) FROM part"
)
def h14(spark, sf):
    return Q.row_counts({n: table(spark, sf, n) for n in ("part", "orders", "lineitem")})


@query(
    "j2_change_log",
    "WITH o AS (SELECT c_custkey AS id, c_acctbal AS balance, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS segment FROM customer WHERE c_custkey % 19 <> 0), "
    "n AS (SELECT c_custkey AS id, c_acctbal + CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END AS balance, CASE WHEN c_custkey % 6 <> 0 THEN "
    "c_mktsegment END AS segment FROM customer WHERE c_custkey % 17 <> 0), "
    "j AS (SELECT coalesce(o.id, n.id) AS id, o.id IS NULL AS added, n.id IS NULL AS gone, o.balance IS DISTINCT FROM n.balance AS b, o.segment "
    "IS DISTINCT FROM n.segment AS s FROM o FULL JOIN n ON o.id = n.id) "
    "SELECT 'customer' AS table_name, id AS record_id, CASE WHEN added THEN 'INSERT' WHEN gone THEN 'DELETE' ELSE 'UPDATE' END AS operation, "
    "CASE WHEN NOT added AND NOT gone THEN concat_ws(',', CASE WHEN b THEN 'balance' END, CASE WHEN s THEN 'segment' END) END AS changed FROM j "
    "WHERE added OR gone OR b OR s",
)
def j2(spark, sf):
    c, k = table(spark, sf, "customer"), F.col("c_custkey")
    old = c.where("c_custkey % 19 <> 0").select(k.alias("id"), F.col("c_acctbal").alias("balance"), F.when(k % 4 != 0, F.col("c_mktsegment")).alias("segment"))
    new = c.where("c_custkey % 17 <> 0").select(
        k.alias("id"), (F.col("c_acctbal") + F.when(k % 10 == 0, 1).otherwise(0)).alias("balance"),
        F.when(k % 6 != 0, F.col("c_mktsegment")).alias("segment")
    )
    out = incremental.change_log(old, new, "id", "customer")
    return out.select("table_name", "record_id", "operation", F.array_join("changed_fields", ",").alias("changed"))
