"""Queries of the statistics (D) and of the calendar and scalar functions (B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import calendar, scalars
from tidemark.operators import families, selection, stats
from tidemark.operators.stats import ENTITY, EXCEEDANCES, MONTH, QUANTILES, YEAR
from tidemark.plans.bindings import OBS, OBS_RES, obs, reservoirs
from tidemark.plans.registry import big, query, r, table
from tidemark.sources.layout import SeriesTable

E_, M_, Y_ = ", ".join(ENTITY), f"{', '.join(ENTITY)}, {big('water_month')} AS water_month", f"{', '.join(ENTITY)}, {big('water_year')} AS water_year"
GM = "GROUP BY scenario, entity, water_month"
GE = "GROUP BY scenario, entity"


def q_sql(v: str, scale: str = "1.0", suffix: str = "", exceed: bool = True) -> str:
    """Quantile and exceedance columns of ``stats.bands``."""
    out = [f"{r(f'quantile_cont({v}, {p / 100}) * {scale}')} AS q{p}{suffix}" for p in QUANTILES]
    if exceed:
        out += [f"{r(f'quantile_cont({v}, {(100 - p) / 100}) * {scale}')} AS exc_p{p}{suffix}" for p in EXCEEDANCES]
    return ", ".join(out)


def exc_sql(v: str, prefix: str) -> str:
    return ", ".join(f"{r(f'quantile_cont({v}, {(100 - p) / 100})')} AS {prefix}_exc_p{p}" for p in EXCEEDANCES)


def cv_sql(v: str) -> str:
    return f"CASE WHEN avg({v}) > 0 THEN {r(f'stddev_samp({v}) / avg({v})', 4)} ELSE 0.0 END"


def share_sql(hit: str, months: str = "") -> str:
    inside = f"storage IS NOT NULL{months and f' AND calendar_month IN ({months})'}"
    return f"coalesce(count(*) FILTER (WHERE {inside} AND {hit})::DOUBLE / nullif(count(*) FILTER (WHERE {inside}), 0), 0.0)"


def cv6_sql(v: str) -> str:
    return f"CASE WHEN count({v}) = 0 OR avg({v}) = 0 THEN 0.0 ELSE {r(f'stddev_samp({v}) / avg({v})', 6)} END"


FLOOD_SQL, DEAD_SQL = "storage - flood_threshold + 1e-6 >= 0", "storage <= dead_threshold"
IN = "CASE WHEN calendar_month = {} THEN storage END"


@query(
    "d1_distribution_stats",
    f"WITH {OBS} SELECT {M_}, {r('avg(delivery)')} AS delivery_avg, {cv_sql('delivery')} AS delivery_cv, {q_sql('delivery')}, count(delivery) AS sample_count FROM obs WHERE delivery IS NOT NULL {GM}"
)
def d1(spark, sf):
    return stats.distribution_stats(obs(spark, sf), MONTH, "delivery", "delivery_")


STORAGE = (
    f"{r('avg(storage)')} AS storage_avg_taf, {cv_sql('storage')} AS storage_cv, {r('avg(storage) * (100.0 / capacity_taf)')} AS "
    f"storage_pct_capacity, {q_sql('storage', '(100.0 / capacity_taf)')}, {q_sql('storage', '1.0', '_taf')}, capacity_taf, count(storage) AS "
    "sample_count"
)


@query("d2_storage_monthly", f"{OBS_RES} SELECT {M_}, {STORAGE} FROM held {GM}, capacity_taf")
def d2(spark, sf):
    return stats.storage_monthly(obs(spark, sf), reservoirs(spark, sf))


SELECTED = ", ".join(f"{r(f'quantile_cont(l_extendedprice, {p})', 4)} AS q{i}" for i, p in enumerate(stats.LEVELS))


@query(
    "d1_exact_quantiles",
    "WITH x AS (SELECT l_extendedprice, l_returnflag, 'all' AS kind FROM lineitem UNION ALL SELECT l_extendedprice, l_returnflag, 'flag ' || "
    f"l_returnflag FROM lineitem) SELECT kind, {SELECTED}, count(l_extendedprice) AS sample_count FROM x GROUP BY kind"
)
def d1_selection(spark, sf):
    """Quantiles of all rows as one group, and of three large ones, with no group held by a task."""
    rows = table(spark, sf, "lineitem").select("l_extendedprice", F.explode(F.array(F.lit("all"), F.concat(F.lit("flag "), "l_returnflag"))).alias("kind"))
    out = selection.exact_quantiles(rows, ["kind"], "l_extendedprice", stats.LEVELS, "q")
    return out.select("kind", *(scalars.rounded(F.get("q", F.lit(i)), 4).alias(f"q{i}") for i in range(len(stats.LEVELS))), "sample_count")


@query("d2_series_table", f"{OBS_RES} SELECT {M_}, {STORAGE} FROM held {GM}, capacity_taf")
def d2_table(spark, sf):
    """The same statistics from the bucketed table, without a shuffle of the series."""
    return stats.storage_monthly(SeriesTable.create(obs(spark, sf)).read(), reservoirs(spark, sf))


BANDS = f"{q_sql('storage', '(100.0 / capacity_taf)', '', False)}, {r('avg(storage) * (100.0 / capacity_taf)')} AS mean, {q_sql('storage', '1.0', '_taf', False)}, {r('avg(storage)')} AS mean_taf"
BAND_NAMES = [f"q{p}" for p in QUANTILES] + ["mean"] + [f"q{p}_taf" for p in QUANTILES] + ["mean_taf"]


@query("d3_percentile_bands", f"{OBS_RES} SELECT {M_}, {BANDS} FROM held {GM}, capacity_taf")
def d3(spark, sf):
    return stats.percentile_bands(obs(spark, sf), reservoirs(spark, sf))


@query(
    "d3_percentile_bands_filled",
    f"{OBS_RES}, part AS (SELECT * FROM held WHERE water_month <= 9 OR entity % 2 = 0), b AS (SELECT scenario, entity, water_month, {BANDS} FROM part {GM}, capacity_taf), "
    f"grid AS (SELECT e.scenario, e.entity, m.m AS water_month FROM (SELECT DISTINCT scenario, entity FROM part) e, range(1, 13) m(m)) "
    f"SELECT g.scenario, g.entity, {big('g.water_month')} AS water_month, {', '.join(f'coalesce(b.{c}, 0.0) AS {c}' for c in BAND_NAMES)} FROM "
    "grid g LEFT JOIN b ON b.scenario = g.scenario AND b.entity = g.entity AND b.water_month = g.water_month",
)
def d3_filled(spark, sf):
    return stats.percentile_bands(obs(spark, sf).where("water_month <= 9 or entity % 2 = 0"), reservoirs(spark, sf), fill_empty=True)


@query(
    "d4_calendar_month_percentiles",
    f"{OBS_RES} SELECT scenario, entity, {big('calendar_month')} AS calendar_month, {BANDS} FROM held {GE}, calendar_month, capacity_taf"
)
def d4(spark, sf):
    return stats.calendar_month_percentiles(obs(spark, sf), reservoirs(spark, sf))


OWN = "CASE WHEN spill > 0 THEN spill END"


@query(
    "d5_spill_monthly",
    f"{OBS_RES} SELECT {M_}, count(*) FILTER (WHERE spill > 0) AS spill_months_count, count(*) AS total_months, "
    f"{r('count(*) FILTER (WHERE spill > 0) * 100.0::DOUBLE / count(*)')} AS spill_frequency_pct, "
    f"coalesce({r(f'avg({OWN})')}, 0.0) AS spill_avg_cfs, coalesce({r(f'max({OWN})')}, 0.0) AS spill_max_cfs, "
    f"{', '.join(f'coalesce({r(f"quantile_cont({OWN}, {p / 100})")}, 0.0) AS spill_q{p}' for p in (50, 90, 100))}, "
    f"{r('avg(CASE WHEN spill > 0 THEN storage * 100 / capacity_taf END)')} AS storage_at_spill_avg_pct FROM held {GM}",
)
def d5(spark, sf):
    return stats.spill_monthly(obs(spark, sf), reservoirs(spark, sf))


SHORT_M = (
    f"{r('avg(shortage)')} AS shortage_avg_taf, {cv_sql('shortage')} AS shortage_cv, "
    f"{r('count(*) FILTER (WHERE shortage > 0.1::DOUBLE) * 100.0::DOUBLE / count(shortage)')} AS shortage_frequency_pct, {q_sql('shortage')}, "
    "count(shortage) AS sample_count"
)


@query("d6_shortage_monthly", f"WITH {OBS} SELECT {M_}, {SHORT_M} FROM obs WHERE shortage IS NOT NULL {GM}")
def d6(spark, sf):
    return stats.shortage_monthly(obs(spark, sf))


SHORT_PCT = r("avg(CASE WHEN demand > 0 THEN shortage * 100 / demand ELSE 0.0 END)")


@query("d7_shortage_pct_of_demand", f"WITH {OBS} SELECT {M_}, {SHORT_PCT} AS shortage_pct_of_demand FROM obs WHERE shortage IS NOT NULL AND demand IS NOT NULL {GM}")
def d7(spark, sf):
    return stats.shortage_pct_of_demand(obs(spark, sf))


MET = "CASE WHEN demand_avg_taf > 0 THEN least(greatest(delivery_avg_taf * 100 / demand_avg_taf, 0.0), 100.0) END"
MET_CTE = f"met AS (SELECT scenario, entity, water_month, {r('avg(delivery)')} AS delivery_avg_taf, {r('avg(demand)')} AS demand_avg_taf FROM obs {GM})"


@query(
    "d8_monthly_demand_met",
    f"WITH {OBS}, {MET_CTE} SELECT {M_}, delivery_avg_taf, demand_avg_taf, {r(MET)} AS percent_of_demand_avg FROM met WHERE delivery_avg_taf IS NOT NULL"
)
def d8(spark, sf):
    return stats.monthly_demand_met(obs(spark, sf))


YEARLY = (
    "yearly AS (SELECT scenario, entity, water_year, coalesce(sum(delivery), 0.0) AS delivery, coalesce(sum(shortage), 0.0) AS shortage, "
    f"coalesce(sum(demand), 0.0) AS demand FROM obs {GE}, water_year)"
)


@query("d9_annual_totals", f"WITH {OBS}, {YEARLY} SELECT {Y_}, {r('delivery', 6)} AS delivery, {r('shortage', 6)} AS shortage, {r('demand', 6)} AS demand FROM yearly")
def d9(spark, sf):
    out = stats.annual_totals(obs(spark, sf), ["delivery", "shortage", "demand"])
    return out.select(*YEAR, *(scalars.rounded(F.col(c), 6).alias(c) for c in ("delivery", "shortage", "demand")))


SPAN = f"{big('min(water_year)')} AS simulation_start_year, {big('max(water_year)')} AS simulation_end_year, count(DISTINCT water_year) AS total_years"


@query("d10_period_span", f"WITH {OBS} SELECT scenario, {SPAN} FROM obs GROUP BY scenario")
def d10(spark, sf):
    return stats.period_span(obs(spark, sf))


def annual_sql(v: str, prefix: str) -> str:
    return (
        f"{r(f'avg({v})')} AS annual_{prefix}_avg_taf, {cv_sql(v)} AS annual_{prefix}_cv, {r(f'min({v})')} AS annual_{prefix}_min_taf, "
        f"{r(f'max({v})')} AS annual_{prefix}_max_taf, {exc_sql(v, prefix)}"
    )


def short_sql(floor: str) -> str:
    return (
        f"{r('avg(shortage)')} AS annual_shortage_avg_taf, count(*) FILTER (WHERE shortage > {floor}) AS shortage_years_count, "
        f"{r(f'count(*) FILTER (WHERE shortage > {floor}) * 100.0::DOUBLE / count(shortage)')} AS shortage_frequency_pct, "
        f"{exc_sql('shortage', 'shortage')}"
    )


@query("d11_annual_summary", f"WITH {OBS}, {YEARLY} SELECT {E_}, {annual_sql('delivery', 'delivery')} FROM yearly {GE}")
def d11(spark, sf):
    return stats.annual_summary(stats.annual_totals(obs(spark, sf), ["delivery"]), "delivery", "delivery")


@query("d12_annual_shortage_summary", f"WITH {OBS}, {YEARLY} SELECT {E_}, {short_sql('0.1::DOUBLE')} FROM yearly {GE}")
def d12(spark, sf):
    return stats.annual_shortage_summary(stats.annual_totals(obs(spark, sf), ["shortage"]))


RELIABLE = {
    "ratio": f"CASE WHEN annual_delivery_avg_taf > 0 THEN {r('(1 - annual_shortage_avg_taf / annual_delivery_avg_taf) * 100')} END",
    "frequency": r("100 - shortage_frequency_pct"),
    "demand": f"CASE WHEN annual_demand_avg_taf > 0 AND annual_shortage_avg_taf IS NOT NULL THEN {r('(annual_demand_avg_taf - annual_shortage_avg_taf) * 100 / annual_demand_avg_taf')} ELSE 100.0 END",
}
SUMMARY = (
    f"summary AS (SELECT {E_}, {r('avg(delivery)')} AS annual_delivery_avg_taf, {r('avg(shortage)')} AS annual_shortage_avg_taf, {r('avg(demand)')} "
    f"AS annual_demand_avg_taf, {r('count(*) FILTER (WHERE shortage > 0.1::DOUBLE) * 100.0::DOUBLE / count(shortage)')} AS shortage_frequency_pct "
    f"FROM yearly {GE})"
)


def _summary(spark, sf):
    annual = stats.annual_totals(obs(spark, sf), ["delivery", "shortage", "demand"])
    return annual.groupBy(*ENTITY).agg(
        *(scalars.rounded(F.avg(c)).alias(f"annual_{c}_avg_taf") for c in ("delivery", "shortage", "demand")),
        scalars.rounded(F.count_if(F.col("shortage") > scalars.SHORTAGE_FLOOR) * 100.0 / F.count("shortage")).alias("shortage_frequency_pct")
    )


for _mode, _sql in RELIABLE.items():
    query(
        f"d13_reliability_{_mode}", f"WITH {OBS}, {YEARLY}, {SUMMARY} SELECT *, {_sql} AS reliability_pct FROM summary"
    )(lambda spark, sf, mode=_mode: stats.reliability(_summary(spark, sf), mode))

OF_MEANS = r("CASE WHEN avg(demand) > 0 THEN least(greatest(avg(delivery) * 100 / avg(demand), 0.0), 100.0) END")
OF_YEARS = r("avg(CASE WHEN demand > 0 THEN least(greatest(delivery * 100 / demand, 0.0), 100.0) END)")
for _mode, _sql in (("of_means", OF_MEANS), ("mean_of_years", OF_YEARS)):
    query(f"d14_annual_demand_met_{_mode}", f"WITH {OBS}, {YEARLY} SELECT {E_}, {_sql} AS avg_pct_demand_met FROM yearly {GE}")(
        lambda spark, sf, mode=_mode: stats.annual_demand_met(stats.annual_totals(obs(spark, sf), ["delivery", "demand"]), mode)
    )

PUMPED = "pumped AS (SELECT * REPLACE (coalesce(pumping, greatest(demand - coalesce(delivery, 0.0), 0.0)) AS pumping) FROM obs)"
FARM = (
    f"WITH {OBS}, {PUMPED}, yearly AS (SELECT scenario, entity, water_year, coalesce(sum(demand), 0.0) AS demand, coalesce(sum(delivery), 0.0) "
    f"AS delivery, coalesce(sum(pumping), 0.0) AS pumping, coalesce(sum(shortage), 0.0) AS shortage FROM pumped {GE}, water_year), "
    f"seen AS (SELECT scenario, entity, count(shortage) AS n FROM pumped {GE}), "
    f"agg AS (SELECT {E_}, {r('avg(demand)')} AS annual_demand_avg_taf, {cv_sql('demand')} AS annual_demand_cv, {exc_sql('demand', 'demand')}, "
    f"{r('avg(delivery)')} AS annual_sw_delivery_avg_taf, {cv_sql('delivery')} AS annual_sw_delivery_cv, {r('avg(pumping)')} AS "
    f"annual_gw_pumping_avg_taf, {cv_sql('pumping')} AS annual_gw_pumping_cv, "
    f"{r('avg(shortage)')} AS s_avg, count(*) FILTER (WHERE shortage > 0.1::DOUBLE) AS s_years, "
    f"{r('count(*) FILTER (WHERE shortage > 0.1::DOUBLE) * 100.0::DOUBLE / count(shortage)')} AS s_freq, "
    f"{r('avg(CASE WHEN demand > 0 THEN shortage * 100 / demand ELSE 0.0 END)')} AS s_pct FROM yearly {GE}), "
    f"span AS (SELECT scenario, {SPAN} FROM obs GROUP BY scenario), "
    "j AS (SELECT a.* EXCLUDE (s_avg, s_years, s_freq, s_pct), CASE WHEN n > 0 THEN s_avg END AS annual_shortage_avg_taf, CASE WHEN n > 0 THEN "
    "s_years END AS shortage_years_count, CASE WHEN n > 0 THEN s_freq END AS shortage_frequency_pct, CASE WHEN n > 0 THEN s_pct END AS "
    "annual_shortage_pct_of_demand, "
    f"CASE WHEN annual_demand_avg_taf > 0 THEN {r('annual_gw_pumping_avg_taf * 100 / annual_demand_avg_taf')} ELSE {r('0.0')} END AS "
    "gw_pumping_pct_of_demand FROM agg a JOIN seen USING (scenario, entity)) "
    f"SELECT j.*, {RELIABLE['demand']} AS reliability_pct, simulation_start_year, simulation_end_year, total_years FROM j JOIN span USING (scenario)"
)


@query("d15_farm_period_summary", FARM)
def d15(spark, sf):
    return families.farm_period_summary(obs(spark, sf))


@query(
    "d16_storage_exceedance",
    f"{OBS_RES} SELECT {E_}, {', '.join(f'{r(f"quantile_cont(storage, {(100 - p) / 100}) * 100 / capacity_taf")} AS storage_exc_p{p}' for p in EXCEEDANCES)} FROM held {GE}, capacity_taf"
)
def d16(spark, sf):
    return stats.storage_exceedance(obs(spark, sf), reservoirs(spark, sf))


SPILL_P = (
    f"sy AS (SELECT scenario, entity, water_year, sum({OWN}) AS s, count({OWN}) AS n, min({OWN}) AS lo, max({OWN}) AS hi, coalesce(sum({OWN} * "
    "0.0603), 0.0) AS volume, sum(CASE WHEN spill > 0 THEN storage * 100 / capacity_taf END) AS at_sum, count(CASE WHEN spill > 0 THEN storage "
    f"END) AS at_n FROM held {GE}, water_year), "
    f"sp AS (SELECT {E_}, count(hi) AS spill_years_count, {r('count(hi) * 100.0::DOUBLE / count(*)')} AS spill_frequency_pct, "
    f"coalesce({r('sum(s) / nullif(sum(n), 0)')}, 0.0) AS spill_mean_cfs, coalesce({r('max(hi)')}, 0.0) AS spill_peak_cfs, "
    f"coalesce({r('avg(volume)')}, 0.0) AS annual_spill_avg_taf, coalesce({cv_sql('volume')}, 0.0) AS annual_spill_cv, "
    f"coalesce({r('max(volume)')}, 0.0) AS annual_spill_max_taf, "
    f"{', '.join(f'coalesce({r(f"quantile_cont(hi, {p / 100})")}, 0.0) AS annual_max_spill_q{p}' for p in (50, 90, 100))}, "
    f"{r('sum(at_sum) / nullif(sum(at_n), 0)')} AS storage_at_spill_avg_pct, {r('min(lo)')} AS spill_threshold_cfs FROM sy {GE})"
)


@query("d17_spill_period", f"{OBS_RES}, {SPILL_P} SELECT * FROM sp")
def d17(spark, sf):
    return stats.spill_period(obs(spark, sf), reservoirs(spark, sf))


for _name, _months, _list in (("all", None, ""), ("september", [9], "9"), ("april", [4], "4")):
    query(
        f"d18_flood_probability_{_name}", f"WITH {OBS} SELECT {E_}, {r(share_sql(FLOOD_SQL, _list), 6)} AS flood_probability FROM obs {GE}"
    )(lambda spark, sf, months=_months: stats.flood_probability(obs(spark, sf), months))
    query(
        f"d20_cv_{_name}", f"WITH {OBS} SELECT {E_}, {cv6_sql('storage' if not _list else IN.format(_list))} AS cv FROM obs {GE}"
    )(lambda spark, sf, months=_months: stats.cv(obs(spark, sf), months))
    if _name != "april":
        query(
            f"d19_dead_pool_probability_{_name}", f"WITH {OBS} SELECT {E_}, {r(share_sql(DEAD_SQL, _list), 6)} AS dead_pool_probability FROM obs {GE}"
        )(lambda spark, sf, months=_months: stats.dead_pool_probability(obs(spark, sf), months))

AVERAGE = f"ya AS (SELECT scenario, entity, water_year, avg(storage) AS y FROM obs {GE}, water_year), aa AS (SELECT {E_}, {r('avg(y)')} AS annual_avg_taf FROM ya {GE})"


@query("d21_annual_average", f"WITH {OBS}, {AVERAGE} SELECT * FROM aa")
def d21(spark, sf):
    return stats.annual_average(obs(spark, sf))


@query("d22_monthly_average", f"WITH {OBS} SELECT {E_}, {r(f'avg({IN.format(4)})')} AS monthly_avg_taf FROM obs {GE}")
def d22(spark, sf):
    return stats.monthly_average(obs(spark, sf), 4)


PERIOD = (
    f"{OBS_RES}, {SPILL_P}, {AVERAGE}, single AS (SELECT {E_}, "
    + ", ".join(f"{r(share_sql(FLOOD_SQL, m), 6)} AS flood_pool_prob_{n}" for n, m in (("all", ""), ("september", "9"), ("april", "4")))
    + ", "
    + ", ".join(f"{r(share_sql(DEAD_SQL, m), 6)} AS dead_pool_prob_{n}" for n, m in (("all", ""), ("september", "9")))
    + ", "
    + ", ".join(f"{cv6_sql('storage' if not m else IN.format(m))} AS storage_cv_{n}" for n, m in (("all", ""), ("september", "9"), ("april", "4")))
    + f", {r(f'avg({IN.format(4)})')} AS april_avg_taf, {r(f'avg({IN.format(9)})')} AS september_avg_taf, max(capacity_taf) AS capacity_taf, "
    + ", ".join(f"{r(f'quantile_cont(storage, {(100 - p) / 100}) * 100 / max(capacity_taf)')} AS storage_exc_p{p}" for p in EXCEEDANCES)
    + (
        f" FROM held {GE}), span AS (SELECT scenario, {SPAN} FROM obs GROUP BY scenario), ps AS (SELECT * FROM single JOIN aa USING (scenario, "
        "entity) JOIN sp USING (scenario, entity) JOIN span USING (scenario))"
    )
)


@query("d23_reservoir_period_summary", f"{PERIOD} SELECT * FROM ps")
def d23(spark, sf):
    return families.reservoir_period_summary(obs(spark, sf), reservoirs(spark, sf))


CODES = ("S1", "S2", "SLUIS_CVP", "SLUIS_SWP")
CODE_SQL = "CASE entity WHEN 1 THEN 'S1' WHEN 2 THEN 'S2' WHEN 3 THEN 'SLUIS_CVP' WHEN 4 THEN 'SLUIS_SWP' END"


def _wide_sql() -> str:
    parts = {
        "flood_all": share_sql(FLOOD_SQL), "flood_sep": share_sql(FLOOD_SQL, "9"), "dead_all": share_sql(DEAD_SQL),
        "dead_sep": share_sql(DEAD_SQL, "9"), "avg_apr": f"avg({IN.format(4)})", "avg_sep": f"avg({IN.format(9)})", "cv_apr": cv6_sql(IN.format(4)),
        "cv_sep": cv6_sql(IN.format(9))
    }
    inner = f"c AS (SELECT scenario, {CODE_SQL} AS code, " + ", ".join(f"{r(x, 6)} AS {k}" for k, x in parts.items()) + " FROM obs WHERE entity BETWEEN 1 AND 4 GROUP BY scenario, entity)"
    outer = ", ".join(f"max(CASE WHEN code = '{code}' THEN {k} END) AS \"{name}\"" for code in CODES for k, name in families.metric_names(code).items())
    return f"WITH {OBS}, {inner} SELECT scenario, {outer} FROM c GROUP BY scenario"


@query("d24_metrics_wide", _wide_sql())
def d24(spark, sf):
    rows = obs(spark, sf).where("entity between 1 and 4").withColumn("entity", F.element_at(F.array(*map(F.lit, CODES)), F.col("entity").cast("int")))
    return families.metrics_wide(rows, list(CODES))


@query(
    "d25_risk_labels",
    f"{PERIOD} SELECT {E_}, CASE WHEN flood_pool_prob_all IS NULL THEN 'not calculated' WHEN flood_pool_prob_all < 0.01 THEN 'very low' WHEN "
    "flood_pool_prob_all < 0.05 THEN 'low' WHEN flood_pool_prob_all < 0.10 THEN 'moderate' ELSE 'elevated' END AS flood_risk, "
    "CASE WHEN dead_pool_prob_all IS NULL THEN 'not calculated' WHEN dead_pool_prob_all < 0.001 THEN 'very low' WHEN dead_pool_prob_all < 0.01 "
    "THEN 'low' WHEN dead_pool_prob_all < 0.05 THEN 'moderate' ELSE 'elevated' END AS drought_risk, "
    "CASE WHEN storage_cv_all IS NULL THEN 'not calculated' WHEN storage_cv_all < 0.15 THEN 'low' WHEN storage_cv_all < 0.30 THEN 'moderate' ELSE 'high' END AS variability FROM ps",
)
def d25(spark, sf):
    return families.risk_labels(families.reservoir_period_summary(obs(spark, sf), reservoirs(spark, sf))).select(*ENTITY, "flood_risk", "drought_risk", "variability")


@query(
    "d26_processing_counts",
    "WITH m AS (SELECT s_suppkey AS entity, 'c' || s_nationkey % 4 AS category, 1 AS rank FROM supplier UNION ALL SELECT s_suppkey, 'zone', 0 FROM supplier WHERE s_suppkey % 9 = 0), "
    "f AS (SELECT entity, arg_min(category, rank) AS category FROM m GROUP BY entity), b AS (SELECT l_suppkey AS entity, bool_or(l_quantity > "
    "49) AS d, bool_or(l_tax > 0.07 AND l_discount > 0.09) AS s FROM lineitem WHERE l_suppkey % 11 <> 0 GROUP BY 1) "
    "SELECT category, count(*) AS units, count(d) AS processed, count(*) FILTER (WHERE d) AS with_delivery, count(*) FILTER (WHERE s) AS "
    "with_shortage FROM f LEFT JOIN b USING (entity) GROUP BY category",
)
def d26(spark, sf):
    s = table(spark, sf, "supplier")
    mapping = s.select(
        F.col("s_suppkey").alias("entity"), F.concat(F.lit("c"), (F.col("s_nationkey") % 4).cast("string")).alias("category"), F.lit(1).alias("rank")
    ).unionByName(s.where("s_suppkey % 9 = 0").select(F.col("s_suppkey").alias("entity"), F.lit("zone").alias("category"), F.lit(0).alias("rank")))
    results = table(spark, sf, "lineitem").where("l_suppkey % 11 <> 0").select(
        F.col("l_suppkey").alias("entity"), (F.col("l_quantity") > 49).alias("has_delivery"),
        ((F.col("l_tax") > 0.07) & (F.col("l_discount") > 0.09)).alias("has_shortage")
    )
    return families.processing_counts(mapping, results)


def delivery_sql(src: str = "obs") -> str:
    return (
        f"dm AS (SELECT scenario, entity, water_month, {r('avg(delivery)')} AS delivery_avg_taf, {cv_sql('delivery')} AS delivery_cv, "
        f"{q_sql('delivery')}, count(delivery) AS sample_count FROM {src} WHERE delivery IS NOT NULL {GM}), "
        f"dd AS (SELECT scenario, entity, water_month, {r('avg(demand)')} AS demand_avg_taf FROM {src} {GM}), dx AS (SELECT dm.*, "
        f"demand_avg_taf, {r(MET)} AS percent_of_demand_avg FROM dm JOIN dd USING (scenario, entity, water_month))"
    )


def period_sql(src: str, floor: str, mode: str, met: str) -> str:
    return (
        "yearly AS (SELECT scenario, entity, water_year, coalesce(sum(delivery), 0.0) AS delivery, coalesce(sum(shortage), 0.0) AS shortage, "
        f"coalesce(sum(demand), 0.0) AS demand FROM {src} {GE}, water_year), "
        f"up AS (SELECT {E_}, {annual_sql('delivery', 'delivery')}, {short_sql(floor)}, {r('avg(demand)')} AS annual_demand_avg_taf, {met} AS avg_pct_demand_met FROM yearly {GE}), "
        f"span AS (SELECT scenario, {SPAN} FROM {src} GROUP BY scenario), ux AS (SELECT up.*, {RELIABLE[mode]} AS reliability_pct, "
        "simulation_start_year, simulation_end_year, total_years FROM up JOIN span USING (scenario))"
    )


MONTHS = f"* REPLACE ({big('water_month')} AS water_month)"
GAPS = (
    "gaps AS (SELECT * REPLACE (CASE WHEN entity % 13 <> 0 THEN delivery END AS delivery, CASE WHEN entity % 13 <> 0 THEN demand END AS demand) "
    "FROM obs), good AS (SELECT * FROM gaps WHERE (scenario, entity) IN (SELECT (scenario, entity) FROM gaps GROUP BY scenario, entity HAVING "
    "count(delivery) > 0 OR count(demand) > 0))"
)
PROJECTS = (
    "tot AS (SELECT scenario, 'P' || entity % 6 AS entity, ts, calendar_month, water_month, water_year, sum(delivery) AS delivery, sum(shortage) AS "
    "shortage, sum(demand) AS demand FROM obs GROUP BY ALL)"
)


def _gaps(spark, sf):
    rows = obs(spark, sf)
    return rows.withColumns({c: F.when(F.col("entity") % 13 != 0, F.col(c)) for c in ("delivery", "demand")})


def _projects(spark, sf):
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("entity"), F.concat(F.lit("P"), (F.col("s_suppkey") % 6).cast("string")).alias("project"))


_FAMILY = {
    "d27_contractor": (lambda spark, sf: families.contractor_stats(obs(spark, sf)), f"WITH {OBS}", "obs", "0.1::DOUBLE", "ratio", OF_MEANS),
    "d28_project": (
        lambda spark, sf: families.project_aggregates(obs(spark, sf), _projects(spark, sf)), f"WITH {OBS}, {PROJECTS}", "tot", "0.1::DOUBLE", "ratio",
        OF_MEANS
    ),
    "d29_urban_unit": (lambda spark, sf: families.urban_unit_stats(_gaps(spark, sf)), f"WITH {OBS}, {GAPS}", "good", "0.0", "frequency", OF_YEARS),
}
for _name, (_make, _with, _src, _floor, _mode, _met) in _FAMILY.items():
    query(f"{_name}_delivery", f"{_with}, {delivery_sql(_src)} SELECT {MONTHS} FROM dx")(lambda spark, sf, make=_make: make(spark, sf)[0])
    query(f"{_name}_shortage", f"{_with} SELECT {M_}, {SHORT_M} FROM {_src} WHERE shortage IS NOT NULL {GM}")(lambda spark, sf, make=_make: make(spark, sf)[1])
    query(f"{_name}_period", f"{_with}, {period_sql(_src, _floor, _mode, _met)} SELECT * FROM ux")(lambda spark, sf, make=_make: make(spark, sf)[2])


@query(
    "d30_farm_unit_monthly",
    f"WITH {OBS}, {PUMPED} SELECT {M_}, " + ", ".join(f"{r(f'avg({v})')} AS {v}_avg, CASE WHEN count({v}) > 0 THEN {cv_sql(v)} END AS {v}_cv" for v in ("demand", "delivery", "pumping")) + f" FROM pumped {GM}"
)
def d30_monthly(spark, sf):
    return families.farm_unit_stats(obs(spark, sf))[0]


@query("d30_farm_unit_shortage", f"WITH {OBS} SELECT {M_}, {SHORT_M}, {SHORT_PCT} AS shortage_pct_of_demand FROM obs WHERE shortage IS NOT NULL {GM}")
def d30_shortage(spark, sf):
    return families.farm_unit_stats(obs(spark, sf))[1]


@query("d30_farm_unit_period", FARM)
def d30_period(spark, sf):
    return families.farm_unit_stats(obs(spark, sf))[2]


# B: calendar, units, identifiers


@query(
    "b1_water_calendar",
    f"WITH {OBS} SELECT ts, {', '.join(f'{big(c)} AS {c}' for c in ('calendar_month', 'calendar_year', 'days_in_month', 'water_month', 'water_year'))}, count(*) AS n FROM obs GROUP BY ALL"
)
def b1(spark, sf):
    return obs(spark, sf).groupBy("ts", "calendar_month", "calendar_year", "days_in_month", "water_month", "water_year").count().withColumnRenamed("count", "n")


@query(
    "b2_model_dates",
    "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 3 THEN make_date(year(o_orderdate), 9, 30) WHEN o_orderkey % 4 = 2 AND o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS ts, "
    "CAST(CASE WHEN o_orderkey % 4 = 3 THEN 0 WHEN o_orderkey % 4 = 2 AND o_orderkey % 10 = 0 THEN NULL ELSE (month(o_orderdate) + 2) % 12 + 1 END AS BIGINT) AS water_month, "
    "CAST(CASE WHEN o_orderkey % 4 = 3 THEN 365 WHEN o_orderkey % 4 = 2 AND o_orderkey % 10 = 0 THEN NULL ELSE day(last_day(o_orderdate)) END AS BIGINT) AS days_in_month FROM orders",
)
def b2(spark, sf):
    d, kind = F.col("o_orderdate"), F.col("o_orderkey") % 4
    text = F.when(kind == 0, F.date_format(d, "yyyy-MM-dd HH:mm:ss")).when(kind == 1, F.concat(F.upper(F.date_format(d, "ddMMMyyyy")), F.lit(" 2400"))).when(
        kind == 2, F.when(F.col("o_orderkey") % 10 == 0, "no date").otherwise(F.date_format(d, "yyyy-MM-dd"))
    ).otherwise(F.date_format(d, "yyyy"))
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), text.alias("text"), F.concat(F.lit("f"), kind.cast("string")).alias("file"))
    return calendar.with_model_calendar(rows, "text", "file").select("k", "ts", "water_month", "days_in_month")


@query(
    "b3_cfs_to_taf",
    f"WITH {OBS} SELECT scenario, entity, {big('water_month')} AS water_month, "
    f"{r('sum(CASE WHEN entity % 2 = 0 THEN delivery * days_in_month * 0.001983471 ELSE delivery END)', 4)} AS taf FROM obs {GM}"
)
def b3(spark, sf):
    rows = obs(spark, sf).withColumn("taf", scalars.cfs_to_taf(F.col("delivery"), F.col("days_in_month"), F.when(F.col("entity") % 2 == 0, "cfs").otherwise("TAF")))
    return rows.groupBy(*MONTH).agg(scalars.rounded(F.sum("taf"), 4).alias("taf"))


@query("b4_spill_volume", f"WITH {OBS} SELECT scenario, entity, {r('sum(spill * 0.0603)', 4)} AS volume FROM obs {GE}")
def b4(spark, sf):
    return obs(spark, sf).groupBy(*ENTITY).agg(scalars.rounded(F.sum(scalars.spill_volume_taf(F.col("spill"))), 4).alias("volume"))


@query("b5_pct_of_capacity", f"{OBS_RES} SELECT scenario, entity, {r('avg(storage * 100 / capacity_taf)', 4)} AS pct FROM held {GE}")
def b5(spark, sf):
    return stats.with_capacity(obs(spark, sf), reservoirs(spark, sf)).groupBy(*ENTITY).agg(scalars.rounded(
        F.avg(scalars.pct_of_capacity(F.col("storage"), F.col("capacity_taf"))), 4
    ).alias("pct"))


@query(
    "b6_to_number",
    "SELECT l_returnflag AS scenario, count(*) AS n, count(v) AS numbers, CAST(sum(v) AS BIGINT) AS total FROM (SELECT l_returnflag, CASE WHEN "
    "l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_quantity END AS v FROM lineitem) GROUP BY 1"
)
def b6(spark, sf):
    text = F.when(F.col("l_orderkey") % 7 == 0, "NaN").when(F.col("l_orderkey") % 5 == 0, "n/a").otherwise(F.col("l_quantity").cast("string"))
    return table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("scenario"), scalars.to_number(text).alias("v")).groupBy("scenario").agg(
        F.count("*").alias("n"), F.count("v").alias("numbers"), F.sum("v").cast("long").alias("total")
    )


@query(
    "b7_clip",
    f"WITH {OBS} SELECT scenario, {r('sum(CASE WHEN delivery IS NOT NULL THEN least(greatest(delivery, 10.0), 40.0) END)', 4)} AS clipped, count(delivery) AS n FROM obs GROUP BY scenario"
)
def b7(spark, sf):
    return obs(spark, sf).groupBy("scenario").agg(scalars.rounded(F.sum(scalars.clip(F.col("delivery"), 10, 40)), 4).alias("clipped"), F.count("delivery").alias("n"))


@query("b8_ratio_or", f"WITH {OBS} SELECT scenario, entity, {r('sum(CASE WHEN spill > 0 THEN demand / spill ELSE -1.0 END)', 4)} AS ratio FROM obs {GE}")
def b8(spark, sf):
    return obs(spark, sf).groupBy(*ENTITY).agg(scalars.rounded(F.sum(scalars.ratio_or(F.col("demand"), F.col("spill"), -1.0)), 4).alias("ratio"))


@query(
    "b9_wba_id_to_map_id",
    "SELECT p_partkey AS k, CASE WHEN p_partkey % 10 = 0 THEN 'DETAW' ELSE CASE WHEN p_size < 10 THEN '0' ELSE '' END || CAST(p_size AS "
    "VARCHAR) || CASE WHEN p_partkey % 3 = 0 THEN 'N' ELSE '' END END AS map_id FROM part"
)
def b9(spark, sf):
    zone = F.when(F.col("p_partkey") % 10 == 0, "DETAW").otherwise(F.concat(
        F.lit("WBA"), F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 3 == 0, "N").otherwise("")
    ))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("k"), scalars.wba_id_to_map_id(zone).alias("map_id"))


@query("b10_strip_variable_prefix", "SELECT p_partkey AS k, upper(replace(p_name, ' ', '_')) AS code, p_partkey % 3 <> 2 AS prefixed FROM part")
def b10(spark, sf):
    code = F.concat(
        F.element_at(F.array(F.lit("S_"), F.lit("C_"), F.lit("")), (F.col("p_partkey") % 3 + 1).cast("int")),
        F.upper(F.replace("p_name", F.lit(" "), F.lit("_")))
    )
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("k"), code.alias("c"))
    return rows.select(
        "k",
        F.when(scalars.has_variable_prefix(F.col("c")) & (F.col("k") % 3 == 2), F.col("c")).otherwise(scalars.strip_variable_prefix(F.col("c"))).alias("code"),
        (scalars.has_variable_prefix(F.col("c")) & (F.col("k") % 3 != 2)).alias("prefixed")
    )


@query(
    "b11_wkt_point",
    (
        "SELECT s_suppkey AS k, CASE WHEN s_suppkey % 8 <> 0 THEN -125.5 + s_suppkey % 10 END AS lon, CASE WHEN s_suppkey % 8 <> 0 THEN 32.25 + "
        "s_suppkey % 9 END AS lat FROM supplier"
    ).replace("-125.5 +", "-125.5::DOUBLE +").replace("32.25 +", "32.25::DOUBLE +")
)
def b11(spark, sf):
    wkt = F.when(F.col("s_suppkey") % 8 == 0, "LINESTRING (1 2, 3 4)").otherwise(F.concat(
        F.lit("POINT ("), (F.col("s_suppkey") % 10 - 125.5).cast("string"), F.lit(" "), (F.col("s_suppkey") % 9 + 32.25).cast("string"), F.lit(")")
    ))
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), scalars.point_longitude(wkt).alias("lon"), scalars.point_latitude(wkt).alias("lat"))
