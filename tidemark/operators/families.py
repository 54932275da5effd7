"""Compositions: period summaries of reservoirs and farms, units, contractors and project totals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import SHORTAGE_FLOOR, clip, ratio_or, rounded
from tidemark.operators import stats
from tidemark.operators.stats import ENTITY, MONTH

#: Reservoirs whose metric names have no underscore before the unit.
IRREGULAR = ("SLUIS_CVP", "SLUIS_SWP")


def joined(parts: list[DataFrame], keys: tuple[str, ...] = ENTITY) -> DataFrame:
    """Parts side by side by key; all are grouped by it already, so no further shuffle is due."""
    return reduce(lambda a, b: a.join(b, list(keys), "left"), parts)


def reservoir_period_summary(series: DataFrame, reservoirs: DataFrame) -> DataFrame:
    """One row for each scenario and reservoir: years, exceedances, spill, probabilities, variability, averages.

    Two aggregations serve all columns, one by entity and one by year; both end up partitioned by entity for the join.
    """
    rows = stats.with_capacity(series, reservoirs)
    both = {"all": None, "september": [9], "april": [4]}
    single = rows.groupBy(*ENTITY).agg(
        *(rounded(stats.share_of(stats.flood_hit(), m), 6).alias(f"flood_pool_prob_{n}") for n, m in both.items()),
        *(rounded(stats.share_of(stats.dead_hit(), both[n]), 6).alias(f"dead_pool_prob_{n}") for n in ("all", "september")),
        *(stats.cv_of(m).alias(f"storage_cv_{n}") for n, m in both.items()),
        rounded(F.avg(stats.in_months([4]))).alias("april_avg_taf"),
        rounded(F.avg(stats.in_months([9]))).alias("september_avg_taf"),
        F.max("capacity_taf").alias("capacity_taf"),
        F.percentile("storage", stats.LEVELS).alias("_q"),
    ).select("*", *stats.capacity_exceedances()).drop("_q")
    out = joined([single, stats.spill_summary(stats.spill_years(rows))])
    return out.join(stats.period_span(series), "scenario", "left")


def raw(value: str) -> list[Column]:
    """Mean, deviation and percentiles of a yearly total, under names of its own."""
    v = F.col(value)
    return [F.avg(v).alias(f"_{value}_avg"), F.stddev_samp(v).alias(f"_{value}_std"), F.percentile(v, stats.LEVELS).alias(f"_{value}_q")]


def mean_of(value: str) -> Column:
    return rounded(F.col(f"_{value}_avg"))


def variation_of(value: str) -> Column:
    return stats.variation(F.col(f"_{value}_avg"), F.col(f"_{value}_std"))


def passed(value: str, prefix: str) -> list[Column]:
    return [rounded(stats.level(F.col(f"_{value}_q"), (100 - p) / 100)).alias(f"{prefix}_exc_p{p}") for p in stats.EXCEEDANCES]


def with_pumping(rows: DataFrame) -> DataFrame:
    """Pumping as given, else demand less delivery and not under 0."""
    return rows.withColumn("pumping", F.coalesce("pumping", clip(F.col("demand") - F.coalesce("delivery", F.lit(0.0)), 0)))


def farm_period_summary(series: DataFrame) -> DataFrame:
    """Yearly demand, delivery and pumping of each unit, shortage (null without any data) and reliability.

    One aggregation by year and one over the years serve all columns.
    """
    rows = with_pumping(series)
    values = ["demand", "delivery", "pumping", "shortage"]
    annual = rows.groupBy(*stats.YEAR).agg(*(F.coalesce(F.sum(v), F.lit(0.0)).alias(v) for v in values), F.count("shortage").alias("_seen"))
    short = F.col("shortage") > SHORTAGE_FLOOR
    out = annual.groupBy(*ENTITY).agg(
        *raw("demand"), *raw("delivery"), *raw("pumping"), F.avg("shortage").alias("_s_avg"), F.count_if(short).alias("_s_years"),
        F.count("*").alias("_years"), F.sum("_seen").alias("_seen"), F.avg(ratio_or(F.col("shortage") * 100, F.col("demand"), 0.0)).alias("_s_pct")
    )
    there = lambda c: F.when(F.col("_seen") > 0, c)
    out = out.select(
        *ENTITY, mean_of("demand").alias("annual_demand_avg_taf"), variation_of("demand").alias("annual_demand_cv"), *passed("demand", "demand"),
        mean_of("delivery").alias("annual_sw_delivery_avg_taf"), variation_of("delivery").alias("annual_sw_delivery_cv"), mean_of("pumping").alias("annual_gw_pumping_avg_taf"), variation_of("pumping").alias("annual_gw_pumping_cv"),
        there(rounded(F.col("_s_avg"))).alias("annual_shortage_avg_taf"), there(F.col("_s_years")).alias("shortage_years_count"), there(rounded(F.col("_s_years") * 100.0 / F.col("_years"))).alias("shortage_frequency_pct"), there(rounded(F.col("_s_pct"))).alias("annual_shortage_pct_of_demand"),
    )
    out = out.withColumn("gw_pumping_pct_of_demand", rounded(ratio_or(F.col("annual_gw_pumping_avg_taf") * 100, F.col("annual_demand_avg_taf"), 0.0)))
    out = out.withColumn("annual_delivery_avg_taf", F.col("annual_sw_delivery_avg_taf"))
    return stats.reliability(out, "demand").drop("annual_delivery_avg_taf").join(stats.period_span(series), "scenario", "left")


def metric_names(code: str) -> dict[str, str]:
    """Names of a reservoir's metrics by kind."""
    gap = "" if code in IRREGULAR else "_"
    return {
        "flood_all": f"All_Prob_S_{code}_flood", "flood_sep": f"Sep_Prob_S_{code}_flood", "dead_all": f"All_Prob_S_{code}_dead",
        "dead_sep": f"Sep_Prob_S_{code}_dead", "avg_apr": f"Apr_Avg_S_{code}{gap}TAF", "avg_sep": f"Sep_Avg_S_{code}{gap}TAF",
        "cv_apr": f"Apr_S_{code}{gap}CV", "cv_sep": f"Sep_S_{code}{gap}CV"
    }


def metric_rows(series: DataFrame) -> DataFrame:
    """Rows (scenario, metric, value) of all reservoirs; metrics without a threshold are left out."""
    code = F.col("entity").cast("string")
    gap = F.when(code.isin(*IRREGULAR), "").otherwise("_")
    values = series.groupBy(*ENTITY).agg(
        F.count("flood_threshold").alias("_f"), F.count("dead_threshold").alias("_d"),
        *(stats.share_of(stats.flood_hit(), m).alias(f"flood_{n}") for n, m in (("all", None), ("sep", [9]))),
        *(stats.share_of(stats.dead_hit(), m).alias(f"dead_{n}") for n, m in (("all", None), ("sep", [9]))),
        *(F.avg(stats.in_months([m])).alias(f"avg_{n}") for n, m in (("apr", 4), ("sep", 9))),
        *(stats.cv_of([m]).alias(f"cv_{n}") for n, m in (("apr", 4), ("sep", 9))),
    )
    names = {"flood_all": ("All_Prob_S_", "_flood"), "flood_sep": ("Sep_Prob_S_", "_flood"), "dead_all": ("All_Prob_S_", "_dead"), "dead_sep": ("Sep_Prob_S_", "_dead")}
    items = [
        F.struct(F.concat(F.lit(a), code, F.lit(b)).alias("metric"), F.when(F.col("_f" if k.startswith("flood") else "_d") > 0, F.col(k)).alias("value")) for k,
        (a, b) in names.items()
    ]
    items += [
        F.struct(F.concat(F.lit(a), code, gap, F.lit(u)).alias("metric"), F.col(k).alias("value")) for k, a,
        u in (("avg_apr", "Apr_Avg_S_", "TAF"), ("avg_sep", "Sep_Avg_S_", "TAF"), ("cv_apr", "Apr_S_", "CV"), ("cv_sep", "Sep_S_", "CV"))
    ]
    return values.select("scenario", F.explode(F.array(*items)).alias("m")).select(
        "scenario", "m.metric", rounded(F.col("m.value"), 6).alias("value")
    ).where("value is not null")


def metrics_wide(series: DataFrame, codes: list[str]) -> DataFrame:
    """One row for each scenario, one column for each metric of the given reservoirs."""
    wanted = [name for code in codes for name in metric_names(code).values()]
    rows = metric_rows(series.where(F.col("entity").cast("string").isin(*codes)))
    return rows.groupBy("scenario").pivot("metric", wanted).agg(F.first("value"))


def risk_labels(summary: DataFrame) -> DataFrame:
    """Adds flood_risk, drought_risk and variability classes."""
    def graded(value: str, cuts: list[tuple[float, str]], last: str):
        out = F.lit(last)
        for cut, name in reversed(cuts):
            out = F.when(F.col(value) < cut, name).otherwise(out)
        return F.when(F.col(value).isNull(), "not calculated").otherwise(out)

    return summary.withColumns({
        "flood_risk": graded("flood_pool_prob_all", [(0.01, "very low"), (0.05, "low"), (0.10, "moderate")], "elevated"),
        "drought_risk": graded("dead_pool_prob_all", [(0.001, "very low"), (0.01, "low"), (0.05, "moderate")], "elevated"),
        "variability": graded("storage_cv_all", [(0.15, "low"), (0.30, "moderate")], "high"),
    })


def processing_counts(mapping: DataFrame, results: DataFrame) -> DataFrame:
    """For each mapping category: units, processed, with delivery, with shortage.

    ``mapping`` is (entity, category, rank); a unit counts in its category of lowest rank. ``results`` is (entity,
    has_delivery, has_shortage).
    """
    first = mapping.groupBy("entity").agg(F.min_by("category", F.struct("rank", "category")).alias("category"))
    by = results.groupBy("entity").agg(F.bool_or("has_delivery").alias("d"), F.bool_or("has_shortage").alias("s"))
    out = first.join(by, "entity", "left")
    return out.groupBy("category").agg(
        F.count("*").alias("units"), F.count("d").alias("processed"), F.count_if(F.col("d")).alias("with_delivery"),
        F.count_if(F.col("s")).alias("with_shortage")
    )


def delivery_monthly(rows: DataFrame) -> DataFrame:
    """Monthly delivery with demand and the share of demand that was met, in one aggregation."""
    out = rows.groupBy(*MONTH).agg(*stats.raw_stats(F.col("delivery")), F.avg("demand").alias("_demand")).where("sample_count > 0")
    out = out.select(
        *MONTH, rounded(F.col("_avg")).alias("delivery_avg_taf"), stats.variation(F.col("_avg"), F.col("_std")).alias("delivery_cv"), *stats.bands(),
        "sample_count", rounded(F.col("_demand")).alias("demand_avg_taf")
    )
    return out.withColumn("percent_of_demand_avg", rounded(clip(ratio_or(F.col("delivery_avg_taf") * 100, F.col("demand_avg_taf"), None), 0, 100)))


def unit_period(rows: DataFrame, shortage_floor: float = SHORTAGE_FLOOR, reliability_mode: str = "frequency", demand_mode: str = "mean_of_years") -> DataFrame:
    """Yearly delivery, shortage, demand and reliability of each unit, with the scenario's years.

    One aggregation by year and one over the years serve all columns.
    """
    annual = stats.annual_totals(rows, ["delivery", "shortage", "demand"])
    met = {
        "of_means": ratio_or(F.avg("delivery") * 100, F.avg("demand"), None),
        "mean_of_years": F.avg(clip(ratio_or(F.col("delivery") * 100, F.col("demand"), None), 0, 100))
    }[demand_mode]
    out = annual.groupBy(*ENTITY).agg(
        *raw("delivery"), *raw("shortage"), F.avg("demand").alias("_demand"),
        F.count_if(F.col("shortage") > shortage_floor).alias("shortage_years_count"), F.count("*").alias("_years"), met.alias("_met")
    )
    out = out.select(
        *ENTITY, mean_of("delivery").alias("annual_delivery_avg_taf"), variation_of("delivery").alias("annual_delivery_cv"), rounded(stats.level(F.col("_delivery_q"), 0.0)).alias("annual_delivery_min_taf"), rounded(stats.level(F.col("_delivery_q"), 1.0)).alias("annual_delivery_max_taf"), *passed("delivery", "delivery"),
        mean_of("shortage").alias("annual_shortage_avg_taf"), "shortage_years_count", rounded(F.col("shortage_years_count") * 100.0 / F.col("_years")).alias("shortage_frequency_pct"), *passed("shortage", "shortage"),
        rounded(F.col("_demand")).alias("annual_demand_avg_taf"), rounded(clip(F.col("_met"), 0, 100)).alias("avg_pct_demand_met"),
    )
    return stats.reliability(out, reliability_mode).join(stats.period_span(rows), "scenario", "left")


def usable(rows: DataFrame) -> DataFrame:
    """Leaves out units whose delivery and demand are wholly missing in a scenario."""
    have = rows.groupBy(*ENTITY).agg(F.count("delivery").alias("d"), F.count("demand").alias("w")).where("d > 0 or w > 0").select(*ENTITY)
    return rows.join(have, list(ENTITY), "left_semi")


def urban_unit_stats(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Monthly delivery, monthly shortage and period summary; a year is short where its total is over 0."""
    rows = usable(rows)
    return delivery_monthly(rows), stats.shortage_monthly(rows), unit_period(rows, 0.0, "frequency", "mean_of_years")


def contractor_stats(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The same for contractors on summed variables in their own units; reliability is the ratio of rounded means."""
    return delivery_monthly(rows), stats.shortage_monthly(rows), unit_period(rows, SHORTAGE_FLOOR, "ratio", "of_means")


def project_aggregates(rows: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The same for project totals: ``members`` maps an entity to its project (entity, project)."""
    total = rows.join(members, "entity").groupBy(
        "scenario", F.col("project").alias("entity"), "ts", *[c for c in ("calendar_month", "water_month", "water_year") if c in rows.columns]
    ).agg(*(F.sum(c).alias(c) for c in ("delivery", "shortage", "demand")))
    return contractor_stats(total)


def farm_unit_stats(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Monthly demand, delivery and pumping side by side, monthly shortage with its share of demand, period summary."""
    rows = with_pumping(rows)
    names = ("demand", "delivery", "pumping")
    monthly = rows.groupBy(*MONTH).agg(*(c for v in names for c in (
        F.avg(v).alias(f"_{v}_avg"), F.stddev_samp(v).alias(f"_{v}_std"), F.count(v).alias(f"_{v}_n")
    ))).where("_demand_n > 0")
    monthly = monthly.select(*MONTH, *(c for v in names for c in (mean_of(v).alias(f"{v}_avg"), F.when(F.col(f"_{v}_n") > 0, variation_of(v)).alias(f"{v}_cv"))))
    short = stats.shortage_monthly(rows).join(stats.shortage_pct_of_demand(rows), list(MONTH), "left")
    return monthly, short, farm_period_summary(rows)
