"""Monthly and period-of-record statistics by scenario and entity.

Input rows are (scenario, entity, ts) with one column for each role (storage, delivery, shortage, demand, spill …).
Every statistic of a group comes from one aggregation; percentiles are exact, all in one call. Months without data give
no row. Rounding is the last step, but for ratios that are defined on rounded means.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import with_water_calendar
from tidemark.functions.scalars import SHORTAGE_FLOOR, clip, pct_of_capacity, ratio_or, rounded, spill_volume_taf

#: Fixed values.
QUANTILES = (0, 10, 30, 50, 70, 90, 100)
EXCEEDANCES = (5, 10, 25, 50, 75, 90, 95)
FLOOD_HAIR = 1e-6

ENTITY = ("scenario", "entity")
MONTH = (*ENTITY, "water_month")
YEAR = (*ENTITY, "water_year")
LEVELS = sorted({p / 100 for p in QUANTILES} | {(100 - p) / 100 for p in EXCEEDANCES})


def level(values: Column, share: float) -> Column:
    return F.element_at(values, LEVELS.index(share) + 1)


def variation(mean: Column, deviation: Column) -> Column:
    """Deviation over mean, 4 decimals; 0 where the mean is not positive; null for one sample."""
    return F.when(mean > 0, rounded(F.try_divide(deviation, mean), 4)).otherwise(F.lit(0.0))


def raw_stats(v: Column) -> list[Column]:
    return [F.avg(v).alias("_avg"), F.stddev_samp(v).alias("_std"), F.count(v).alias("sample_count"), F.percentile(v, LEVELS).alias("_q")]


def bands(scale: Column | float = 1.0, suffix: str = "", quantiles: Sequence[int] = QUANTILES, exceedances: Sequence[int] = EXCEEDANCES) -> list[Column]:
    """q… and exc_p… columns; an exceedance is the value passed that share of the time."""
    s = scale if isinstance(scale, Column) else F.lit(float(scale))
    return [rounded(level(F.col("_q"), p / 100) * s).alias(f"q{p}{suffix}") for p in quantiles] + [rounded(level(F.col("_q"), (100 - p) / 100) * s).alias(f"exc_p{p}{suffix}") for p in exceedances]


def distribution_stats(df: DataFrame, keys: Sequence[str], value: str, prefix: str = "") -> DataFrame:
    """Mean, cv, count, quantiles and exceedances of a value by group; groups without a value give no row."""
    out = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(*raw_stats(F.col(value)))
    return out.select(*keys, rounded(F.col("_avg")).alias(f"{prefix}avg"), variation(F.col("_avg"), F.col("_std")).alias(f"{prefix}cv"), *bands(), "sample_count")


def with_capacity(series: DataFrame, reservoirs: DataFrame) -> DataFrame:
    """Rows of reservoirs with a positive capacity, with capacity_taf (and dead_pool_taf where given)."""
    extra = [c for c in ("dead_pool_taf",) if c in reservoirs.columns]
    return series.join(reservoirs.where("capacity_taf > 0").select("entity", "capacity_taf", *extra), "entity")


def storage_monthly(series: DataFrame, reservoirs: DataFrame, month: str = "water_month") -> DataFrame:
    """Storage by month: mean, cv and bands in TAF and in percent of capacity."""
    keys = [*ENTITY, month]
    rows = with_capacity(series, reservoirs).where("storage is not null")
    out = rows.groupBy(*keys, "capacity_taf").agg(*raw_stats(F.col("storage")))
    to_pct = F.lit(100.0) / F.col("capacity_taf")
    return out.select(
        *keys, rounded(F.col("_avg")).alias("storage_avg_taf"), variation(F.col("_avg"), F.col("_std")).alias("storage_cv"),
        rounded(F.col("_avg") * to_pct).alias("storage_pct_capacity"), *bands(to_pct), *bands(1.0, "_taf"), "capacity_taf", "sample_count"
    )


def percentile_bands(series: DataFrame, reservoirs: DataFrame, fill_empty: bool = False, month: str = "water_month") -> DataFrame:
    """Quantiles and mean by month in both units; ``fill_empty`` adds zeros for months without data."""
    keys = [*ENTITY, month]
    rows = with_capacity(series, reservoirs)
    out = rows.where("storage is not null").groupBy(*keys, "capacity_taf").agg(*raw_stats(F.col("storage")))
    to_pct = F.lit(100.0) / F.col("capacity_taf")
    out = out.select(
        *keys, *bands(to_pct, "", exceedances=()), rounded(F.col("_avg") * to_pct).alias("mean"), *bands(1.0, "_taf", exceedances=()),
        rounded(F.col("_avg")).alias("mean_taf")
    )
    if not fill_empty:
        return out
    grid = rows.select(*ENTITY).distinct().withColumn(month, F.explode(F.sequence(F.lit(1), F.lit(12))))
    return grid.join(out, keys, "left").fillna(0.0)


def calendar_month_percentiles(series: DataFrame, reservoirs: DataFrame) -> DataFrame:
    return percentile_bands(series, reservoirs, month="calendar_month")


def spill_monthly(series: DataFrame, reservoirs: DataFrame) -> DataFrame:
    """Spill by month; statistics of spill are over months that spill, 0 where none does."""
    spills = F.col("spill") > 0
    own = F.when(spills, F.col("spill"))
    rows = with_capacity(series, reservoirs).where("spill is not null")
    out = rows.groupBy(*MONTH).agg(
        F.count_if(spills).alias("spill_months_count"), F.count("*").alias("total_months"), F.avg(own).alias("_avg"), F.max(own).alias("_max"),
        F.percentile(own, [0.5, 0.9, 1.0]).alias("_q"), F.avg(F.when(spills, pct_of_capacity(F.col("storage"), F.col("capacity_taf")))).alias("_at")
    )
    zero = lambda c: F.coalesce(rounded(c), F.lit(0.0))
    return out.select(
        *MONTH, "spill_months_count", "total_months",
        rounded(F.col("spill_months_count") * 100.0 / F.col("total_months")).alias("spill_frequency_pct"), zero(F.col("_avg")).alias("spill_avg_cfs"),
        zero(F.col("_max")).alias("spill_max_cfs"), *(zero(F.get("_q", F.lit(i))).alias(f"spill_q{p}") for i, p in enumerate((50, 90, 100))),
        rounded(F.col("_at")).alias("storage_at_spill_avg_pct")
    )


def shortage_monthly(df: DataFrame, floor: float = SHORTAGE_FLOOR) -> DataFrame:
    """Distribution of shortage and the share of values over the floor."""
    out = df.where("shortage is not null").groupBy(*MONTH).agg(*raw_stats(F.col("shortage")), F.count_if(F.col("shortage") > floor).alias("_over"))
    return out.select(
        *MONTH, rounded(F.col("_avg")).alias("shortage_avg_taf"), variation(F.col("_avg"), F.col("_std")).alias("shortage_cv"),
        rounded(F.col("_over") * 100.0 / F.col("sample_count")).alias("shortage_frequency_pct"), *bands(), "sample_count"
    )


def shortage_pct_of_demand(df: DataFrame) -> DataFrame:
    """Mean over rows with both of 100 shortage / demand; a row counts 0 where the demand is not positive."""
    return df.where("shortage is not null and demand is not null").groupBy(*MONTH).agg(rounded(F.avg(ratio_or(F.col("shortage") * 100, F.col("demand"), 0.0))).alias("shortage_pct_of_demand"))


def monthly_demand_met(df: DataFrame) -> DataFrame:
    """Rounded monthly means of delivery and demand, and their ratio in percent, 0 to 100; null without demand."""
    out = df.groupBy(*MONTH).agg(rounded(F.avg("delivery")).alias("delivery_avg_taf"), rounded(F.avg("demand")).alias("demand_avg_taf"))
    return out.where("delivery_avg_taf is not null").withColumn(
        "percent_of_demand_avg", rounded(clip(ratio_or(F.col("delivery_avg_taf") * 100, F.col("demand_avg_taf"), None), 0, 100))
    )


def annual_totals(df: DataFrame, values: Sequence[str]) -> DataFrame:
    """Sums by water year; a year whose values are all missing is 0."""
    return df.groupBy(*YEAR).agg(*(F.coalesce(F.sum(v), F.lit(0.0)).alias(v) for v in values))


def period_span(df: DataFrame) -> DataFrame:
    """First, last and number of water years of each scenario, over all its rows."""
    return df.groupBy("scenario").agg(
        F.min("water_year").alias("simulation_start_year"), F.max("water_year").alias("simulation_end_year"),
        F.countDistinct("water_year").alias("total_years")
    )


def annual_summary(annual: DataFrame, value: str, prefix: str) -> DataFrame:
    """Mean, cv, least, most and exceedances of yearly totals."""
    out = annual.groupBy(*ENTITY).agg(*raw_stats(F.col(value)))
    return out.select(
        *ENTITY, rounded(F.col("_avg")).alias(f"annual_{prefix}_avg_taf"), variation(F.col("_avg"), F.col("_std")).alias(f"annual_{prefix}_cv"),
        rounded(level(F.col("_q"), 0.0)).alias(f"annual_{prefix}_min_taf"), rounded(level(F.col("_q"), 1.0)).alias(f"annual_{prefix}_max_taf"),
        *(rounded(level(F.col("_q"), (100 - p) / 100)).alias(f"{prefix}_exc_p{p}") for p in EXCEEDANCES)
    )


def annual_shortage_summary(annual: DataFrame, threshold: float = SHORTAGE_FLOOR) -> DataFrame:
    """Mean yearly shortage, years over the threshold and their share, exceedances."""
    out = annual.groupBy(*ENTITY).agg(*raw_stats(F.col("shortage")), F.count_if(F.col("shortage") > threshold).alias("shortage_years_count"))
    return out.select(
        *ENTITY, rounded(F.col("_avg")).alias("annual_shortage_avg_taf"), "shortage_years_count",
        rounded(F.col("shortage_years_count") * 100.0 / F.col("sample_count")).alias("shortage_frequency_pct"),
        *(rounded(level(F.col("_q"), (100 - p) / 100)).alias(f"shortage_exc_p{p}") for p in EXCEEDANCES)
    )


def reliability(summary: DataFrame, mode: str) -> DataFrame:
    """Adds reliability_pct to a row per entity.

    ``ratio``: of rounded mean delivery, null where that is 0; ``frequency``: 100 less the shortage frequency;
    ``demand``: of rounded mean demand, 100 where that is 0 or there is no shortage.
    """
    delivery, shortage, demand = F.col("annual_delivery_avg_taf"), F.col("annual_shortage_avg_taf"), F.col("annual_demand_avg_taf")
    if mode == "ratio":
        value = F.when(delivery > 0, rounded((1 - F.try_divide(shortage, delivery)) * 100))
    elif mode == "frequency":
        value = rounded(100 - F.col("shortage_frequency_pct"))
    elif mode == "demand":
        value = F.when((demand > 0) & shortage.isNotNull(), rounded(F.try_divide((demand - shortage) * 100, demand))).otherwise(F.lit(100.0))
    else:
        raise ValueError("mode must be ratio, frequency or demand")
    return summary.withColumn("reliability_pct", value)


def annual_demand_met(annual: DataFrame, mode: str) -> DataFrame:
    """``of_means``: mean delivery of mean demand; ``mean_of_years``: mean of the yearly percentages; both 0 to 100.

    Years count where both totals are there; yearly percentages where demand is positive.
    """
    if mode == "of_means":
        out = annual.groupBy(*ENTITY).agg(F.avg("delivery").alias("_d"), F.avg("demand").alias("_w"))
        return out.select(*ENTITY, rounded(clip(ratio_or(F.col("_d") * 100, F.col("_w"), None), 0, 100)).alias("avg_pct_demand_met"))
    if mode == "mean_of_years":
        return annual.groupBy(*ENTITY).agg(rounded(F.avg(clip(ratio_or(F.col("delivery") * 100, F.col("demand"), None), 0, 100))).alias("avg_pct_demand_met"))
    raise ValueError("mode must be of_means or mean_of_years")


def storage_exceedance(series: DataFrame, reservoirs: DataFrame) -> DataFrame:
    """Exceedances of percent of capacity over all months."""
    rows = with_capacity(series, reservoirs).where("storage is not null")
    return rows.groupBy(*ENTITY, "capacity_taf").agg(F.percentile("storage", LEVELS).alias("_q")).select(*ENTITY, *capacity_exceedances())


def capacity_exceedances() -> list[Column]:
    return [rounded(level(F.col("_q"), (100 - p) / 100) * 100 / F.col("capacity_taf")).alias(f"storage_exc_p{p}") for p in EXCEEDANCES]


def spill_years(rows: DataFrame) -> DataFrame:
    """First level of the period's spill: one row for each water year of rows with capacity; also the mean storage."""
    spills = F.col("spill") > 0
    own = F.when(spills, F.col("spill"))
    return rows.groupBy(*YEAR).agg(
        F.sum(own).alias("_sum"), F.count(own).alias("_n"), F.min(own).alias("_min"), F.max(own).alias("_max"), F.coalesce(F.sum(spill_volume_taf(own)), F.lit(0.0)).alias("_volume"),
        F.sum(F.when(
            spills, pct_of_capacity(F.col("storage"), F.col("capacity_taf"))
        )).alias("_at"), F.count(F.when(spills, F.col("storage"))).alias("_at_n"), F.avg("storage").alias("_mean"),
    )


def spill_summary(years: DataFrame) -> DataFrame:
    """Second level: one row for each entity, with the mean of the yearly mean storage as annual_avg_taf."""
    out = years.groupBy(*ENTITY).agg(
        F.count("_max").alias("spill_years_count"), F.count("*").alias("_years"), F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"), F.min("_min").alias("_min"), F.max("_max").alias("_max"),
        F.avg("_volume").alias("_vavg"), F.stddev_samp("_volume").alias("_vstd"), F.max("_volume").alias("_vmax"), F.percentile("_max", [0.5, 0.9, 1.0]).alias("_q"), F.sum("_at").alias("_at"), F.sum("_at_n").alias("_at_n"), F.avg("_mean").alias("_mean"),
    )
    zero = lambda c: F.coalesce(rounded(c), F.lit(0.0))
    return out.select(
        *ENTITY, "spill_years_count", rounded(F.col("spill_years_count") * 100.0 / F.col("_years")).alias("spill_frequency_pct"), zero(F.try_divide("_sum", "_n")).alias("spill_mean_cfs"), zero(F.col("_max")).alias("spill_peak_cfs"),
        zero(F.col("_vavg")).alias("annual_spill_avg_taf"), F.coalesce(variation(F.col("_vavg"), F.col("_vstd")), F.lit(0.0)).alias("annual_spill_cv"), zero(F.col("_vmax")).alias("annual_spill_max_taf"),
        *(
            zero(F.get("_q", F.lit(i))).alias(f"annual_max_spill_q{p}") for i, p in enumerate((50, 90, 100))
        ), rounded(F.try_divide("_at", "_at_n")).alias("storage_at_spill_avg_pct"), rounded(F.col("_min")).alias("spill_threshold_cfs"), rounded(F.col("_mean")).alias("annual_avg_taf"),
    )


def spill_period(series: DataFrame, reservoirs: DataFrame) -> DataFrame:
    """Spill over the whole period; an entity without a spill series has zeros and a null threshold.

    Years are those of the entity's rows. The threshold is the smallest spill that was found.
    """
    return spill_summary(spill_years(with_capacity(series, reservoirs))).drop("annual_avg_taf")


def share_of(hit: Column, months: Sequence[int] | None) -> Column:
    """Share of rows with storage, in the given calendar months, that hit; 0 where there are none."""
    inside = F.col("storage").isNotNull() if months is None else F.col("storage").isNotNull() & F.col("calendar_month").isin(*months)
    return F.coalesce(F.try_divide(F.count_if(inside & F.coalesce(hit, F.lit(False))).cast("double"), F.count_if(inside)), F.lit(0.0))


def flood_hit() -> Column:
    return F.col("storage") - F.col("flood_threshold") + FLOOD_HAIR >= 0


def dead_hit() -> Column:
    return F.col("storage") <= F.col("dead_threshold")


def flood_probability(series: DataFrame, months: Sequence[int] | None = None) -> DataFrame:
    """Share of months with storage at or over the flood threshold; a missing threshold is no hit but is counted."""
    return series.groupBy(*ENTITY).agg(rounded(share_of(flood_hit(), months), 6).alias("flood_probability"))


def dead_pool_probability(series: DataFrame, months: Sequence[int] | None = None) -> DataFrame:
    """Share of months with storage at or under the dead pool threshold."""
    return series.groupBy(*ENTITY).agg(rounded(share_of(dead_hit(), months), 6).alias("dead_pool_probability"))


def in_months(months: Sequence[int] | None) -> Column:
    return F.col("storage") if months is None else F.when(F.col("calendar_month").isin(*months), F.col("storage"))


def cv_of(months: Sequence[int] | None) -> Column:
    v = in_months(months)
    mean = F.avg(v)
    return F.when((F.count(v) == 0) | (mean == 0), F.lit(0.0)).otherwise(rounded(F.try_divide(F.stddev_samp(v), mean), 6))


def cv(series: DataFrame, months: Sequence[int] | None = None) -> DataFrame:
    """Deviation over mean, with its sign; 0 without data or with a mean of 0."""
    return series.groupBy(*ENTITY).agg(cv_of(months).alias("cv"))


def annual_average(series: DataFrame) -> DataFrame:
    """Mean over water years of the yearly mean."""
    return series.groupBy(*YEAR).agg(F.avg("storage").alias("_y")).groupBy(*ENTITY).agg(rounded(F.avg("_y")).alias("annual_avg_taf"))


def monthly_average(series: DataFrame, month: int) -> DataFrame:
    return series.groupBy(*ENTITY).agg(rounded(F.avg(in_months([month]))).alias("monthly_avg_taf"))


def calendar(df: DataFrame) -> DataFrame:
    return with_water_calendar(df)
