"""Tiers: from matrices of levels to shares, scores and comparisons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import rounded, wba_id_to_map_id
from tidemark.sources.shared import row_numbers

TIERS = (1, 2, 3, 4)


def cleaned(names: list[str]) -> dict[str, str]:
    return {n: " ".join(n.split()) for n in names}


def melted(matrix: DataFrame, id_column: str, names: str) -> DataFrame:
    """Rows (id, names, level) of a matrix; levels that are no whole number are left out."""
    clean = cleaned(matrix.columns)
    df = matrix.toDF(*clean.values())
    values = [c for c in df.columns if c != id_column]
    out = df.select(F.col(id_column), *(F.col(f"`{c}`").cast("string").alias(c) for c in values)).unpivot([id_column], values, names, "level")
    return out.withColumn("level", F.col("level").try_cast("double").cast("int")).where("level is not null")


def unpivot_tiers(matrix: DataFrame, indicator: str, allowed: DataFrame | None = None) -> DataFrame:
    """Scenario by location matrix to rows (scenario, indicator, location, level); only allowed scenarios."""
    out = melted(matrix, "scenario", "location").withColumn("indicator", F.lit(indicator))
    out = out if allowed is None else out.join(allowed.select("scenario"), "scenario", "left_semi")
    return out.select("scenario", "indicator", "location", "level")


def unpivot_station_matrix(matrix: DataFrame, indicator: str) -> DataFrame:
    """Station by scenario matrix; of columns like ``s0042(1)`` and ``s0042(2)`` the first wins."""
    columns = [c for c in cleaned(matrix.columns).values() if c != "station"]
    out = melted(matrix, "station", "column")
    place = F.array_position(F.array(*map(F.lit, columns)), F.col("column"))
    base = F.regexp_replace("column", r"\s*\(\d+\)$", "")
    best = out.groupBy("station", base.alias("scenario")).agg(F.min_by("level", place).alias("level"))
    return best.select("scenario", F.lit(indicator).alias("indicator"), F.col("station").alias("location"), "level")


def long_tiers(df: DataFrame, indicator: str) -> DataFrame:
    """Rows that are long already, (scenario, region, tier)."""
    return df.where("tier is not null").select(
        "scenario", F.lit(indicator).alias("indicator"), F.col("region").alias("location"), F.col("tier").cast("int").alias("level")
    )


def groundwater_levels(df: DataFrame, names: DataFrame) -> DataFrame:
    """Levels of zones: 0 counts as 1; the zone's map id and display name."""
    own = df.withColumns({"location": wba_id_to_map_id(F.col("zone")), "level": F.when(F.col("level") == 0, 1).otherwise(F.col("level"))})
    return own.join(names.select("location", "display_name"), "location", "left").withColumn("display_name", F.coalesce("display_name", "location"))


def display_order(df: DataFrame, position: str, per: str | None = "scenario") -> DataFrame:
    """Numbers rows in input order, by scenario or over the whole table."""
    if per is None:
        return row_numbers(df, [position], "display_order")
    return df.withColumn("display_order", F.row_number().over(Window.partitionBy(per).orderBy(position)))


def tier_counts(df: DataFrame, denominator: int | None = None, digits: int = 4) -> DataFrame:
    """Locations at each level and their shares, of the non-missing locations or of a given number."""
    out = df.groupBy("scenario", "indicator").agg(*(F.count_if(F.col("level") == t).alias(f"tier_{t}_value") for t in TIERS), F.count("level").alias("total_value"))
    out = out if denominator is None else out.withColumn("total_value", F.lit(denominator).cast("long"))
    return out.select(
        "scenario", "indicator", *(f"tier_{t}_value" for t in TIERS),
        *(rounded(F.try_divide(F.col(f"tier_{t}_value").cast("double"), F.col("total_value")), digits).alias(f"norm_tier_{t}") for t in TIERS),
        "total_value"
    )


def tier_scores(results: DataFrame) -> DataFrame:
    """Adds weighted (1 to 4), normalised (0 to 1), gini and the band of levels present; all null where shares sum to 0."""
    n = [F.coalesce(F.col(f"norm_tier_{t}"), F.lit(0.0)) for t in TIERS]
    total = reduce(Column.__add__, n)
    mean = reduce(Column.__add__, [s * t for s, t in zip(n, TIERS, strict=True)])
    spread = reduce(Column.__add__, [n[i] * n[j] * abs(i - j) for i in range(4) for j in range(4)])
    there = total > 0
    best, worst = F.coalesce(*(F.when(s > 0, t) for s, t in zip(n, TIERS, strict=True))), F.coalesce(*(
        F.when(s > 0, t) for s, t in reversed(list(zip(n, TIERS, strict=True)))
    ))
    out = results.withColumn("weighted_score", F.when(there, rounded(F.try_divide(mean, total), 3)))
    height = lambda level: F.when(there, rounded((4.0 - level) / 3.0, 3))
    return out.withColumns({
        "normalized_score": height(F.col("weighted_score")), "gini": F.when(there, rounded(F.try_divide(spread, mean * 2), 3)),
        "band_upper": height(best), "band_lower": height(worst)
    })


def single_tier_scores(results: DataFrame) -> DataFrame:
    """Scores of single-value indicators out of their level; no level gives 0."""
    level = F.coalesce(F.col("single_tier_level"), F.lit(0))
    normal = F.when(level > 0, rounded((4.0 - level) / 3.0, 3)).otherwise(F.lit(0.0))
    return results.withColumns({"weighted_score": level.cast("double"), "normalized_score": normal, "gini": F.lit(0.0), "band_upper": normal, "band_lower": normal})


def compare_scenarios(scores: DataFrame, a: str, b: str) -> DataFrame:
    """Scores of two scenarios side by side; a side that lacks, or a normalised score of 0, is null."""
    own = lambda s, c: F.max(F.when(F.col("scenario") == s, F.nullif(F.col(c), F.lit(0.0))))
    return scores.where(F.col("scenario").isin(a, b)).groupBy("indicator").agg(*(
        own(s, c).alias(f"{c}_{n}") for n, s in (("a", a), ("b", b)) for c in ("weighted_score", "normalized_score", "gini")
    ))


def indicator_averages(scores: DataFrame) -> DataFrame:
    """Mean, least and most weighted score of each indicator, best first."""
    w = F.col("weighted_score")
    return scores.groupBy("indicator").agg(
        rounded(F.avg(w), 4).alias("avg_score"), F.min(w).alias("min_score"), F.max(w).alias("max_score"), F.count(w).alias("scenarios")
    ).orderBy("avg_score", "indicator")


def tier_availability(results: DataFrame) -> DataFrame:
    """Indicators of each scenario, sorted, and their number."""
    return results.groupBy("scenario").agg(F.array_sort(F.collect_set("indicator")).alias("indicators"), F.countDistinct("indicator").alias("indicator_count"))


def tier_location_summary(locations: DataFrame, definitions: DataFrame, scenario: str) -> DataFrame:
    """Active indicators of a scenario with their locations and the number of levels in use."""
    rows = locations.where(F.col("scenario") == scenario).join(definitions.where("is_active"), "indicator")
    return rows.groupBy("indicator", "name").agg(F.count("*").alias("location_count"), F.countDistinct("level").alias("levels_used"))


def scenario_location_counts(locations: DataFrame) -> DataFrame:
    """Indicators and locations of each scenario."""
    return locations.groupBy("scenario").agg(F.countDistinct("indicator").alias("tier_count"), F.countDistinct("location").alias("location_count"))


def tier_locations(locations: DataFrame, definitions: DataFrame) -> DataFrame:
    """Per scenario and indicator the ordered list of locations and the number at each level."""
    rows = locations.join(definitions.select("indicator", "name"), "indicator")
    return rows.groupBy("scenario", "indicator", "name").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("display_order", "location", "level"))),
            lambda s: F.struct(s["location"].alias("location"), s["level"].alias("level"))
        ).alias("locations"),
        *(F.count_if(F.col("level") == t).alias(f"tier_{t}_count") for t in TIERS)
    )


def tier_features(locations: DataFrame, geometries: DataFrame, aliases: DataFrame) -> DataFrame:
    """Locations with their geometry and a JSON object of properties; without a geometry they are left out.

    ``geometries`` is (location_type, geometry_id, geometry); ``aliases`` (location, geometry_id) sends several locations
    to one geometry.
    """
    rows = locations.join(aliases, "location", "left").withColumn("geometry_id", F.coalesce("geometry_id", "location"))
    return rows.join(geometries, ["location_type", "geometry_id"]).select(
        "scenario", "indicator", "location", "geometry",
        F.to_json(F.struct("location", "location_type", F.col("level").alias("tier_level"))).alias("properties")
    )


def reconcile_tiers(locations: DataFrame, results: DataFrame) -> DataFrame:
    """Counts out of the locations next to the stored ones, with a flag where they differ."""
    own = locations.groupBy("scenario", "indicator").agg(*(F.count_if(F.col("level") == t).alias(f"found_{t}") for t in TIERS))
    out = own.join(results.select("scenario", "indicator", *(f"tier_{t}_value" for t in TIERS)), ["scenario", "indicator"], "left")
    return out.withColumn("matches", reduce(Column.__and__, [F.col(f"found_{t}").eqNullSafe(F.col(f"tier_{t}_value")) for t in TIERS]))


def tier_type_summary(results: DataFrame, definitions: DataFrame) -> DataFrame:
    """Per tier type the results, and those with counts and with a single level."""
    return results.join(definitions.select("indicator", "tier_type"), "indicator").groupBy("tier_type").agg(
        F.count("*").alias("results"), F.count("tier_1_value").alias("multi_value"), F.count("single_tier_level").alias("single_value")
    )
