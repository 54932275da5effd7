"""Choosing and combining variables: mappings, sums, fallbacks, overlays and filters.

A series table has (scenario, variable, ts, value); a missing value is null. Mapping tables are dimensions: Spark
broadcasts them by their size, no hint is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import clip
from tidemark.sources.shared import written

NOT_FOUND = "NOT_FOUND"


#: Mappings of up to so many rows are sent to all tasks, 8 MB of ids.
SENT_ROWS = 1_000_000


def map_entity_series(series: DataFrame, mapping: DataFrame, role: str) -> DataFrame:
    """Rows (scenario, entity, ts, value) of each entity's variable for a role (a column of ``mapping``).

    Mappings that are inactive, null or NOT_FOUND give nothing.

    A variable may have many entities, and then the result is many times as large as the series. So the points of mapped
    variables are dealt out evenly first, however few the files and variables are, in as many parts as shuffles have: by
    ranges, for which the series is read twice, so that a part has few variables and files stay small. Each point meets
    its variable's entities in one array, and all that is left to do for an entity is to unfold it. Mappings of more than
    ``SENT_ROWS`` rows are joined row by row.
    """
    own = mapping.where(F.col("is_active") & F.col(role).isNotNull() & (F.col(role) != NOT_FOUND)).select("entity", F.col(role).alias("variable"))
    if own.count() > SENT_ROWS:
        return series.join(own, "variable").select("scenario", "entity", "ts", "value")
    parts = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = series.join(F.broadcast(own.select("variable").distinct()), "variable", "left_semi").repartitionByRange(parts, "variable", "ts", "scenario")
    arrays = own.groupBy("variable").agg(F.collect_list(F.struct("entity")).alias("_entities"))  # structs, as null ids stay
    return named.join(F.broadcast(arrays), "variable").select("scenario", F.inline("_entities"), "ts", "value")


def sum_arcs(series: DataFrame, arcs: DataFrame, strict: bool = False) -> DataFrame:
    """Sum of each entity's variables (entity, variable) by time.

    Lenient: a missing value counts 0 and an absent variable is ignored. Strict: any that lacks makes the sum missing.
    """
    counted = arcs.join(arcs.groupBy("entity").agg(F.count("*").alias("_arcs")), "entity") if strict else arcs.withColumn("_arcs", F.lit(0))
    out = series.join(counted, "variable").groupBy("scenario", "entity", "ts").agg(
        F.sum("value").alias("_sum"), F.count("value").alias("_n"), F.max("_arcs").alias("_arcs")
    )
    value = F.when(F.col("_n") == F.col("_arcs"), F.col("_sum")) if strict else F.coalesce("_sum", F.lit(0.0))
    return out.select("scenario", "entity", "ts", value.alias("value"))


#: Pattern of zone ids.
ZONE = r"^(\d+[NS]?)_(PU|NU|SU)\d*$"


def resolve_variable(entities: DataFrame, available: DataFrame, special: DataFrame) -> DataFrame:
    """Entity to variable by ranked naming rules over the available variables; null where none fits.

    ``special`` (entity, variable) wins, also with a null, which means none.
    """
    e = F.col("entity")
    zone, groundwater = e.rlike(ZONE), F.contains(e, F.lit("_NU"))
    named = F.contains(e, F.lit("_")) | F.endswith(e, F.lit("3"))
    # The naming rules, in order of rank.
    rules: list[tuple[Column, Column]] = [
        (zone | named, F.concat(F.lit("DN_"), e)),
        (zone & groundwater, F.concat(F.lit("GP_"), e)),
        (F.lit(True), F.concat(F.lit("D_"), e, F.lit("_NU"))),
        (F.lit(True), F.concat(F.lit("D_"), e)),
        (F.lit(True), F.concat(F.lit("DN_"), e)),
        (groundwater, F.concat(F.lit("GP_"), e)),
    ]
    ranked = F.array_compact(F.array(*(F.when(guard, F.struct(F.lit(i).alias("rank"), name.alias("variable"))) for i, (guard, name) in enumerate(rules))))
    chosen = special.withColumn("_special", F.lit(True)).withColumnRenamed("variable", "_given")
    rows = entities.select("entity").join(chosen, "entity", "left")
    tries = F.when(F.col("_special"), F.array(F.struct(F.lit(0).alias("rank"), F.col("_given").alias("variable")))).otherwise(ranked)
    tried = rows.select("entity", F.explode(tries).alias("t")).select("entity", "t.rank", "t.variable")
    best = tried.join(available.select("variable").distinct(), "variable", "left_semi").groupBy("entity").agg(F.min_by("variable", "rank").alias("variable"))
    return entities.select("entity").join(best, "entity", "left")


def overlay_sources(main: DataFrame, override: DataFrame) -> DataFrame:
    """Main series with the override's variables in place of its own, gaps included; these are in TAF.

    Both have (scenario, variable, ts, value, unit). Values are matched by variable and date, not by position.
    """
    replaced = override.select("scenario", "variable").distinct()
    return main.join(replaced, ["scenario", "variable"], "left_anti").unionByName(override.withColumn("unit", F.lit("TAF")))


def discover_entities(variables: DataFrame, prefix: str, excluded: Sequence[str] = (), zones: DataFrame | None = None) -> DataFrame:
    """Entities out of variable names with a prefix and none of the suffixes; an unknown zone is the text before ``_``."""
    rest = F.substring("variable", len(prefix) + 1, 1_000_000)
    rows = variables.where(F.startswith("variable", F.lit(prefix)))
    for suffix in excluded:
        rows = rows.where(~F.endswith("variable", F.lit(suffix)))
    rows = rows.select(rest.alias("entity")).distinct()
    own = F.split("entity", "_")[0]
    return rows.withColumn("zone", own) if zones is None else rows.join(zones, "entity", "left").withColumn("zone", F.coalesce("zone", own))


def groundwater_pumping(rows: DataFrame) -> DataFrame:
    """Adds gw_pumping and is_calculated to rows with demand, delivery and pumping.

    Given pumping stands; else it is demand less delivery. Neither is under 0, and without demand it is missing.
    """
    calculated = F.col("demand") - F.coalesce("delivery", F.lit(0.0))
    return rows.withColumns({"gw_pumping": clip(F.coalesce("pumping", calculated), 0), "is_calculated": F.col("pumping").isNull()})


def exclude_regions(df: DataFrame, zones: Sequence[str], column: str = "zone") -> DataFrame:
    """Rows outside the listed zones; a null zone stays."""
    return df.where(~F.coalesce(F.col(column).isin(*zones), F.lit(False)))


ROLES = ("delivery", "shortage", "allocation")


def back_calculate_demand(series: DataFrame, terms: DataFrame) -> DataFrame:
    """Demand of each district: the sum over its terms of (delivery + shortage) / (allocation / 100), and the share met.

    ``terms`` has (district, delivery_variable, shortage_variable, allocation_variable). A term without an allocation
    over 0 gives no demand. Rows are those of the delivery variables; repeated points of a variable are summed.

    Each variable is told its terms and roles by one map, so the series is read once and only the named variables are
    shuffled, once, by (district, scenario, time); the roles of a term meet in that aggregation. The map is written to
    the shared folder first, so that the planner knows its size and sends it to all tasks where it is small.
    """
    numbered = terms.select("district", *(f"{role}_variable" for role in ROLES)).withColumn("_term", F.struct(*(f"{role}_variable" for role in ROLES)))
    each = F.explode(F.array(*(F.struct(F.col(f"{role}_variable").alias("variable"), F.lit(role).alias("_role")) for role in ROLES))).alias("_e")
    roles = numbered.groupBy("district", "_term", *(f"{role}_variable" for role in ROLES)).agg(F.count("*").alias("_times")).select("district", "_term", "_times", each)
    roles = roles.select("district", "_term", "_times", "_e.variable", "_e._role")
    points = series.select("scenario", "ts", "variable", "value").join(written(roles.where("variable is not null"), "roles"), "variable")
    place = ["district", "scenario", "ts"]  # both aggregations below find their groups together
    one = points.repartition(*place).groupBy(*place, "_term").agg(
        F.max("_times").alias("_times"), F.max(F.col("_role") == "delivery").alias("_there"),
        *(F.sum(F.when(F.col("_role") == role, F.col("value"))).alias(role) for role in ROLES)
    )
    need = F.when(F.col("allocation") > 0, F.try_divide(F.coalesce("delivery", F.lit(0.0)) + F.coalesce("shortage", F.lit(0.0)), F.col("allocation") / 100))
    out = one.where("_there").groupBy(*place).agg(F.sum(need * F.col("_times")).alias("demand"), F.sum(F.col("delivery") * F.col("_times")).alias("delivery"))
    return out.withColumn("pct_of_demand", F.when(F.col("demand") > 0, F.try_divide(F.col("delivery") * 100, F.col("demand"))))


def resolve_threshold(rows: DataFrame, thresholds: DataFrame, series: DataFrame, kind: str) -> DataFrame:
    """Adds a threshold by time: the entity's variable where the scenario has it, else a constant.

    ``thresholds`` has (entity, variable, constant). Dead pool falls back to the entity's ``dead_pool_taf`` where that
    is over 0; flood has no further fallback.
    """
    name = {"flood": "flood_threshold", "dead": "dead_threshold"}[kind]
    own = thresholds.where(F.col("variable").isNotNull()).join(series, "variable").select("scenario", "entity", "ts", F.col("value").alias("_value"))
    out = rows.join(own, ["scenario", "entity", "ts"], "left").join(thresholds.select("entity", "constant"), "entity", "left")
    last = F.when(F.col("dead_pool_taf") > 0, F.col("dead_pool_taf")) if kind == "dead" else F.lit(None).cast("double")
    return out.withColumn(name, F.coalesce("_value", "constant", last)).drop("_value", "constant")


def filter_stats(stats: DataFrame, members: DataFrame, ids: Sequence | None = None, group: str | None = None, default_group: str | None = None) -> DataFrame:
    """Rows of the given ids, or of a group's members (group, entity); both at once is an error.

    Without either the default group holds, and without that all rows.
    """
    if ids is not None and group is not None:
        raise ValueError("give ids or a group, not both")
    if ids is not None:
        return stats.where(F.col("entity").isin(*ids))
    group = group or default_group
    return stats if group is None else stats.join(members.where(F.col("group") == group).select("entity"), "entity", "left_semi")


def filter_farm_units(entities: DataFrame, region: str | None = None, kind: str | None = None, provider: str | None = None) -> DataFrame:
    """Units by region and type, without case, where ``""`` fits a null or blank; provider by a part of its text."""
    out = entities
    for column, want in (("region", region), ("cs3_type", kind)):
        if want is not None:
            blank = F.col(column).isNull() | (F.trim(F.col(column)) == "")
            out = out.where(blank if want == "" else F.upper(F.col(column)) == want.upper())
    return out if provider is None else out.where(F.contains(F.lower("provider"), F.lit(provider.lower())))


def search_elements(nodes: DataFrame, arcs: DataFrame, text: str, limit: int) -> DataFrame:
    """Nodes and arcs whose code, name or description holds the text, without case; each up to half the limit."""

    def found(df: DataFrame, tag: str) -> DataFrame:
        low = F.lit(text.lower())
        hit = F.contains(F.lower("short_code"), low) | F.contains(F.lower("name"), low) | F.contains(F.lower("description"), low)
        return df.where(hit).select(F.lit(tag).alias("element"), "id", "short_code", "name", "description").orderBy("short_code", "id").limit(limit // 2)

    return found(nodes, "node").unionByName(found(arcs, "arc"))


def active_or_all(df: DataFrame) -> DataFrame:
    """Active rows, or all where none is; display_name is the first of short_title, name and short_code."""
    any_active = df.agg(F.count_if("is_active").alias("_n"))
    out = df.join(F.broadcast(any_active), F.col("is_active") | (F.col("_n") == 0)).drop("_n")
    return out.withColumn("display_name", F.coalesce("short_title", "name", "short_code"))


def number_members(variables: DataFrame, pattern: str, per: str = "group") -> DataFrame:
    """Members by name pattern, numbered in id order within each group."""
    return variables.where(F.col("name").rlike(pattern)).withColumn("display_order", F.row_number().over(Window.partitionBy(per).orderBy("id")))
