"""Nested and joined results for serving. Monthly rows of an entity are few, so collecting them in a map is bounded."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import map_of
from tidemark.operators.stats import ENTITY, EXCEEDANCES, QUANTILES


def served(columns: Sequence[str]) -> list:
    """Statistics as served: quantiles null as 0, exceedances 0 as null."""
    q, exc = {f"q{p}" for p in QUANTILES}, {f"exc_p{p}" for p in EXCEEDANCES}
    return [(F.coalesce(F.col(c), F.lit(0.0)) if c in q else F.nullif(F.col(c), F.lit(0.0)) if c in exc else F.col(c)).alias(c) for c in columns]


def nest_monthly(stats: DataFrame, entities: DataFrame, values: Sequence[str]) -> DataFrame:
    """Per scenario and entity a map from water month to its statistics, with the entity's attributes.

    Where a month repeats, the row that sorts last stays.
    """
    entry = F.struct(F.col("water_month").cast("int").alias("key"), F.struct(*served(values)).alias("value"))
    out = stats.groupBy(*ENTITY).agg(map_of(F.collect_list(entry)).alias("monthly"))
    return out.join(entities, "entity", "left")


def group_members(groups: DataFrame, members: DataFrame, entities: DataFrame) -> DataFrame:
    """Groups with their active members in display order, and how many those are (0 for none)."""
    named = members.where("is_active").join(entities, "entity")
    own = named.groupBy("group_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("display_order", "entity", "name"))), lambda s: s["name"]).alias("members"),
        F.count("*").alias("member_count")
    )
    out = groups.join(own, "group_id", "left")
    return out.withColumns({"members": F.coalesce("members", F.array().cast("array<string>")), "member_count": F.coalesce("member_count", F.lit(0).cast("long"))})


def scenario_entities(stats: DataFrame) -> DataFrame:
    """Entities of each scenario, sorted, and their number."""
    return stats.groupBy("scenario").agg(F.array_sort(F.collect_set("entity")).alias("entities"), F.countDistinct("entity").alias("entity_count"))


KINDS = ("storage", "urban", "farm")


def scenario_bundle(scenarios: Sequence[str], tables: dict[str, tuple[DataFrame, Sequence[str]]], kinds: Sequence[str]) -> DataFrame:
    """Nested monthly statistics of many scenarios: one scan for each kind. An unknown kind is an error.

    ``tables`` gives for each kind its monthly table and the columns to serve.
    """
    unknown = [k for k in kinds if k not in tables]
    if unknown:
        raise ValueError(f"unknown kinds: {', '.join(unknown)}")

    def one(kind: str) -> DataFrame:
        df, values = tables[kind]
        rows = df.where(F.col("scenario").isin(*scenarios))
        entry = F.struct(F.col("water_month").cast("int").alias("key"), F.to_json(F.struct(*served(values))).alias("value"))
        return rows.groupBy(*ENTITY).agg(map_of(F.collect_list(entry)).alias("monthly")).select(
            "scenario", F.lit(kind).alias("kind"), F.col("entity").cast("string").alias("entity"), "monthly"
        )

    return reduce(DataFrame.unionByName, [one(k) for k in kinds])


def scenario_detail(scenarios: DataFrame, climates: DataFrame, links: dict[str, DataFrame]) -> DataFrame:
    """Scenarios with their climate and, for each link table (scenario, name), a sorted array of names."""
    out = scenarios.join(climates, "climate_id", "left")
    for column, link in links.items():
        own = link.groupBy("scenario").agg(F.array_sort(F.collect_set("name")).alias(column))
        out = out.join(own, "scenario", "left").withColumn(column, F.coalesce(column, F.array().cast("array<string>")))
    return out


def units_by_group(groups: DataFrame, members: DataFrame, entities: DataFrame, variables: DataFrame) -> DataFrame:
    """Units of active variable groups, with project and display name, in display order."""
    rows = groups.where(F.col("is_active") & F.startswith("group_code", F.lit("var_"))).join(
        members.where("is_active").withColumnRenamed("display_order", "unit_order").drop("is_active"), "group_id"
    ).join(entities, "entity", "left").join(variables, "entity", "left")
    project = F.when(F.col("group_code") == "var_swp_contractor", "SWP").when(F.col("group_code") == "var_gw_only", "GW").when(F.col("region").isin("SAC", "SJR"), "CVP")
    named = F.when(
        F.coalesce(F.col("agency"), F.lit("")) != "", F.concat(F.col("entity").cast("string"), F.lit(" - "), F.substring("agency", 1, 50))
    ).otherwise(F.col("entity").cast("string"))
    return rows.withColumns({"project": project, "display_name": named}).select(
        "group_code", "display_order", "unit_order", "entity", "display_name", "project", "variable"
    )


def single_unit_record(entity: DataFrame, period: DataFrame, delivery: DataFrame, shortage: DataFrame, values: Sequence[str]) -> DataFrame:
    """Everything on a unit in one nested row for each scenario; a part that lacks is empty."""
    def nested(df: DataFrame, name: str) -> DataFrame:
        own = [c for c in values if c in df.columns]
        entry = F.struct(F.col("water_month").cast("int").alias("key"), F.to_json(F.struct(*served(own))).alias("value"))
        return df.groupBy(*ENTITY).agg(map_of(F.collect_list(entry)).alias(name))

    out = entity.join(period, "entity", "left")
    for name, df in (("delivery", delivery), ("shortage", shortage)):
        out = out.join(nested(df, name), list(ENTITY), "left").withColumn(name, F.coalesce(name, F.create_map().cast("map<int,string>")))
    return out


def stats_with_entity(stats: DataFrame, entities: DataFrame, order: Sequence[str]) -> DataFrame:
    """Statistics next to entity attributes, in the given order."""
    return stats.join(entities, "entity", "left").orderBy(*order)


def mapping_with_groups(variables: DataFrame, entities: DataFrame, members: DataFrame, group: str | None = None) -> DataFrame:
    """Variable map with entity attributes and the ordered array of its groups, or only those of one group."""
    own = members.groupBy("entity").agg(F.transform(F.array_sort(F.collect_list(F.struct("display_order", "group"))), lambda s: s["group"]).alias("groups"))
    out = variables.join(entities, "entity", "left").join(own, "entity", "left").withColumn("groups", F.coalesce("groups", F.array().cast("array<string>")))
    return out if group is None else out.join(members.where(F.col("group") == group).select("entity"), "entity", "left_semi")


def current_version_rows(table: DataFrame, name: str, families: DataFrame, versions: DataFrame) -> DataFrame:
    """Rows of the active version of the table's family; a table without a family, or without versions, passes whole.

    ``families`` is (table, family), ``versions`` (version_id, family, is_active).
    """
    if "version_id" not in table.columns:
        return table
    active = families.where(F.col("table") == name).join(versions.where("is_active"), "family").select("version_id")
    known = families.where(F.col("table") == name).agg(F.count("*").alias("_n"))
    kept = table.join(active, "version_id", "left_semi")
    return kept.unionByName(table.join(F.broadcast(known), F.col("_n") == 0).drop("_n"))
