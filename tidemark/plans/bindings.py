"""Projections of the given tables to the schemas that operators take, in Spark and in SQL.

The tables have no gaps in the columns used, so gaps are made where keys divide by a fixed number, alike on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.calendar import with_water_calendar
from tidemark.plans.registry import table

#: Thresholds on the observations' scale.
FLOOD, DEAD = 40000.0, 5000.0


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations by scenario (return flag) and entity (supplier), with all roles and the calendar."""
    rows = table(spark, sf_dir, "lineitem")
    gap = lambda c, n: F.when(F.col("l_orderkey") % n != 0, c)
    out = rows.select(
        F.col("l_returnflag").alias("scenario"),
        F.col("l_suppkey").alias("entity"),
        F.col("l_shipdate").cast("date").alias("ts"),
        F.col("l_extendedprice").alias("storage"),
        gap(F.col("l_quantity"), 71).alias("delivery"),
        F.when(F.col("l_discount") >= 0.08, F.col("l_quantity")).otherwise(0.0).alias("spill"),
        gap(F.col("l_quantity") * F.col("l_tax"), 53).alias("shortage"),
        (F.col("l_quantity") * (F.col("l_discount") + 1)).alias("demand"),
        F.when((F.col("l_suppkey") % 5 == 0), F.col("l_quantity") * 0.5).alias("pumping"),
        F.when(F.col("l_suppkey") % 7 != 0, F.lit(FLOOD)).alias("flood_threshold"),
        F.lit(DEAD).alias("dead_threshold"),
    )
    return with_water_calendar(out)


def reservoirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reservoirs with a capacity that may be negative, which leaves them out."""
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("entity"), (F.col("s_acctbal") * 20).alias("capacity_taf"), F.lit(DEAD).alias("dead_pool_taf"))


OBS = """obs AS (
  SELECT l_returnflag AS scenario, l_suppkey AS entity, CAST(l_shipdate AS DATE) AS ts, l_extendedprice AS storage,
    CASE WHEN l_orderkey % 71 <> 0 THEN l_quantity END AS delivery,
    CASE WHEN l_discount >= 0.08 THEN l_quantity ELSE 0.0 END AS spill,
    CASE WHEN l_orderkey % 53 <> 0 THEN l_quantity * l_tax END AS shortage,
    l_quantity * (l_discount + 1) AS demand,
    CASE WHEN l_suppkey % 5 = 0 THEN l_quantity * 0.5 END AS pumping,
    CASE WHEN l_suppkey % 7 <> 0 THEN 40000.0::DOUBLE END AS flood_threshold, 5000.0::DOUBLE AS dead_threshold,
    month(l_shipdate) AS calendar_month, year(l_shipdate) AS calendar_year, day(last_day(l_shipdate)) AS days_in_month,
    (month(l_shipdate) + 2) % 12 + 1 AS water_month,
    year(l_shipdate) + CASE WHEN month(l_shipdate) >= 10 THEN 1 ELSE 0 END AS water_year
  FROM lineitem)"""
RES = "res AS (SELECT s_suppkey AS entity, s_acctbal * 20 AS capacity_taf FROM supplier WHERE s_acctbal * 20 > 0)"
OBS_RES = f"WITH {OBS}, {RES}, held AS (SELECT o.*, r.capacity_taf FROM obs o JOIN res r ON o.entity = r.entity)"
