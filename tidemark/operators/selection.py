"""Exact quantiles of groups of any size, by selection: no task holds a group, however large it is.

``percentile`` keeps the distinct values of a group in one buffer, which suits a century of months. Here values are
counted first, then sorted by range over (group, value); the rows before each stretch give every value its ranks, and the
wanted ranks are picked out. The result is that of ``percentile``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.shared import written


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, levels: Sequence[float], into: str = "quantiles") -> DataFrame:
    """Rows (keys, ``into``, sample_count): the quantiles at ``levels`` (0 to 1), linear between neighbouring values.

    Nulls are left out, and groups without a value give no row; null keys are a group. NaN is the largest value, as in
    ``percentile``. Without keys all rows are one group. Equal values count once in the sort, so a value that fills a
    third of the rows is one row there.
    """
    if bad := [p for p in levels if not 0 <= p <= 1]:
        raise ValueError(f"levels must lie from 0 to 1, not {bad}")
    group = [f"_k{i}" for i in range(len(keys))]
    rows = df.where(F.col(value).isNotNull()).select(*(F.col(k).alias(g) for k, g in zip(keys, group, strict=True)), F.col(value).cast("double").alias("_v"))
    rows = rows.withColumn("_v", F.when(F.col("_v") == 0, F.lit(0.0)).otherwise(F.col("_v")))  # -0.0 is 0.0
    counted = rows.groupBy(*group, "_v").agg(F.count("*").alias("_n"))
    ranged = counted.repartitionByRange(*group, "_v").withColumn("_part", F.spark_partition_id())
    ranged = written(ranged, "counted")
    # a stretch is what one partition has of a group
    stretch = ranged.groupBy(*group, "_part").agg(F.sum("_n").alias("_rows"))
    own = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))
    earlier = own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    stretch = stretch.select(
        *(F.col(g).alias(f"{g}_") for g in group), F.col("_part").alias("_part_"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"), F.sum("_rows").over(own).alias("_total")
    )
    same = F.col("_part") == F.col("_part_")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"{g}_"))
    inside = Window.partitionBy("_part", *group).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranged.withColumn("_here", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(stretch, same).withColumn("_first", F.col("_here") + F.col("_before"))
    holds = lambda rank: (rank >= F.col("_first")) & (rank < F.col("_first") + F.col("_n"))
    place = [(F.col("_total") - 1) * F.lit(float(p)) for p in levels]
    picks = [
        F.max(F.when(holds(end(at).cast("long")), F.col("_v"))).alias(f"_{name}{i}") for i, at in enumerate(place) for name,
        end in (("low", F.floor), ("high", F.ceil))
    ]
    found = ranked.groupBy(*group).agg(F.max("_total").alias("_total"), *picks)

    def between(i: int):
        low, high, at = F.col(f"_low{i}"), F.col(f"_high{i}"), place[i]
        return F.when(low == high, low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high)

    out = found.where("_total is not null").select(
        *(F.col(g).alias(k) for g, k in zip(group, keys, strict=True)), F.array(*(between(i) for i in range(len(levels)))).alias(into),
        F.col("_total").alias("sample_count")
    )
    return out
