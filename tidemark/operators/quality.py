"""Checks: comparing series and metrics, integrity and completeness of tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import rounded
from tidemark.sources.shared import written

KEY = ("b", "c", "date")


def overlap(ref: DataFrame, test: DataFrame) -> DataFrame:
    """One row: the first and last date that both tables have."""
    of = lambda df, n: df.agg(F.min("date").alias(f"_lo{n}"), F.max("date").alias(f"_hi{n}"))
    return of(ref, 1).crossJoin(of(test, 2)).select(F.greatest("_lo1", "_lo2").alias("first_date"), F.least("_hi1", "_hi2").alias("last_date"))


BLOCK = ("b", "c", "block")


def digests(cells: DataFrame) -> DataFrame:
    """Rows (b, c, block, n, x, y, odd): a digest of each column's cells in a year, whatever their order.

    Blocks with a date twice, and with a value that doesn't equal itself by difference (NaN, infinite), are ``odd``.
    """
    rows = cells.where("b is not null and c is not null and date is not null").withColumn("block", F.year("date"))
    cell = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "date", F.col("value").isNull(), "value"))
    finite = F.col("value").isNull() | (F.abs("value") < float("inf"))
    return rows.groupBy(*BLOCK).agg(
        F.count("*").alias("n"), cell(1).alias("x"), cell(2).alias("y"),
        ((F.size(F.collect_set("date")) < F.count("*")) | F.bool_or(~finite)).alias("odd")
    )


def block_kinds(ref: DataFrame, test: DataFrame) -> DataFrame:
    """Rows (b, c, block, kind) of the blocks that are not surely equal: ``differing``, or ``alone`` on one side.

    Of two sides that agree there is none, so this is as small as their disagreement. Written to the shared folder, so that
    the planner knows its size.
    """
    a, b = digests(ref).withColumn("_r", F.lit(True)), digests(test).select(*BLOCK, *(F.col(c).alias(f"{c}2") for c in ("n", "x", "y", "odd")), F.lit(True).alias("_t"))
    same = (F.col("n") == F.col("n2")) & (F.col("x") == F.col("x2")) & (F.col("y") == F.col("y2")) & ~F.col("odd") & ~F.col("odd2")
    kind = F.when(F.col("_r").isNull() | F.col("_t").isNull(), "alone").when(~same, "differing")
    return written(a.join(b, list(BLOCK), "full").select(*BLOCK, kind.alias("kind")).where("kind is not null"), "blocks")


def compare_series(ref: DataFrame, test: DataFrame, atol: float = 1e-6, rtol: float = 1e-6) -> DataFrame:
    """Cells (b, c, date) that both have, within the overlap: ref_value, file_value, abs_diff, equal.

    Cells are equal if both are missing or differ by at most atol + rtol × the size of the test value. Years of a column
    with the same digest on both sides have the same cells: they are read from one side, and only cells of other years
    are joined.
    """
    span = F.broadcast(overlap(ref, test))
    kinds = block_kinds(ref, test)
    of = lambda df, how, which: df.withColumn("block", F.year("date")).join(which, list(BLOCK), how).drop("block")
    differing = kinds.where("kind = 'differing'")
    joined = of(ref, "left_semi", differing).select(*KEY, F.col("value").alias("ref_value")).join(
        of(test, "left_semi", differing).select(*KEY, F.col("value").alias("file_value")), list(KEY)
    )
    same = of(
        ref.where("b is not null and c is not null and date is not null"), "left_anti", kinds
    ).select(*KEY, F.col("value").alias("ref_value"), F.col("value").alias("file_value"))
    rows = joined.unionByName(same).join(span, F.col("date").between(F.col("first_date"), F.col("last_date")))
    near = F.abs(F.col("ref_value") - F.col("file_value")) <= atol + rtol * F.abs("file_value")
    equal = (F.col("ref_value").isNull() & F.col("file_value").isNull()) | F.coalesce(near, F.lit(False))
    return rows.select(*KEY, "ref_value", "file_value", F.abs(F.col("ref_value") - F.col("file_value")).alias("abs_diff"), equal.alias("equal"))


def compare_summary(ref: DataFrame, test: DataFrame, atol: float = 1e-6, rtol: float = 1e-6) -> DataFrame:
    """One row: PASSED or FAILED, columns on each side, the overlap, mismatching columns and cells."""
    a, b = ref.select("b", "c").distinct(), test.select("b", "c").distinct()
    keys = a.withColumn("_r", F.lit(1)).join(b.withColumn("_t", F.lit(1)), ["b", "c"], "full").agg(
        F.count("_r").alias("ref_columns"), F.count("_t").alias("file_columns"),
        F.count_if(F.col("_r").isNotNull() & F.col("_t").isNotNull()).alias("common_columns"), F.count_if(F.col("_t").isNull()).alias("only_in_ref"),
        F.count_if(F.col("_r").isNull()).alias("only_in_file")
    )
    bad = compare_series(ref, test, atol, rtol).where("not equal").groupBy("b", "c").agg(F.count("*").alias("n")).agg(
        F.count("*").alias("mismatch_columns"), F.coalesce(F.sum("n"), F.lit(0)).alias("mismatch_cells")
    )
    out = keys.crossJoin(bad).crossJoin(overlap(ref, test))
    return out.withColumn("status", F.when(F.col("mismatch_cells") == 0, "PASSED").otherwise("FAILED"))


def mismatch_detail(cells: DataFrame, large: float = 1.0) -> DataFrame:
    """Unequal cells with their kind: a side missing, a difference, or one just over the tolerance."""
    kind = F.when(F.col("ref_value").isNull(), "missing_in_ref").when(F.col("file_value").isNull(), "missing_in_file").when(F.col("abs_diff") >= large, "value_difference").otherwise("tolerance_exceeded")
    return cells.where("not equal").withColumn("mismatch_type", kind)


def mismatch_rates(cells: DataFrame) -> DataFrame:
    """Cells, mismatches and their rate in percent of each column."""
    return cells.groupBy("b", "c").agg(F.count("*").alias("cells"), F.count_if(~F.col("equal")).alias("mismatches")).withColumn(
        "mismatch_rate_pct", rounded(F.col("mismatches") * 100.0 / F.col("cells"), 4)
    )


def mismatch_patterns(mismatches: DataFrame, top: int = 10) -> DataFrame:
    """The commonest kinds and places with count and mean, median and largest difference."""
    return mismatches.groupBy("mismatch_type", "b").agg(
        F.count("*").alias("n"), rounded(F.avg("abs_diff"), 6).alias("mean_diff"), rounded(F.percentile("abs_diff", 0.5), 6).alias("median_diff"),
        rounded(F.max("abs_diff"), 6).alias("max_diff")
    ).orderBy(F.desc("n"), "mismatch_type", "b").limit(top)


def pass_rates(runs: DataFrame) -> DataFrame:
    """Per scenario the runs and the share that passed (status PASSED)."""
    return runs.groupBy("scenario").agg(
        F.count("*").alias("runs"), F.count_if(F.col("status") == "PASSED").alias("passed")
    ).withColumn("pass_rate_pct", rounded(F.col("passed") * 100.0 / F.col("runs")))


def verify_metrics(calculated: DataFrame, expected: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """Metric by metric PASS, FAIL or MISSING; probabilities given over 1 are out of 100.

    The error is relative, but absolute where 0 is expected.
    """
    rows = calculated.select("metric", F.col("value").alias("calculated")).join(
        expected.select("metric", F.col("value").alias("_given"), F.lit(True).alias("_there")), "metric", "left"
    )
    wanted = F.when(F.contains("metric", F.lit("Prob_")) & (F.col("_given") > 1), F.col("_given") / 100).otherwise(F.col("_given"))
    rows = rows.withColumn("expected", wanted)
    error = F.when(F.col("expected") == 0, F.abs("calculated")).otherwise(F.abs(F.try_divide(F.col("calculated") - F.col("expected"), F.col("expected"))))
    rows = rows.withColumn("error", error)
    return rows.select(
        "metric", "calculated", "expected", "error",
        F.when(F.col("_there").isNull(), "MISSING").when(F.col("error") < tolerance, "PASS").otherwise("FAIL").alias("status")
    )


def compare_percentiles(calculated: DataFrame, expected: DataFrame, keys: Sequence[str], columns: Sequence[str], tolerance: float = 1e-4) -> DataFrame:
    """Per percentile column the cells compared and those that fail, from two wide tables."""
    long = lambda df, v: df.unpivot(list(keys), list(columns), "percentile", v)
    rows = long(calculated.select(*keys, *columns), "calculated").join(long(expected.select(*keys, *columns), "expected"), [*keys, "percentile"])
    error = F.when(F.col("expected") == 0, F.abs("calculated")).otherwise(F.abs(F.try_divide(F.col("calculated") - F.col("expected"), F.col("expected"))))
    return rows.groupBy("percentile").agg(F.count("*").alias("total"), F.count_if(F.coalesce(error >= tolerance, F.lit(True))).alias("failures"))


def orphans(facts: dict[str, DataFrame], dimension: DataFrame, key: str) -> DataFrame:
    """Per fact table the rows whose key is in no dimension row; a null key counts."""
    one = lambda name, df: df.join(dimension.select(key).distinct(), key, "left_anti").agg(F.count("*").alias("orphans")).select(F.lit(name).alias("table"), "orphans")
    return reduce(DataFrame.unionByName, [one(n, d) for n, d in facts.items()])


def completeness(scenarios: DataFrame, facts: dict[str, DataFrame]) -> DataFrame:
    """Rows of each scenario in each fact table, and the first table without any, else OK."""
    out = scenarios.select("scenario")
    for name, df in facts.items():
        out = out.join(df.groupBy("scenario").agg(F.count("*").alias(f"{name}_rows")), "scenario", "left").fillna(0, [f"{name}_rows"])
    status = F.coalesce(*(F.when(F.col(f"{n}_rows") == 0, F.lit(f"missing {n}")) for n in facts), F.lit("OK"))
    return out.withColumn("status", status)


def null_audit(tables: dict[str, DataFrame], column: str) -> DataFrame:
    one = lambda n, d: d.agg(F.count("*").alias("total"), F.count_if(F.col(column).isNull()).alias("missing")).select(F.lit(n).alias("table"), "total", "missing")
    return reduce(DataFrame.unionByName, [one(n, d) for n, d in tables.items()])


def range_check(tables: dict[str, DataFrame], column: str, low: float, high: float) -> DataFrame:
    one = lambda n, d: d.agg(F.count_if(~F.col(column).between(low, high)).alias("outside")).select(F.lit(n).alias("table"), "outside")
    return reduce(DataFrame.unionByName, [one(n, d) for n, d in tables.items()])


def table_profile(tables: dict[str, DataFrame], audit: Sequence[str] = ("created_by", "created_at")) -> DataFrame:
    """Rows, columns and types of each table, its audit columns, creators, first and last creation."""

    def one(name: str, df: DataFrame) -> DataFrame:
        by, at = audit
        has = lambda c: c in df.columns
        return df.agg(
            F.count("*").alias("rows"), (F.countDistinct(by) if has(by) else F.lit(None).cast("long")).alias("creators"),
            (F.min(at) if has(at) else F.lit(None)).cast("timestamp").alias("first_created"),
            (F.max(at) if has(at) else F.lit(None)).cast("timestamp").alias("last_created")
        ).select(
            F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns"), F.lit(", ".join(f"{c}:{t}" for c, t in df.dtypes)).alias("types"), F.lit(all(has(c) for c in audit)).alias("has_audit_columns"), "creators", "first_created", "last_created"
        )

    return reduce(DataFrame.unionByName, [one(n, d) for n, d in tables.items()])


def schema_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Columns (table, column) on one side only."""
    both = expected.select("table", "column").distinct().withColumn("_e", F.lit(1)).join(
        actual.select("table", "column").distinct().withColumn("_a", F.lit(1)), ["table", "column"], "full"
    )
    return both.where("_e is null or _a is null").select("table", "column", F.when(F.col("_a").isNull(), "only_expected").otherwise("only_actual").alias("side"))


def attach_entity_ids(facts: DataFrame, entities: DataFrame) -> DataFrame:
    """Facts with entity_id by their code; null where the code is unknown."""
    return facts.join(entities.select("code", F.col("id").alias("entity_id")), "code", "left")


def unmapped(facts: DataFrame) -> DataFrame:
    return facts.agg(F.count("*").alias("total"), F.count_if(F.col("entity_id").isNull()).alias("unmapped"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [d.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table"), "rows") for n, d in sorted(tables.items())])
