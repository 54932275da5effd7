"""The list of registered queries, and helpers that both sides of a query share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def widened(df: DataFrame) -> DataFrame:
    """Integers of all widths as BIGINT and decimals as DOUBLE, so that both engines give one type."""
    to = {"int": "bigint", "smallint": "bigint", "tinyint": "bigint", "float": "double"}
    kinds = {c: to.get(t, "double" if t.startswith("decimal") else None) for c, t in df.dtypes}
    return df.select(*(F.col(f"`{c}`").cast(k).alias(c) if k else F.col(f"`{c}`") for c, k in kinds.items()))


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query function under a name, with SQL where there is any."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: widened(function(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return function

    return add


def r(x: str, digits: int = 2) -> str:
    """SQL of ``functions.scalars.rounded``."""
    return f"round(({x}) + CASE WHEN ({x}) < 0 THEN -1e-7 ELSE 1e-7 END, {digits})"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"
