"""Every registered query of the library against its SQL on the smallest tables."""

import datetime
import math
import os

import duckdb
import pytest

from __spark_entry__ import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(plain, value)) + "]"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_sql(spark, sql, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted([plain(row[c]) for c in columns] for row in df.collect())
    cursor = sql.execute(registry.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted([plain(row[names.index(c)]) for c in columns] for row in cursor.fetchall())
    assert got == want
