"""Every registered query against the same result in DuckDB, over whole tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest
from given import TESTDATA

import __spark_entry__ as entry_points
from tripwright.plans.derive import TABLES
from tripwright.plans.queries import REGISTRY

FOLDER = TESTDATA / os.environ.get("ORACLE_SF", "sf0.01")
# Queries of the subpackage that may be absent are tested with it.
QUERIES = {n: q for n, q in entry_points.queries().items() if n in REGISTRY}
ORACLE = {n: s for n, s in entry_points.oracle_sql().items() if n in REGISTRY}
SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def in_order(names, rows):
    spots = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in spots) for row in rows)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        path = FOLDER / f"{table}.parquet"
        connection.sql(f"create view {table} as select * from '{path}'")
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, str(FOLDER))
    want = duck.sql(ORACLE[name])
    types = {f.name: SPARK_TYPES[f.dataType.simpleString()] for f in got.schema}
    assert types == dict(zip(want.columns, map(str, want.types), strict=True))
    rows = in_order(got.columns, got.collect())
    assert rows, "an empty result would prove nothing"
    assert rows == in_order(want.columns, want.fetchall())


def test_entry_runs(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["pickup_hour", "Borough", "mean_speed_mph", "trip_count"]
    assert result.count() == 120


@pytest.mark.parametrize(
    ("key", "value"),
    [
        ("spark.sql.session.timeZone", "America/New_York"),
        ("spark.sql.ansi.enabled", "false"),
        ("spark.sql.adaptive.enabled", "false"),
        ("spark.sql.autoBroadcastJoinThreshold", "-1"),
        ("spark.sql.caseSensitive", "true"),
    ],
)
@pytest.mark.parametrize(
    "name", ["speed_by_hour_borough_keyed", "pipeline_funnel", "scan_normalized"]
)
def test_results_do_not_hang_on_session_settings(spark, duck, name, key, value):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        got = QUERIES[name](spark, str(FOLDER))
        rows = in_order(got.columns, got.collect())
    finally:
        spark.conf.set(key, before)
    want = duck.sql(ORACLE[name])
    assert rows == in_order(want.columns, want.fetchall())
