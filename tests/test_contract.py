from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwright.contract import TRIPS, Contract, ContractError

SMALL = Contract.of(
    {"Id": T.LongType(), "Amount": T.DoubleType(), "At": T.TimestampType()}, required=["Id"]
)


def test_columns_are_matched_without_case_cast_and_ordered(spark):
    df = spark.sql("select cast(2.5 as float) as AMOUNT, 7 as id, 'x' as other")
    out = SMALL.project(df)
    assert [(f.name, f.dataType) for f in out.schema] == [
        ("Id", T.LongType()),
        ("Amount", T.DoubleType()),
        ("At", T.TimestampType()),
    ]
    assert tuple(out.head()) == (7, 2.5, None)


def test_values_that_do_not_fit_become_null(spark):
    df = spark.sql("select double('NaN') as Id, 'abc' as Amount, 'no time' as At")
    assert tuple(SMALL.project(df).head()) == (None, None, None)


def test_wall_clock_times_are_read_as_utc(spark):
    df = spark.sql("select 1 as Id, timestamp_ntz'2024-01-01 00:30:00' as At")
    assert SMALL.project(df).select(F.unix_seconds("At")).head()[0] == 1704069000


def test_a_missing_required_column_is_named(spark):
    with pytest.raises(ContractError, match=r"here: .*'Id'"):
        SMALL.project(spark.sql("select 1.0 as Amount"), "here")


def test_names_differing_by_case_are_refused():
    with pytest.raises(ContractError, match="'Airport_fee' and 'airport_fee'"):
        TRIPS.check_columns([*TRIPS.names, "Airport_fee", "airport_fee"], "file")


def test_required_columns_must_be_in_the_contract():
    with pytest.raises(ContractError, match="outside"):
        Contract.of({"a": T.LongType()}, required=["b"])


def test_a_column_of_the_right_type_is_not_cast(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("select 1L as Id, 2D as Amount, timestamp'2024-01-01' as At").write.parquet(path)
    out = SMALL.project(spark.read.parquet(path)).filter("Amount > 1")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(Amount,1.0)" in plan
    assert "cast" not in plan
