from __future__ import annotations

import math

import pytest
from plans_of import formatted
from pyspark.sql import functions as F

from tripwright.contract import TRIPS
from tripwright.functions.time import elapsed_seconds
from tripwright.operators import clean

DEFAULTS = {
    "VendorID": "1L",
    "tpep_pickup_datetime": "timestamp'2024-01-01 08:00:00'",
    "tpep_dropoff_datetime": "timestamp'2024-01-01 08:10:00'",
    "passenger_count": "1D",
    "trip_distance": "2D",
    "PULocationID": "3L",
    "DOLocationID": "4L",
    "payment_type": "1L",
    "fare_amount": "10D",
    "total_amount": "12D",
}


def trips(spark, *changes):
    def one(change):
        values = DEFAULTS | change
        return "select " + ", ".join(
            f"cast({values[f.name]} as {f.type.simpleString()}) as {f.name}" for f in TRIPS.fields
        )

    return spark.sql(" union all ".join(map(one, changes)))


def test_rows_with_null_or_nan_in_a_required_column_go(spark):
    rows = trips(spark, {}, *[{n: "null"} for n in TRIPS.names], {"trip_distance": "double('NaN')"})
    kept = clean.drop_incomplete(rows)
    assert kept.count() == 1 + len(TRIPS.names) - len(TRIPS.required)


def test_nan_in_an_optional_column_stays(spark):
    assert clean.drop_incomplete(trips(spark, {"fare_amount": "double('NaN')"})).count() == 1


def test_copies_treat_null_nan_and_signed_zero_as_equal(spark):
    df = trips(
        spark,
        {"passenger_count": "null"},
        {"passenger_count": "null"},
        {"fare_amount": "double('NaN')"},
        {"fare_amount": "double('NaN')"},
        {"fare_amount": "0D"},
        {"fare_amount": "-0D"},
    )
    assert clean.drop_copies(df).count() == 3


@pytest.mark.parametrize(
    ("seconds", "kept"), [(-1, 0), (0, 0), (1, 1), (21_599, 1), (21_600, 0), (21_601, 0)]
)
def test_duration_limits_are_strict(spark, seconds, kept):
    end = f"timestamp_seconds(unix_seconds(timestamp'2024-01-01 08:00:00') + {seconds})"
    assert clean.clean(trips(spark, {"tpep_dropoff_datetime": end})).count() == kept


@pytest.mark.parametrize(("miles", "kept"), [("-1D", 0), ("0D", 0), ("-0D", 0), ("0.01D", 1)])
def test_distance_must_be_positive(spark, miles, kept):
    assert clean.clean(trips(spark, {"trip_distance": miles})).count() == kept


@pytest.mark.parametrize(
    ("start", "end", "seconds"),
    [
        ("2024-01-01 00:00:00.9", "2024-01-01 00:00:01.1", 1),
        ("2024-01-01 00:00:00.1", "2024-01-01 00:00:00.9", 0),
        ("1969-12-31 23:59:59.5", "1970-01-01 00:00:00", 1),
    ],
)
def test_both_sides_of_a_duration_are_floored(spark, start, end, seconds):
    df = spark.sql(f"select timestamp'{start}' as a, timestamp'{end}' as b")
    assert df.select(elapsed_seconds(F.col("a"), F.col("b"))).head()[0] == seconds


def test_a_refund_is_a_row_of_its_own_but_loses_by_key(spark):
    df = trips(
        spark,
        {"fare_amount": "-10D", "total_amount": "-12D"},
        {},
    )
    assert clean.drop_copies(df).count() == 2
    assert [r.fare_amount for r in clean.drop_copies_by_key(df).collect()] == [10.0]


def test_ties_are_broken_by_every_other_column(spark):
    df = trips(
        spark,
        {"total_amount": "null", "fare_amount": "99D"},
        {"VendorID": "2L"},
        {"passenger_count": "null"},
        {"passenger_count": "4D"},
        {"payment_type": "0L", "passenger_count": "null"},
    )
    (best,) = clean.drop_copies_by_key(df).collect()
    assert (best.total_amount, best.VendorID, best.payment_type) == (12.0, 1, 0)


def test_keyed_choice_does_not_depend_on_partitioning(spark):
    rows = [{"fare_amount": f"{i % 7}D", "total_amount": f"{i % 5}D", "PULocationID": f"{i % 4}L"}
            for i in range(60)]
    df = trips(spark, *rows)
    results = [sorted(map(tuple, clean.drop_copies_by_key(df.repartition(n)).collect()))
               for n in (1, 8)]
    assert results[0] == results[1]
    assert len(results[0]) == 4


def test_cleaning_by_key_needs_no_prior_distinct(spark):
    df = trips(spark, {}, {}, {"fare_amount": "9D"}, {"DOLocationID": "5L"})
    once = clean.clean_by_key(df)
    twice = clean.drop_copies_by_key(clean.clean(df))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_empty_input_gives_empty_output(spark):
    assert clean.clean(trips(spark, {}).filter("false")).count() == 0


def test_required_columns_and_distance_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "trips")
    trips(spark, {}).write.parquet(path)
    plan = formatted(clean.clean(spark.read.parquet(path)))
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    for name in TRIPS.required:
        assert f"IsNotNull({name})" in pushed
    assert "GreaterThan(trip_distance,0.0)" in pushed


def test_full_row_copies_collapse_before_the_only_shuffle(spark, tmp_path):
    path = str(tmp_path / "trips")
    trips(spark, {}).write.parquet(path)
    plan = formatted(clean.clean(spark.read.parquet(path)))
    tree = plan.split("(1) Scan")[0]
    assert tree.count("Exchange") == 1
    assert tree.count("HashAggregate") == 2
    assert "Python" not in tree


def test_keyed_copies_are_cut_before_the_only_shuffle(spark, tmp_path):
    path = str(tmp_path / "trips")
    trips(spark, {}).write.parquet(path)
    tree = formatted(clean.clean_by_key(spark.read.parquet(path))).split("(1) Scan")[0]
    assert tree.count("Exchange") == 1
    assert tree.count("WindowGroupLimit") == 2


def test_nan_never_passes_as_a_positive_distance(spark):
    df = trips(spark, {"trip_distance": "double('NaN')"})
    assert math.isnan(df.head().trip_distance)
    assert clean.clean(df).count() == 0
