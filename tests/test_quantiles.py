from __future__ import annotations

import math
import random

import pytest

from tripwright.operators import quantiles

FRACTIONS = [0.0, 0.25, 0.5, 0.75, 1.0]
SMALL_GROUPS = {
    "one": [3],
    "two": [1, 2],
    "three": [5, 1, 9],
    "same": [4] * 9,
    None: [1, 2, 3, 10],
    "four": [-1, 0, 0, 8],
    "five": [5, 4, 3, 2, 1],
}


def large_groups():
    rng = random.Random(7)
    return {
        "spread": [rng.gauss(0, 1) for _ in range(20_000)],
        "steps": [rng.randrange(12) for _ in range(9_000)],
        "mostly one": [5.0] * 7_000 + [rng.random() * 10 for _ in range(3_000)],
        "long tail": [rng.random() ** -3 for _ in range(8_001)],
    }


def exact(values, fraction):
    values = sorted(map(float, values))
    position = fraction * (len(values) - 1)
    lo, hi = values[math.floor(position)], values[math.ceil(position)]
    return lo + (hi - lo) * (position - math.floor(position))


def table(spark, groups):
    rows = [(k, float(v)) for k, values in groups.items() for v in values]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "k string, v double").repartition(4)


def check(out, groups):
    got = {r.k: r.percentiles for r in out.collect()}
    assert set(got) == set(groups)
    for key, values in groups.items():
        assert got[key] == pytest.approx([exact(values, f) for f in FRACTIONS], rel=1e-12), key


@pytest.mark.parametrize("limit", [0, 5, quantiles.SLICE_LIMIT])
def test_small_groups_however_often_they_are_cut(spark, limit):
    df = table(spark, SMALL_GROUPS)
    check(quantiles.exact_percentiles(df, ["k"], "v", FRACTIONS, limit), SMALL_GROUPS)


@pytest.mark.parametrize("limit", [20, quantiles.SLICE_LIMIT])
def test_large_groups_are_exact(spark, limit):
    groups = large_groups()
    check(quantiles.exact_percentiles(table(spark, groups), ["k"], "v", FRACTIONS, limit), groups)


ODD = {
    "infinite": [-math.inf, 1.0],
    "both ends": [-math.inf, math.inf],
    "far apart": [1e308, -1e308],
    "uneven": [0.1, 0.7, 0.3, 1.9],
    "nan": [math.nan, 1.0, 2.0],
}


@pytest.mark.parametrize("limit", [0, quantiles.SLICE_LIMIT])
def test_results_are_those_of_sparks_percentile_to_the_bit(spark, limit):
    from pyspark.sql import functions as F

    fractions = [0.0, 0.1, 1 / 3, 0.5, 0.9, 1.0]
    df = table(spark, ODD | large_groups())
    want = {r.k: r.p for r in df.groupBy("k").agg(F.percentile("v", fractions).alias("p")).collect()}
    got = {r.k: r.percentiles for r in quantiles.exact_percentiles(df, ["k"], "v", fractions, limit).collect()}
    assert {k: repr(v) for k, v in got.items()} == {k: repr(v) for k, v in want.items()}


def test_no_window_spans_a_whole_group(spark):
    groups = large_groups()
    values, wanted = (
        table(spark, groups).selectExpr("k as _key0", "'' as _slice", "v as _v", "1L as _n").distinct(),
        spark.createDataFrame([("spread", "", 0, 9_999)], "_key0 string, _slice string, _i int, _rank long"),
    )
    kept, ranks, _ = quantiles._cut(values, wanted, ["_key0"])
    assert kept.count() < 20_000 / 30 and ranks.count() == 1


@pytest.mark.parametrize("limit", [0, 50, quantiles.SLICE_LIMIT])
def test_the_input_is_read_once(spark, tmp_path, limit):
    """What is left to run reads written counts and open slices, not the input."""
    from plans_of import formatted

    table(spark, large_groups()).write.parquet(f"{tmp_path}/timings")
    out = quantiles.exact_percentiles(spark.read.parquet(f"{tmp_path}/timings"), ["k"], "v", FRACTIONS, limit)
    assert "/timings" not in formatted(out)
    if limit == quantiles.SLICE_LIMIT:
        assert formatted(out).split("(1) Scan")[0].count("Exchange") == 1


def test_small_and_large_groups_side_by_side(spark):
    groups = SMALL_GROUPS | large_groups()
    check(quantiles.exact_percentiles(table(spark, groups), ["k"], "v", FRACTIONS, 100), groups)


def test_key_columns_may_have_any_name(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5.0)], "v int, low int, total int, _slice int, x double")
    (row,) = quantiles.exact_percentiles(df, ["v", "low", "total", "_slice"], "x", [0.5]).collect()
    assert tuple(row) == (1, 2, 3, 4, [5.0])


@pytest.mark.parametrize("limit", [0, 10])
def test_nulls_are_skipped(spark, limit):
    rows = [("a", 1.0), ("a", None), ("a", 3.0), ("b", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    out = quantiles.exact_percentiles(df, ["k"], "v", [0.5], limit)
    assert [tuple(r) for r in out.collect()] == [("a", [2.0])]


def test_an_empty_table_has_no_groups(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert quantiles.exact_percentiles(df, ["k"], "v", [0.5]).count() == 0
