from __future__ import annotations

import re

import pytest
from plans_of import final, formatted
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tripwright.functions.speed import speed_mph, speed_mph_by_batch, speed_mph_by_row
from tripwright.operators import enrich

FORMS = [speed_mph, speed_mph_by_row, speed_mph_by_batch]


@pytest.fixture(scope="module")
def trips(spark):
    """Three in eight trips start in zone 1, the rest are spread over zones 0 to 9."""
    return spark.range(4000).select(
        F.col("id"),
        F.when(F.col("id") % 8 < 3, 1).otherwise(F.col("id") % 10).cast("bigint").alias(
            "PULocationID"
        ),
    )


@pytest.fixture(scope="module")
def zones(spark):
    return spark.sql(
        "select * from values (1L,'A','a1','x'),(2L,'A','a2','x'),(3L,null,'b3','x'),"
        "(4L,'N/A','c4','x') as t(LocationID, Borough, Zone, service)"
    )


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_only_matched_trips_stay_and_only_two_zone_columns_come(trips, zones):
    out = enrich.join_zone(trips, zones)
    assert out.columns == ["id", "PULocationID", "Borough", "Zone"]
    want = trips.filter("PULocationID between 1 and 4").count()
    assert out.count() == want
    assert out.filter("Borough is null").count() == trips.filter("PULocationID = 3").count()


@pytest.fixture
def counting(spark):
    """A counter to hand to a join, and what it counted."""
    counter = Observation()
    yield lambda rows, once: rows.observe(counter, F.count_if(once).alias("n")), counter


@pytest.mark.parametrize("repeated", [False, True])
def test_a_counter_in_a_join_sees_every_trip_once(trips, zones, counting, repeated):
    tell, counter = counting
    dim = zones.union(zones) if repeated else zones
    joined = enrich.join_zone(trips, dim, 0, tell=tell)
    assert "LeftOuter" in formatted(joined)
    assert rows(joined) == rows(enrich.join_zone(trips, dim))
    assert counter.get["n"] == trips.count()


def test_a_unique_key_is_not_numbered(trips, zones):
    def plan(dim):
        return formatted(enrich.join_zone(trips, dim, 0, tell=lambda rows, once: rows.withColumn("once", once)))

    assert "Window" not in plan(zones)
    assert "Window" in plan(zones.union(zones))


@pytest.mark.parametrize("salts", [None, 1, 3, 50])
def test_merge_form_gives_the_same_rows(trips, zones, salts):
    merged = enrich.join_zone_merge(trips, zones, salts=salts)
    assert rows(merged) == rows(enrich.join_zone(trips, zones))


def test_a_repeated_key_multiplies_rows(spark, trips, zones):
    doubled = zones.union(zones.filter("LocationID = 1"))
    extra = trips.filter("PULocationID = 1").count()
    assert (
        enrich.join_zone(trips, doubled).count()
        == enrich.join_zone_merge(trips, doubled).count()
        == enrich.join_zone(trips, zones).count() + extra
    )


def test_a_column_of_the_trips_named_like_the_zone_key_stays(trips, zones):
    named = trips.withColumn("LocationID", F.lit("mine"))
    for join in (enrich.join_zone, enrich.join_zone_merge, enrich.look_up_zone):
        out = join(named, zones)
        assert out.columns == ["id", "PULocationID", "LocationID", "Borough", "Zone"]
        assert out.select("LocationID").distinct().head()[0] == "mine"


def test_lookup_refuses_a_repeated_key(trips, zones):
    with pytest.raises(ValueError, match="zone key 1 "):
        enrich.look_up_zone(trips, zones.union(zones.filter("LocationID = 1")))


def test_lookup_tolerates_repeated_null_keys(spark, trips, zones):
    nulls = spark.sql("select cast(null as bigint) as LocationID, 'Z' as Borough, 'z' as Zone")
    padded = zones.select("LocationID", "Borough", "Zone").union(nulls).union(nulls)
    assert rows(enrich.look_up_zone(trips, padded)) == rows(enrich.look_up_zone(trips, zones))


@pytest.mark.parametrize("limit", [0, enrich.BROADCAST_LIMIT_BYTES])
def test_lookup_drops_null_boroughs_by_either_join(trips, zones, limit):
    out = enrich.look_up_zone(trips, zones, limit)
    assert rows(out) == rows(enrich.join_zone(trips, zones).filter("Borough is not null"))
    assert out.filter("Borough = 'N/A'").count() > 0


def test_small_zones_are_broadcast_and_trips_stay_put(trips, zones):
    for join in (enrich.join_zone, enrich.look_up_zone):
        tree = formatted(join(trips, zones)).split("\n\n")[0]
        assert "BroadcastHashJoin Inner BuildRight" in tree
        assert "Exchange" not in tree.replace("BroadcastExchange", "")


def test_large_zones_are_merged(trips, zones):
    for join in (enrich.join_zone, enrich.look_up_zone):
        plan = formatted(join(trips, zones, 0))
        assert "SortMergeJoin" in plan
        # The one table broadcast is that of the hot zones and their parts.
        assert set(re.findall(r"BroadcastHashJoin (\w+) BuildRight", plan)) <= {"LeftOuter"}
        assert set(re.findall(r"Right keys \[1\]: \[(\w+)#\d+L?\]", plan)) == {"_zone"}
    assert "SortMergeJoin" in formatted(enrich.join_zone_merge(trips, zones))


def test_salts_spread_few_keys_and_leave_many_alone():
    assert enrich.salts_for(keys=265, partitions=10_000) == 151
    assert enrich.salts_for(keys=5_000_000, partitions=10_000) == 1
    assert enrich.salts_for(keys=0, partitions=8) == 32


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_merge_form_splits_a_hot_zone(settings, trips, zones):
    settings("spark.sql.adaptive.coalescePartitions.enabled", "false")

    def largest_task(salts):
        joined = enrich.join_zone_merge(trips, zones, salts=salts)
        hot = joined.filter("PULocationID = 1").groupBy(F.spark_partition_id()).count()
        return hot.agg(F.max("count")).head()[0]

    hot = trips.filter("PULocationID = 1").count()
    assert largest_task(1) == hot
    assert largest_task(16) < hot / 2


def test_of_a_million_zones_only_the_hot_one_is_split(settings, spark):
    settings("spark.sql.adaptive.enabled", "false")
    settings("spark.sql.shuffle.partitions", "32")
    zones = spark.range(1_000_000).selectExpr(
        "id as LocationID", "concat('b', id % 7) as Borough", "concat('z', id) as Zone"
    )
    trips = spark.range(0, 300_000, 1, 16).selectExpr(
        "id", "if(id % 3 = 0, 77L, xxhash64(id) % 1000000) as PULocationID"
    )
    hot = enrich.hot_zones(trips, 32)
    assert list(hot) == [77] and 40 <= hot[77] <= 46
    joined = enrich.join_zone_merge(trips, zones)
    tasks = joined.groupBy(F.spark_partition_id().alias("task")).count()
    sizes = sorted(r["count"] for r in tasks.collect())
    assert len(sizes) == 32 and sizes[-1] <= 4 * sizes[16]
    assert sum(sizes) == trips.filter("PULocationID >= 0").count()
    one_part = enrich.join_zone_merge(trips, zones, salts=1)
    whole = one_part.groupBy(F.spark_partition_id().alias("task")).count()
    assert whole.agg(F.max("count")).head()[0] > 8 * sizes[16]


def test_hot_zones_are_told_from_other_rows_of_one_column(trips, zones, spark):
    like = spark.range(1000).selectExpr("if(id < 900, 2L, null) as PULocationID")
    assert enrich.hot_zones(like, 8) == {2: 32}
    joined = enrich.join_zone_merge(trips, zones, like=like)
    assert rows(joined) == rows(enrich.join_zone(trips, zones))


def test_hot_zones_of_nothing_and_of_even_rows(spark):
    none = spark.range(0).selectExpr("id as PULocationID")
    assert enrich.hot_zones(none, 8) == {}
    even = spark.range(10_000).selectExpr("id % 1000 as PULocationID")
    assert enrich.hot_zones(even, 8) == {}
    few = spark.range(10_000).selectExpr("id % 4 as PULocationID")
    assert enrich.hot_zones(few, 8) == {0: 8, 1: 8, 2: 8, 3: 8}


def test_merge_form_splits_copies_of_one_trip(settings, spark, zones):
    settings("spark.sql.adaptive.coalescePartitions.enabled", "false")
    copies = spark.range(0, 8_000, 1, 64).selectExpr("7L as id", "1L as PULocationID")
    joined = enrich.join_zone_merge(copies, zones, salts=16)
    per_task = joined.groupBy(F.spark_partition_id()).count()
    assert joined.count() == 8_000
    assert per_task.agg(F.max("count")).head()[0] < 4_000


def test_adaptive_skew_join_splits_what_is_left(settings, spark, zones):
    settings("spark.sql.adaptive.coalescePartitions.enabled", "false")
    settings("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    settings("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    settings("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    trips = spark.range(0, 20_000, 1, 16).selectExpr(
        "sha2(cast(id as string), 256) as id", "if(id % 3 = 0, 1L, id % 1000) as PULocationID"
    )
    joined = enrich.join_zone_merge(trips, zones, salts=1)
    assert "SortMergeJoin(skew=true)" in final(joined)
    assert joined.count() == trips.filter("PULocationID between 1 and 4").count()


@pytest.fixture(scope="module")
def timed(spark):
    return spark.sql(
        "select * from values (1, 2.5D, 600L), (2, 0.1D, 7L), (3, 9D, 0L), (4, 9D, -5L),"
        "(5, null, 60L), (6, 4D, null), (7, 1.1D, 1234L) as t(id, trip_distance, trip_duration_s)"
    )


def test_speed_forms_are_bit_equal(timed):
    got = [[r.avg_speed_mph for r in enrich.add_speed(timed, f).orderBy("id").collect()]
           for f in FORMS]
    assert got[0] == got[1] == got[2]
    assert got[0] == [2.5 / (600 / 3600.0), 0.1 / (7 / 3600.0), None, None, None, None,
                      1.1 / (1234 / 3600.0)]


@pytest.mark.parametrize(
    ("form", "node"),
    [
        (speed_mph, None),
        (speed_mph_by_row, "BatchEvalPython"),
        (speed_mph_by_batch, "ArrowEvalPython"),
    ],
)
def test_speed_forms_run_where_they_say(timed, form, node):
    plan = formatted(enrich.add_speed(timed.repartition(2), form))
    assert node is None and "Python" not in plan or node in plan


def test_row_form_stays_row_wise_under_any_session_default(settings, timed):
    settings("spark.sql.execution.pythonUDF.arrow.enabled", "true")
    plan = formatted(enrich.add_speed(timed.repartition(2), speed_mph_by_row))
    assert "BatchEvalPython" in plan


def test_hour_is_in_utc(spark):
    df = spark.sql("select timestamp'2024-01-01 23:59:59.999' as pickup_ts")
    assert enrich.add_hour(df).head().pickup_hour == 23
