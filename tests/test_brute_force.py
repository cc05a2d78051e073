"""Cleaning and joining of random dirty trips against plain Python over the same rows."""

from __future__ import annotations

import math
import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest

from tripwright.contract import TRIP_KEYS, TRIPS
from tripwright.operators import clean, enrich
from tripwright.operators.summarise import speed_by_group

START = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)
SCHEMA = ", ".join(f"{f.name} {f.type.simpleString()}" for f in TRIPS.fields)
ZONES = [(1, "A", "a"), (2, None, "b"), (3, "A", "c"), (4, "N/A", "d"), (5, "B", "e")]


def random_trips(seed, size=600):
    """Few distinct values per column, so that copies and shared keys are common."""
    rng = random.Random(seed)

    def one():
        pickup = START + timedelta(seconds=rng.choice([0, 0.4, 0.9, 3600]))
        seconds = rng.choice([-1, 0, 0.2, 0.7, 1, 600, 21_599, 21_599.5, 21_600, 30_000])
        return (
            rng.choice([1, 2, None]),
            rng.choice([pickup, pickup, pickup, None]),
            rng.choice([pickup + timedelta(seconds=seconds)] * 5 + [None]),
            rng.choice([1.0, None, math.nan]),
            rng.choice([1.5, 1.5, 2.25, 0.0, -1.0, math.nan, None]),
            rng.choice([1, 2, 3, 4, 5, 6, None]),
            rng.choice([7, 7, 7, None]),
            rng.choice([1, None]),
            rng.choice([10.0, -10.0, 0.0, math.nan, None]),
            rng.choice([12.0, -12.0, None]),
        )

    return [one() for _ in range(size)]


def known(value):
    return value is not None and not (isinstance(value, float) and math.isnan(value))


def as_key(row):
    """Equal exactly for rows that count as copies."""
    return tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in row)


def duration(trip):
    pickup, dropoff = (
        math.floor(trip[c].timestamp()) for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")
    )
    return dropoff - pickup


def plausible(rows):
    for row in rows:
        trip = dict(zip(TRIPS.names, row, strict=True))
        complete = all(known(trip[c]) for c in TRIPS.required)
        if complete and trip["trip_distance"] > 0 and 0 < duration(trip) < 21_600:
            yield trip


def rank(trip):
    """Smallest first: large totals and fares (NaN above all), then small codes, nulls last."""

    def descending(v):
        return (v is None, 0.0 if v is None else -math.inf if math.isnan(v) else -v)

    def ascending(v):
        return (v is None, 0.0 if v is None else math.inf if math.isnan(v) else v)

    return (
        descending(trip["total_amount"]),
        descending(trip["fare_amount"]),
        *(ascending(trip[c]) for c in ("VendorID", "payment_type", "passenger_count")),
    )


def expected(rows, keyed):
    groups = {}
    for trip in plausible(rows):
        names = TRIP_KEYS if keyed else TRIPS.names
        groups.setdefault(as_key(trip[n] for n in names), []).append(trip)
    return [min(group, key=rank) for group in groups.values()]


@pytest.fixture(scope="module", params=[1, 2])
def rows(request):
    return random_trips(request.param)


@pytest.fixture(scope="module")
def trips(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def collected(df):
    zoned = [
        tuple(v.astimezone(timezone.utc) if isinstance(v, datetime) else v for v in row)
        for row in df.collect()
    ]
    return Counter(map(as_key, zoned))


@pytest.mark.parametrize("keyed", [False, True])
def test_cleaning(trips, rows, keyed):
    step = clean.clean_by_key if keyed else clean.clean
    got = collected(step(trips).select(*TRIPS.names, "trip_duration_s"))
    want = [(*trip.values(), duration(trip)) for trip in expected(rows, keyed)]
    assert got == Counter(map(as_key, want))
    assert 20 < len(want) < len(rows)


@pytest.mark.parametrize("keyed", [False, True])
def test_summary(spark, trips, rows, keyed):
    zones = spark.createDataFrame(ZONES, "LocationID bigint, Borough string, Zone string")
    join, step = (
        (enrich.look_up_zone, clean.clean_by_key) if keyed else (enrich.join_zone, clean.clean)
    )
    enriched = enrich.add_hour(enrich.add_speed(join(step(trips), zones)))
    got = {tuple(r)[:2]: tuple(r)[2:] for r in speed_by_group(enriched).collect()}
    boroughs = {key: borough for key, borough, _ in ZONES}
    want = {}
    for trip in expected(rows, keyed):
        zone = trip["PULocationID"]
        if zone in boroughs and not (keyed and boroughs[zone] is None):
            group = (trip["tpep_pickup_datetime"].hour, boroughs[zone])
            speed = trip["trip_distance"] / (duration(trip) / 3600.0)
            want.setdefault(group, []).append(speed)
    assert set(got) == set(want)
    for group, speeds in want.items():
        mean, count = got[group]
        assert count == len(speeds)
        assert mean == pytest.approx(sum(speeds) / len(speeds), rel=1e-12)
