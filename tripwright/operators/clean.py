"""Dropping incomplete, implausible and repeated trips."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tripwright.contract import TRIP_KEYS, TRIPS
from tripwright.functions.time import elapsed_seconds

# Fixed value: trips of six hours or more are implausible.
MAX_DURATION_S = 6 * 3600


def drop_incomplete(df: DataFrame, required: Sequence[str] | None = None) -> DataFrame:
    """Keep rows in which every required column is neither null nor NaN.

    Spelled as null tests rather than ``na.drop`` because those reach the parquet scan and
    tell later joins that their keys are filled.
    """
    types = {f.name: f.dataType for f in df.schema}
    tests: list[Column] = []
    for name in TRIPS.required if required is None else required:
        tests.append(F.col(name).isNotNull())
        if isinstance(types[name], (T.DoubleType, T.FloatType)):
            tests.append(~F.isnan(name))
    return df.filter(reduce(Column.__and__, tests))


def trip_times() -> dict[str, Column]:
    """pickup_ts, dropoff_ts and the whole seconds between them."""
    pickup = F.col("tpep_pickup_datetime").cast("timestamp")
    dropoff = F.col("tpep_dropoff_datetime").cast("timestamp")
    return {
        "pickup_ts": pickup,
        "dropoff_ts": dropoff,
        "trip_duration_s": elapsed_seconds(pickup, dropoff),
    }


def add_duration(df: DataFrame) -> DataFrame:
    return df.withColumns(trip_times())


def keep_plausible(df: DataFrame) -> DataFrame:
    """Keep a positive distance and a duration strictly between zero and the maximum."""
    seconds = trip_times()["trip_duration_s"]
    return df.filter((F.col("trip_distance") > 0) & (seconds > 0) & (seconds < MAX_DURATION_S))


def drop_copies(df: DataFrame) -> DataFrame:
    """Keep one of each set of rows equal in all columns, over the whole table.

    Each map task first collapses its own copies, so a row repeated any number of times
    reaches the shuffle at most once per task.
    """
    return df.dropDuplicates()


def drop_copies_by_key(
    df: DataFrame,
    keys: Sequence[str] = TRIP_KEYS,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Keep the first row of each key under a stated order, over the whole table.

    The default order ranks by the larger total, then by every other column of the trip
    contract, so rows that tie are equal and the outcome does not depend on partitioning.
    Spark cuts each key to one row per map task before the shuffle (a partial group limit)
    and again after it, so a key with very many rows does not pile up in one task.
    """
    if order is None:
        order = [
            F.desc_nulls_last("total_amount"),
            F.desc_nulls_last("fare_amount"),
            F.asc_nulls_last("VendorID"),
            F.asc_nulls_last("payment_type"),
            F.asc_nulls_last("passenger_count"),
        ]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def clean(trips: DataFrame) -> DataFrame:
    """Complete, plausible trips without full-row copies, with their duration.

    The plausibility test reads only contract columns, so it may run before the copies are
    removed: rows that would be dropped are never shuffled. Derived columns are added after
    the shuffle for the same reason.
    """
    return add_duration(drop_copies(keep_plausible(drop_incomplete(trips))))


def clean_by_key(trips: DataFrame) -> DataFrame:
    """The same, with one trip per key instead of one per full row."""
    return add_duration(drop_copies_by_key(keep_plausible(drop_incomplete(trips))))
