"""Trips, zones and run metrics derived from the test tables.

The tables hold no nulls and no repeated rows, so the derivation adds what cleaning has to
deal with: nulls, exact copies, refunds under the same key, zones without a match, a zone
without a borough, and durations of zero and beyond the limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The tables every test folder holds.
TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a trip; every tenth is there twice and some have a refund beside them.

    One scan yields them all: an event expands to one row per sign of its amounts. The
    number parsed from its properties travels with the sign, since what an expansion yields
    is worked out once, where a plain column would be parsed anew in every later filter.
    """
    k = "try_cast(get_json_object(props, '$.k') as int) as k"
    once, refund = f"struct(1 as sign, {k})", f"struct(-1 as sign, {k})"
    events = table(spark, folder, "events").selectExpr(
        "cast(ts as timestamp) as pickup",
        "timestamp_micros(unix_micros(cast(ts as timestamp))"
        " + cast(floor(value * 60000000) as bigint)) as dropoff",
        "user_id",
        "event_type",
        "value",
        f"""inline(case when event_id % 10 = 0 then array({once}, {once})
                       when event_id % 20 = 5 then array({once}, {refund})
                       else array({once}) end)""",
    )
    # A refund is a difference, not a product, so that nothing is not a negative zero.
    return events.selectExpr(
        "1 + user_id % 2 as VendorID",
        "if(k = 7, null, pickup) as tpep_pickup_datetime",
        "dropoff as tpep_dropoff_datetime",
        "cast(if(k % 5 = 0, null, 1 + k % 5) as double) as passenger_count",
        "cast(if(k = 13, null, k) as double) as trip_distance",
        "user_id % 30 as PULocationID",
        "if(k = 17, null, user_id % 25) as DOLocationID",
        "cast(length(event_type) as bigint) as payment_type",
        "if(sign > 0, value, 0D - value) as fare_amount",
        "if(sign > 0, value + 1D, 0D - (value + 1D)) as total_amount",
    )


def zones(spark: SparkSession, folder: str) -> DataFrame:
    """Every nation as a zone of its region; nation 24 has no borough."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).selectExpr(
        "cast(n_nationkey as bigint) as LocationID",
        "if(n_nationkey = 24, null, r_name) as Borough",
        "n_name as Zone",
    )


def run_documents(spark: SparkSession, folder: str) -> DataFrame:
    """A metrics document per user: seconds per event type, and over all of them as the total.

    ``total_s`` includes 2.5 seconds that belong to no phase, as session start would be.
    """
    per_phase = (
        table(spark, folder, "events")
        .groupBy("user_id", "event_type")
        .agg(F.sum("value").alias("seconds"), F.count("*").alias("events"))
    )
    per_user = per_phase.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("event_type", "seconds"))).alias("parts"),
        F.sum("seconds").alias("seconds"),
        F.sum("events").alias("input_rows"),
    )
    total = F.create_map(F.lit("total_s"), F.col("seconds") + 2.5)
    return per_user.select(
        F.format_string("run-%d", "user_id").alias("run_id"),
        variant().alias("framework"),
        "input_rows",
        F.map_concat("parts", total).alias("phases"),
    )


def variant() -> Column:
    return F.when(F.col("user_id") % 2 == 0, "left").otherwise("right")


def phase_seconds(spark: SparkSession, folder: str) -> DataFrame:
    """(variant, phase, seconds): every event as a timing of its own type and of the total."""
    return table(spark, folder, "events").select(
        variant().alias("variant"),
        F.explode(F.array("event_type", F.lit("total_s"))).alias("phase"),
        F.col("value").alias("seconds"),
    )


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(log, value): every event as one sampled line of the log named after its type."""
    load = F.round(F.pmod(F.col("value"), F.lit(100.0)), 1)
    line = F.format_string(
        "[%s+00:00] %%Cpu(s): %.1f us, 0.0 sy, 0.0 ni, %.1f id, 0.0 wa, 0.0 hi, 0.0 si, 0.0 st"
        " | mem_used_mb=%d mem_total_mb=%d",
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss"),
        load,
        F.round(100.0 - load, 1),
        1000 + F.col("user_id"),
        F.lit(64000),
    )
    return table(spark, folder, "events").select(
        F.format_string("top_%s.log", "event_type").alias("log"), line.alias("value")
    )
