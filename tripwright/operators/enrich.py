"""Joining trips to the zone dimension and adding speed and hour."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripwright.functions.speed import speed_mph
from tripwright.functions.time import hour_of_day

# A dimension whose measured size is above this is joined by a shuffle, not a broadcast.
BROADCAST_LIMIT_BYTES = 64 << 20
# Rough cost of one broadcast row besides its text: key, lengths, hash entry.
ROW_OVERHEAD_BYTES = 64
# Salted keys wanted per shuffle partition, so that each task gets a fair share.
KEYS_PER_PARTITION = 4
# Most pickup zones the sketch of hot ones tells apart; Spark's function allows a million.
SKETCHED_ZONES = 1_000_000

# What a join does with the trips that pass it: (rows, one row of each trip) -> the same rows.
Tell = Callable[[DataFrame, Column], DataFrame]


def zone_columns(zones: DataFrame) -> DataFrame:
    """Only the zone columns in use; anything else the dimension carries stays behind."""
    return zones.select("LocationID", "Borough", "Zone")


def measure_zones(zones: DataFrame) -> Row:
    """Approximate bytes, number of keys, and a key that several zones have, in one small job.

    Null keys match nothing: they count neither as keys nor as repeated.
    """
    text = [F.coalesce(F.octet_length(c), F.lit(0)) for c in ("Borough", "Zone")]
    per_key = zones.groupBy("LocationID").agg(
        F.sum(sum(text, F.lit(ROW_OVERHEAD_BYTES))).alias("bytes"), F.count("*").alias("copies")
    )
    return per_key.agg(
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.count("LocationID").alias("keys"),
        F.max(F.when(F.col("copies") > 1, F.col("LocationID"))).alias("repeated"),
    ).head()


def refuse_repeated(facts: Row) -> None:
    if facts.repeated is not None:
        raise ValueError(f"zone key {facts.repeated} occurs more than once")


def join_zone(
    trips: DataFrame,
    zones: DataFrame,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    facts: Row | None = None,
    like: DataFrame | None = None,
    tell: Tell | None = None,
) -> DataFrame:
    """Inner join on the pickup zone. A repeated zone key multiplies rows.

    The zones are measured first. Up to the limit they are broadcast, so the trips stay where
    they are; beyond it both sides are shuffled and merged. The side is named outright
    because an estimate of a derived table can be far enough off to have the trips broadcast
    instead. ``like`` is described at ``hot_zones``, ``tell`` at ``join_zone_merge``; a
    broadcast does without the first and calls the second before the join.
    """
    size = measure_zones(zones) if facts is None else facts
    if size.bytes > broadcast_limit:
        return join_zone_merge(trips, zones, like=like, tell=tell, facts=size)
    if tell is not None:
        trips = tell(trips, F.lit(True))
    dim = zone_columns(zones)
    on = trips["PULocationID"] == dim["LocationID"]
    return trips.join(F.broadcast(dim), on).drop(dim["LocationID"])


def salts_for(keys: float, partitions: int) -> int:
    """How many ways to split each of ``keys`` equal shares of the rows, so that the shuffle
    has keys for all its partitions."""
    return max(1, math.ceil(partitions * KEYS_PER_PARTITION / max(keys, 1)))


def hot_zones(like: DataFrame, partitions: int) -> dict[int, int]:
    """The pickup zones that hold more than a shuffle partition's share, with their parts.

    A heavy-hitter sketch of the one column tells them. Every map task passes on one sketch,
    those are combined in groups and the groups' in one task, so that none gets a sketch
    from each map task. At most ``partitions`` zones can hold so much: that many rows come
    to the driver at most, and the sketch, four times as wide, cannot miss one of them (up to
    250,000 partitions; beyond that, the largest zones). Its counts are close, not exact:
    that bears on the split only. ``like`` are any rows with about the same pickup zones as
    the trips to be joined, such as the trips before they were cleaned, of which only that
    column is read.
    """
    kept = min(partitions, SKETCHED_ZONES // 4)
    groups = math.isqrt(partitions) + 1
    sketches = (
        like.filter(F.col("PULocationID").isNotNull())
        .groupBy((F.spark_partition_id() % groups).alias("group"))
        .agg(
            F.count("*").alias("rows"),
            F.expr(f"approx_top_k_accumulate(PULocationID, {4 * kept})").alias("sketch"),
        )
    )
    # Grouped by nothing in particular: there is no combining no sketches.
    found = sketches.groupBy(F.lit("all").alias("group")).agg(
        F.sum("rows").alias("rows"),
        F.expr(f"approx_top_k_combine(sketch, {4 * kept})").alias("sketch"),
    )
    top = found.select("rows", F.expr(f"approx_top_k_estimate(sketch, {kept})").alias("top"))
    shares = top.select("rows", F.inline("top").alias("zone", "n")).collect()
    parts = {r.zone: salts_for(r.rows / r.n, partitions) for r in shares if r.n * partitions > r.rows}
    return {zone: n for zone, n in parts.items() if n > 1}


def _with_parts(df: DataFrame, key: Column, hot: dict[int, int]) -> DataFrame:
    """Add ``_parts``, the number of parts of a row's zone: one, unless the zone is hot."""
    if not hot:
        return df.withColumn("_parts", F.lit(1))
    table = df.sparkSession.createDataFrame(list(hot.items()), "_zone bigint, _n int")
    joined = df.join(F.broadcast(table), key == table["_zone"], "left")
    return joined.withColumn("_parts", F.coalesce("_n", F.lit(1))).drop("_zone", "_n")


def join_zone_merge(
    trips: DataFrame,
    zones: DataFrame,
    salts: int | None = None,
    like: DataFrame | None = None,
    tell: Tell | None = None,
    facts: Row | None = None,
) -> DataFrame:
    """The rows of ``join_zone`` from a shuffle and merge, for a dimension of any size.

    A popular zone would land in one task, so hot zones (``hot_zones``, told from ``like`` or
    else from the trips themselves) are split into as many parts as their share of the rows
    calls for, and only those zones are repeated, once per part. All others keep one part,
    so that a dimension of millions of zones is shuffled as it is; where there are few
    zones, all are hot and the split gives every shuffle partition its share. A trip's part
    comes from a hash of its values and of the partition it is in: copies of one trip spread
    as well, and a task that is run again sends every trip to the same part as before, which
    a random number would not. What skew is left, Spark's adaptive skew join splits.
    ``salts`` sets one number of parts for all zones instead.

    ``tell`` gets the trips behind the join, where no shuffle need follow, and a condition
    that holds for one row of each trip, matched or not. That lets a counter see every trip
    exactly once although a match on a repeated key multiplies it: the join is an outer one
    then, and trips without a zone are dropped behind the counter. ``facts`` of the zones
    spare a unique key the numbering of its copies.
    """
    dim = zone_columns(zones).filter(F.col("LocationID").isNotNull())
    if tell is not None:
        unique = facts is not None and facts.repeated is None
        copies = Window.partitionBy("LocationID").orderBy(F.lit(0))
        dim = dim.withColumn("_copy", F.lit(1) if unique else F.row_number().over(copies))
    if salts is not None:
        left, right = (df.withColumn("_parts", F.lit(salts)) for df in (trips, dim))
    else:
        partitions = int(trips.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        hot = hot_zones(trips if like is None else like, partitions)
        left = _with_parts(trips, trips["PULocationID"], hot)
        right = _with_parts(dim, dim["LocationID"], hot)
    spread = F.xxhash64(*(left[c] for c in trips.columns), F.spark_partition_id())
    left = left.withColumn("_part", F.pmod(spread, F.col("_parts")).cast("int"))
    right = right.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    on = (left["PULocationID"] == right["LocationID"]) & (left["_part"] == right["_part"])
    joined = left.join(right.hint("merge"), on, "inner" if tell is None else "left")
    own = [left[c] for c in trips.columns]
    if tell is None:
        return joined.select(*own, right["Borough"], right["Zone"])
    marks = [right["LocationID"].alias("_matched"), right["_copy"]]
    seen = tell(
        joined.select(*own, right["Borough"], right["Zone"], *marks),
        F.coalesce(F.col("_copy"), F.lit(1)) == 1,
    )
    return seen.filter(F.col("_matched").isNotNull()).drop("_matched", "_copy")


def look_up_zone(
    trips: DataFrame,
    zones: DataFrame,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    facts: Row | None = None,
    like: DataFrame | None = None,
    tell: Tell | None = None,
) -> DataFrame:
    """Add Borough and Zone by pickup zone; drop trips whose borough is unknown or null.

    The zone key has to be unique; that is checked before anything is joined. The other
    arguments are those of ``join_zone``; ``facts`` are of all the zones given.
    """
    size = measure_zones(zones) if facts is None else facts
    refuse_repeated(size)
    named = zones.filter(F.col("Borough").isNotNull())
    return join_zone(trips, named, broadcast_limit, size, like, tell)


def add_speed(
    df: DataFrame, form: Callable[[Column, Column], Column] = speed_mph
) -> DataFrame:
    return df.withColumn("avg_speed_mph", form(F.col("trip_distance"), F.col("trip_duration_s")))


def add_hour(df: DataFrame) -> DataFrame:
    return df.withColumn("pickup_hour", hour_of_day(F.col("pickup_ts")))
