"""How many rows survive each stage."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.contract import GROUP_KEYS
from tripwright.operators.enrich import (
    BROADCAST_LIMIT_BYTES,
    add_hour,
    measure_zones,
    refuse_repeated,
    zone_columns,
)

# Stage names, as they stand in run metrics.
STAGES = ("input_rows", "cleaned_rows", "joined_rows", "agg_rows")


def _stages(totals: DataFrame, names: Sequence[str] = STAGES) -> DataFrame:
    cells = [F.struct(F.lit(n).alias("stage"), F.col(n).alias("row_count")) for n in names]
    return totals.select(F.inline(F.array(*cells)))


def recorded_funnel(metrics: DataFrame, run_id: str | None = None) -> DataFrame:
    """(stage, row_count) as one run recorded it: the run named, else the only one there is."""
    chosen = metrics if run_id is None else metrics.filter(F.col("run_id") == run_id)
    runs = chosen.select("run_id").limit(2).collect()
    if len(runs) != 1:
        which = "runs" if run_id is None else f"runs named {run_id!r}"
        raise ValueError(f"{'no' if not runs else 'several'} {which} in the metrics")
    return _stages(chosen)


def row_funnel(
    trips: DataFrame, cleaned: DataFrame, zones: DataFrame, named_zones_only: bool = False
) -> DataFrame:
    """(stage, row_count) for input, cleaned, joined and aggregated rows.

    The cleaned trips are counted per hour and pickup zone first. Everything further down
    is worked out from those few cells, so cleaning runs once however many stages are asked
    for: both uses of the cells read one shuffle. ``named_zones_only`` leaves out zones
    without a borough and refuses a repeated zone key, as the lookup join does. The zones are
    measured before they are broadcast.
    """
    zones = zone_columns(zones)
    facts = measure_zones(zones)
    if named_zones_only:
        refuse_repeated(facts)
        zones = zones.filter(F.col("Borough").isNotNull())
    cells = add_hour(cleaned).groupBy("pickup_hour", "PULocationID").agg(F.count("*").alias("n"))
    groups = (
        cells.join(
            F.broadcast(zones) if facts.bytes <= BROADCAST_LIMIT_BYTES else zones,
            cells["PULocationID"] == zones["LocationID"],
        )
        .groupBy(*GROUP_KEYS)
        .agg(F.sum("n").alias("n"))
    )

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0).cast("bigint"))

    joined = groups.agg(total("n").alias(STAGES[2]), F.count("*").alias(STAGES[3]))
    parts = [
        _stages(trips.agg(F.count("*").alias(STAGES[0])), STAGES[:1]),
        _stages(cells.agg(total("n").alias(STAGES[1])), STAGES[1:2]),
        _stages(joined, STAGES[2:]),
    ]
    return reduce(DataFrame.unionByName, parts)
