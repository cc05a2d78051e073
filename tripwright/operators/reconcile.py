"""Comparing two speed summaries, or two row funnels, key by key.

Every check is a table and all of them are always evaluated; none depends on another.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwright.contract import GROUP_KEYS, SUMMARY_COLUMNS

# Fixed value: means may differ by this much, inclusive, and still agree.
SPEED_TOLERANCE = 0.01

# Group states in order of precedence.
MISSING_LEFT = "missing_left"
MISSING_RIGHT = "missing_right"
COUNT_DIFF = "count_diff"
MEAN_DIFF = "mean_diff"
OK = "ok"
STATES = (MISSING_LEFT, MISSING_RIGHT, COUNT_DIFF, MEAN_DIFF, OK)


def compared_columns(
    df: DataFrame, side: str, columns: Sequence[str] = SUMMARY_COLUMNS
) -> DataFrame:
    """Only the compared columns; raises if one is missing."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"{side} summary lacks columns {absent}")
    return df.select(*columns)


def schema_check(
    left: DataFrame, right: DataFrame, columns: Sequence[str] = SUMMARY_COLUMNS
) -> DataFrame:
    """Per compared column: whether each side has it and how many of its rows fill it."""

    def filled(df: DataFrame, side: str) -> DataFrame:
        held = [c for c in columns if c in df.columns]
        counts = df.agg(*[F.count(c).alias(c) for c in held])
        cells = [
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(c in held).alias(f"in_{side}"),
                (F.col(c) if c in held else F.lit(0).cast("bigint")).alias(f"{side}_filled"),
            )
            for c in columns
        ]
        return counts.select(F.inline(F.array(*cells)))

    both = filled(left, "left").join(filled(right, "right"), "column_name")
    return both.select("column_name", "in_left", "in_right", "left_filled", "right_filled")


def match_groups(
    left: DataFrame, right: DataFrame, keys: Sequence[str] = GROUP_KEYS
) -> DataFrame:
    """Both sides of every group, matched with nulls equal; absent sides are null.

    The keys are the grouping keys of both sides, so each occurs once per side.
    """
    a = compared_columns(left, "left").withColumn("_here", F.lit(True)).alias("a")
    b = compared_columns(right, "right").withColumn("_here", F.lit(True)).alias("b")
    on = reduce(Column.__and__, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    return a.join(b, on, "full").select(
        *[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys],
        F.col("a._here").isNotNull().alias("in_left"),
        F.col("b._here").isNotNull().alias("in_right"),
        F.col("a.trip_count").alias("left_count"),
        F.col("b.trip_count").alias("right_count"),
        F.col("a.mean_speed_mph").alias("left_mean"),
        F.col("b.mean_speed_mph").alias("right_mean"),
    )


def _usable(mean: Column) -> Column:
    return mean.isNotNull() & ~F.isnan(mean)


def _means_agree(left: Column, right: Column, tolerance: float) -> Column:
    # With a NaN or null on either side the means agree only if both sides hold the same.
    return F.when(_usable(left) & _usable(right), F.abs(left - right) <= tolerance).otherwise(
        left.eqNullSafe(right)
    )


def compare_groups(
    left: DataFrame, right: DataFrame, tolerance: float = SPEED_TOLERANCE
) -> DataFrame:
    """Per group: both counts, both means, the absolute difference and a state."""
    lm, rm = F.col("left_mean"), F.col("right_mean")
    state = (
        F.when(~F.col("in_left"), MISSING_LEFT)
        .when(~F.col("in_right"), MISSING_RIGHT)
        .when(~F.col("left_count").eqNullSafe(F.col("right_count")), COUNT_DIFF)
        .when(~_means_agree(lm, rm, tolerance), MEAN_DIFF)
        .otherwise(OK)
    )
    return (
        match_groups(left, right)
        .withColumns({"mean_diff": F.abs(lm - rm), "status": state})
        .drop("in_left", "in_right")
    )


def summarise_groups(compared: DataFrame, tolerance: float = SPEED_TOLERANCE) -> DataFrame:
    """One row: groups in each state, differing counts, largest and out-of-tolerance means."""
    diff = F.col("mean_diff")
    both = ~F.col("status").isin(MISSING_LEFT, MISSING_RIGHT)
    agree = _means_agree(F.col("left_mean"), F.col("right_mean"), tolerance)
    return compared.agg(
        F.count("*").alias("group_count"),
        *[F.count_if(F.col("status") == s).alias(f"{s}_groups") for s in STATES],
        F.count_if(both & ~F.col("left_count").eqNullSafe(F.col("right_count"))).alias(
            "differing_counts"
        ),
        F.count_if(both & ~agree).alias("means_out_of_tolerance"),
        F.max(F.when(_usable(diff), diff)).alias("largest_mean_diff"),
    )


def key_difference(
    left: DataFrame, right: DataFrame, keys: Sequence[str] = GROUP_KEYS
) -> DataFrame:
    """Keys found on one side only, with the side; nulls count as equal."""
    # Distinct keys per side, so that neither an order nor a repeat of the input matters.
    tagged = (
        left.select(*keys)
        .distinct()
        .withColumn("from_left", F.lit(True))
        .unionByName(right.select(*keys).distinct().withColumn("from_left", F.lit(False)))
    )
    sides = tagged.groupBy(*keys).agg(
        F.bool_or("from_left").alias("in_left"), F.bool_or(~F.col("from_left")).alias("in_right")
    )
    return sides.filter(F.col("in_left") != F.col("in_right")).select(
        F.when(F.col("in_left"), "left").otherwise("right").alias("side"), *keys
    )


def repeated_keys(left: DataFrame, right: DataFrame, keys: Sequence[str] = GROUP_KEYS) -> DataFrame:
    """Keys that occur more than once on a side, with the side and how often."""

    def of(df: DataFrame, side: str) -> DataFrame:
        often = df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")
        return often.select(F.lit(side).alias("side"), *keys, "copies")

    return of(left, "left").unionByName(of(right, "right"))


def compare_row_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Per stage: the rows of both funnels and whether they are equal."""
    a, b = left.alias("a"), right.alias("b")
    return a.join(b, F.col("a.stage").eqNullSafe(F.col("b.stage")), "full").select(
        F.coalesce("a.stage", "b.stage").alias("stage"),
        F.col("a.row_count").alias("left_rows"),
        F.col("b.row_count").alias("right_rows"),
        F.col("a.row_count").eqNullSafe(F.col("b.row_count")).alias("is_equal"),
    )


# The checks of a report, in its order.
CHECKS = ("row_counts", "columns_present", "repeated_keys", "group_counts", "group_keys", "trip_counts", "mean_speeds")


def _listed(totals: DataFrame, names: Sequence[str]) -> DataFrame:
    """(check, failures, ok): a row per check out of one row with a column per check."""
    cells = [F.struct(F.lit(n).alias("check"), F.col(n).cast("bigint").alias("failures")) for n in names]
    return totals.select(F.inline(F.array(*cells))).withColumn("ok", F.col("failures") == 0)


def _group_checks(per_key: DataFrame, tolerance: float) -> dict[str, Column]:
    """Failures per check over one row per key with rows, count and mean of either side."""
    left, right = F.col("left_copies"), F.col("right_copies")
    both = (left > 0) & (right > 0)
    agree = _means_agree(F.col("left_mean"), F.col("right_mean"), tolerance)
    rows = F.coalesce(F.sum(left), F.lit(0)) - F.coalesce(F.sum(right), F.lit(0))
    return {
        "repeated_keys": F.count_if(left > 1) + F.count_if(right > 1),
        "group_counts": F.abs(rows),
        "group_keys": F.count_if((left == 0) != (right == 0)),
        "trip_counts": F.count_if(both & ~F.col("left_count").eqNullSafe(F.col("right_count"))),
        "mean_speeds": F.count_if(both & ~agree),
    }


def report(
    left: DataFrame,
    right: DataFrame,
    left_funnel: DataFrame | None = None,
    right_funnel: DataFrame | None = None,
    tolerance: float = SPEED_TOLERANCE,
) -> DataFrame:
    """One row per check (check, failures, ok) over two summaries and, if given, two funnels.

    Both summaries go into one table with the side as a column, one aggregation by key puts
    the sides next to each other, and every check is an aggregate of that. A key that occurs
    more than once on a side is a failure of its own and elsewhere counts with its largest
    values. A column missing on one side fails its own check and is null elsewhere.
    """
    types = {
        **dict.fromkeys(SUMMARY_COLUMNS, T.StringType()),
        "pickup_hour": T.IntegerType(),
        "mean_speed_mph": T.DoubleType(),
        "trip_count": T.LongType(),
    }

    def sided(df: DataFrame, is_right: bool) -> DataFrame:
        held = [F.col(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in SUMMARY_COLUMNS]
        return df.select(*held, F.lit(is_right).alias("_right"))

    right_side = F.col("_right")
    of = {"left": ~right_side, "right": right_side}
    sides = []
    for side, here in of.items():
        sides += [
            F.count_if(here).alias(f"{side}_copies"),
            F.max(F.when(here, F.col("trip_count"))).alias(f"{side}_count"),
            F.max(F.when(here, F.col("mean_speed_mph"))).alias(f"{side}_mean"),
        ]
    per_key = sided(left, False).unionByName(sided(right, True)).groupBy(*GROUP_KEYS).agg(*sides)
    absent = sum(c not in left.columns or c not in right.columns for c in SUMMARY_COLUMNS)
    failures = {"columns_present": F.lit(absent)} | _group_checks(per_key, tolerance)
    checks = _listed(per_key.agg(*[v.alias(k) for k, v in failures.items()]), CHECKS[1:])
    if left_funnel is None or right_funnel is None:
        return checks
    rows = compare_row_counts(left_funnel, right_funnel).agg(
        F.count_if(~F.col("is_equal")).alias(CHECKS[0])
    )
    return _listed(rows, CHECKS[:1]).unionByName(checks)


def speed_cells(timed: DataFrame) -> DataFrame:
    """(pickup_hour, PULocationID, n, speeds, miles_an_hour): what checks need of cleaned trips.

    A row per hour and pickup zone, with the number of trips, of speeds, and their sum.
    """
    return timed.groupBy("pickup_hour", "PULocationID").agg(
        F.count("*").alias("n"),
        F.count("avg_speed_mph").alias("speeds"),
        F.sum("avg_speed_mph").alias("miles_an_hour"),
    )


def report_on_cells(
    cells: dict[str, DataFrame],
    inputs: DataFrame,
    zones: DataFrame,
    named_only: dict[str, bool],
    small_zones: bool,
    tolerance: float = SPEED_TOLERANCE,
) -> DataFrame:
    """The report on two ways of cleaning, straight from the ``speed_cells`` of either side.

    ``cells`` and ``named_only`` have the sides "left" and "right"; ``inputs`` is one row with
    the rows that went in, left_input and right_input. Cells of both sides meet their zones
    together: a zone key that occurs several times repeats its cells, and a side that wants
    named zones only drops the others. What is cleaned once is also read once: the counts of
    all stages and every check come from the one table of keys.
    """
    tagged = reduce(
        DataFrame.unionByName, [df.withColumn("side", F.lit(side)) for side, df in cells.items()]
    )
    by_key = zones.groupBy("LocationID").agg(F.collect_list(F.struct("Borough")).alias("found"))
    met = tagged.join(
        F.broadcast(by_key) if small_zones else by_key, F.col("PULocationID") == F.col("LocationID"), "left"
    )
    spelled = met.select("*", F.posexplode_outer("found").alias("at", "zone"))
    is_side = {side: F.col("side") == side for side in cells}
    per_side = []
    for side, here in is_side.items():
        kept = here & F.col("at").isNotNull()
        if named_only[side]:
            kept = kept & F.col("zone.Borough").isNotNull()

        def total(column: str, where: Column = kept) -> Column:
            return F.sum(F.when(where, F.col(column)))

        first = here & (F.coalesce("at", F.lit(0)) == 0)
        per_side += [
            F.count_if(kept).alias(f"{side}_cells"),
            F.coalesce(total("n", first), F.lit(0)).alias(f"{side}_cleaned"),
            F.coalesce(total("n"), F.lit(0)).alias(f"{side}_count"),
            F.try_divide(total("miles_an_hour"), total("speeds")).alias(f"{side}_mean"),
        ]
    keys = [F.col("pickup_hour"), F.col("zone.Borough").alias("Borough"), F.col("at").isNotNull().alias("met")]
    per_key = spelled.groupBy(*keys).agg(*per_side)
    per_key = per_key.withColumns({f"{s}_copies": (F.col(f"{s}_cells") > 0).cast("int") for s in cells})

    def differ(stage: str) -> Column:
        return F.sum(f"left_{stage}") != F.sum(f"right_{stage}")

    failures = {"columns_present": F.lit(0)} | _group_checks(per_key, tolerance)
    stages = [differ(s) for s in ("cleaned", "count", "copies")]
    failures["later_counts"] = sum((F.coalesce(d, F.lit(False)).cast("int") for d in stages), F.lit(0))
    totals = per_key.agg(*[v.alias(k) for k, v in failures.items()]).crossJoin(inputs)
    first_differs = (F.col("left_input") != F.col("right_input")).cast("int")
    return _listed(totals.withColumn("row_counts", F.col("later_counts") + first_differs), CHECKS)
