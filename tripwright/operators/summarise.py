"""Export rows and the speed summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.contract import EXPORT_COLUMNS, GROUP_KEYS, SUMMARY_COLUMNS


def export_rows(enriched: DataFrame) -> DataFrame:
    return enriched.select(*EXPORT_COLUMNS)


def speed_by_group(enriched: DataFrame) -> DataFrame:
    """Mean speed and trip count by pickup hour and borough, in key order, nulls first."""
    return in_key_order(speed_by_group_unsorted(enriched))


def speed_by_group_unsorted(enriched: DataFrame) -> DataFrame:
    """The same in no order, for what is not shown or written.

    Trips without a speed count as trips but not towards the mean. Map tasks combine their
    rows first, so the shuffle carries one row per group and task.
    """
    _, _, mean, count = SUMMARY_COLUMNS
    return enriched.groupBy(*GROUP_KEYS).agg(
        F.avg("avg_speed_mph").alias(mean), F.count("*").alias(count)
    )


def in_key_order(summary: DataFrame) -> DataFrame:
    return summary.orderBy(*[F.asc_nulls_first(k) for k in GROUP_KEYS])
