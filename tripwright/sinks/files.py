"""Writers. The row writers replace what is there unless told otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripwright.operators.summarise import export_rows, in_key_order


def write_rows(enriched: DataFrame, path: str, append: bool = False) -> None:
    """Write enriched trips. Appending keeps earlier files, also those of an earlier run."""
    export_rows(enriched).write.mode("append" if append else "overwrite").parquet(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """Write the speed summary as one sorted file.

    It holds at most a few hundred rows, and the sort's own shuffle keeps the aggregation
    before it parallel: only finished groups meet in the single writer.
    """
    in_key_order(summary).coalesce(1).write.mode("overwrite").parquet(path)


def write_run_metrics(metrics: DataFrame, path: str) -> None:
    """Append metrics documents, one per line."""
    metrics.write.mode("append").json(path)


def write_comparison(comparison: DataFrame, path: str) -> None:
    """Write a comparison of runs (one row per phase) as one CSV file with a header."""
    comparison.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
