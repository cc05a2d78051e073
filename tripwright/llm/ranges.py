"""Dealing rows out in the order of a whole number, with bounds that are known beforehand."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounds(df: DataFrame, column: str, parts: int) -> list[float]:
    """Inner bounds of ``parts`` ranges that hold about as many rows each.

    Only the one column is read; what comes to the driver is a fixed-size summary.
    """
    shares = [k / parts for k in range(1, parts)]
    found = df.select(F.col(column).cast("double").alias("x")).approxQuantile("x", shares, 0.1 / parts) if shares else []
    return sorted(set(found))


def with_range(df: DataFrame, column: str, name: str, inner: list[float]) -> DataFrame:
    """Adds ``name``: the number of the range, ascending; nulls are in a range before the first."""
    if not inner:
        return df.withColumn(name, F.when(F.col(column).isNull(), -1).otherwise(0).cast("long"))
    number = Bucketizer(
        splits=[float("-inf"), *inner, float("inf")], inputCol="_place", outputCol="_range", handleInvalid="keep"
    )
    ranged = number.transform(df.withColumn("_place", F.col(column).cast("double")))
    at = F.when(F.col("_place").isNull(), -1).otherwise(F.col("_range").cast("long"))
    return ranged.withColumn(name, at.cast("long")).drop("_place", "_range")


def dealt(df: DataFrame, column: str, name: str, parts: int) -> DataFrame:
    """Rows with their range, each range in a partition of its own."""
    return apart(with_range(df, column, name, bounds(df, column, parts)), name, parts)


def apart(df: DataFrame, name: str, parts: int) -> DataFrame:
    """Each of ``parts`` ranges, and that of nulls, in a partition of its own."""
    return df.repartitionById(parts + 1, (F.col(name) + 1).cast("int"))
