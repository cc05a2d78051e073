"""Average speed in miles per hour, in three forms that give equal values.

``speed_mph`` is the one to use: it stays in generated JVM code. The two Python forms exist
to measure what leaving the JVM costs, row by row and in Arrow batches. Both build their
function locally so that it is shipped by value and executors need not import this package.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_HOUR = 3600.0


def speed_mph(miles: Column, seconds: Column) -> Column:
    """miles / (seconds / 3600), or null where the duration is null or not positive."""
    # The guard comes first: ANSI mode raises on division by zero.
    return F.when(seconds > 0, miles / (seconds / F.lit(SECONDS_PER_HOUR)))


def speed_mph_by_row(miles: Column, seconds: Column) -> Column:
    """The same value from a Python function called once per row."""
    per_hour = SECONDS_PER_HOUR

    def one(distance, duration):
        if distance is None or duration is None or not duration > 0:
            return None
        return distance / (duration / per_hour)

    # useArrow is set so that a session-wide default cannot turn this into the batched form.
    return F.udf(one, "double", useArrow=False)(miles, seconds)


def speed_mph_by_batch(miles: Column, seconds: Column) -> Column:
    """The same value from a vectorised Python function called once per Arrow batch."""
    per_hour = SECONDS_PER_HOUR

    def many(distance: pd.Series, duration: pd.Series) -> pd.Series:
        return distance / (duration.where(duration > 0) / per_hour)

    return F.pandas_udf(many, "double")(miles, seconds)
