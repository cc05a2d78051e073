"""Time expressions. All of them expect the session time zone to be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two timestamps, each side floored to its epoch second first.

    Flooring the sides (rather than truncating the difference) makes 00.9 -> 01.1 one second.
    """
    return F.unix_seconds(end) - F.unix_seconds(start)


def hour_of_day(moment: Column) -> Column:
    return F.hour(moment)
