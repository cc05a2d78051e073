"""Plans as text."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def formatted(df: DataFrame) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def final(df: DataFrame) -> str:
    """The plan as it was after adaptive execution."""
    df.collect()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue().split("== Initial Plan ==")[0]
