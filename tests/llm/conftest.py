from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) pairs, or (doc_id, text, lang, source)."""

    def make(rows, extra: dict | None = None):
        full = [(*r, *[None, "s"][len(r) - 2 :]) if len(r) < 4 else r for r in rows]
        df = spark.createDataFrame([(*r[:4], len(r[1] or "")) for r in full], DOCS)
        for name, value in (extra or {}).items():
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit(value))
        return df

    return make


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}
