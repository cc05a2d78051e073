"""Folds and bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOLDS, HELD_OUT = 3, 1


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fold that nothing is learned from; false for a null id."""
    fold = F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def per_label(labelled: DataFrame, rows: int) -> DataFrame:
    """``rows`` rows (doc_id, label) of each label, chosen by the hash of the id.

    Rows without id or label are left out, repeated rows count once; of rows that repeat an id
    with different labels any one counts. Up to 1,000 ``rows`` Spark cuts a label to that many
    in each task before it ranks them; beyond, all ids of a label are ranked in one task.
    """
    known = labelled.filter("doc_id is not null and label is not null").select("doc_id", "label")
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    ranked = known.dropDuplicates(["doc_id"]).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= rows).select("doc_id", "label")
