"""From raw documents to token segments: the stages, and all of them in a row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripwright.llm import mixing, quality
from tripwright.llm.decontaminate import without_passages
from tripwright.llm.jaccard import one_of_each
from tripwright.llm.tables import table, written
from tripwright.llm.tokenids import encode_as_filed

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return quality.keep_good(docs, quality.train(docs.select("doc_id", "text"), labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id."""
    return one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return without_passages(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that interleaves sources by the roots of their sizes."""
    return mixing.in_order(docs, mixing.targets(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Segments of token ids, in the order of the mixture."""
    return encode_as_filed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good_quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("mixing_sources", mixed),
    ("token_ids", token_ids),
]

#: SQL states neither fitted models nor coded bytes, so there is none for run().
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
