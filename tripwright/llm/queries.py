"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.llm import chat, langid, mixing, quality, tokenids
from tripwright.llm.decontaminate import DECONTAMINATE_SQL, find_passages
from tripwright.llm.divergence import DIVERGENCE_SQL, audit_sources
from tripwright.llm.jaccard import jaccard_join
from tripwright.llm.licenses import LICENSE_SQL, scan_licenses
from tripwright.llm.linededup import LINE_DEDUP_SQL, drop_shared_lines
from tripwright.llm.merkle import fingerprint_documents
from tripwright.llm.ranking import RANK_SQL, rank_documents
from tripwright.llm.sample import held_out
from tripwright.llm.tables import table, written
from tripwright.llm.vectors import NEAR_VECTORS_SQL, near_vectors


def op1_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    segments = written(tokenids.encode_documents(table(spark, folder, "documents")), "segments")
    return tokenids.describe(segments)


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs, langid.train(docs))


def op3_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_documents(table(spark, folder, "documents"))


def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return quality.score_quality(docs, quality.train(docs, labels))


def op5_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    joined = jaccard_join(table(spark, folder, "documents").select("doc_id", "text"))
    return joined.select("doc_id", "n_shingles", "component_id", "n_links")


def op6_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source")
    mixed = mixing.mix(docs, mixing.targets(docs))
    return mixed.select("row.doc_id", "source", "mix_block", "mix_slot", "mix_place")


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = drop_shared_lines(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op10_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    parsed = chat.parse_roles(turns, chat.train(turns))
    return parsed.select("conv_id", "turn", held_out("conv_id").alias("held_out"), "role_pred", "rendered")


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return rank_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return audit_sources(table(spark, folder, "documents"))


def op13_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))


QUERIES = [
    op1_token_ids,
    op2_language_id,
    op3_document_fingerprints,
    op4_quality_classifier,
    op5_ngram_jaccard_join,
    op6_mix_sources,
    op7_license_scan,
    op8_benchmark_decontamination,
    op9_line_dedup,
    op10_chat_formatting,
    op11_ranked_search,
    op12_source_divergence,
    op13_embedding_near_dedup,
]
REGISTRY = {query.__name__: query for query in QUERIES}
ORACLE_SQL: dict[str, str] = {
    "op6_mix_sources": mixing.MIX_SQL,
    "op7_license_scan": LICENSE_SQL,
    "op8_benchmark_decontamination": DECONTAMINATE_SQL,
    "op9_line_dedup": LINE_DEDUP_SQL,
    "op11_ranked_search": RANK_SQL,
    "op12_source_divergence": DIVERGENCE_SQL,
    "op13_embedding_near_dedup": NEAR_VECTORS_SQL,
}
