"""Reading run metrics and resource logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fields of a run-metrics document. ``run_id`` is ours; documents without it
# are told apart by their file. Fields that only some runs record are null elsewhere.
METRICS_SCHEMA = (
    "run_id string, framework string, hostname string, platform string, spark_version string, "
    "master string, default_parallelism bigint, shuffle_partitions bigint, input_rows bigint, "
    "cleaned_rows bigint, joined_rows bigint, agg_rows bigint, phases map<string, double>"
)


_FIELDS = [f.split(" ")[0] for f in METRICS_SCHEMA.replace("map<string, double>", "map").split(", ")]
_OBJECT = "map<string, string>"


def read_run_metrics(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Read metrics documents: one per line, or one spread over the lines of each file.

    A file whose first line that is not blank is a whole document has one on every line, any
    other file is one document; blank files hold none. Files are read line by line, so a large
    one of many documents is split between tasks, and only the lines of a file that is one
    document are put together. Fields beyond METRICS_SCHEMA are kept as text in ``extra``. A
    document that cannot be read is an error, whichever columns are asked for.
    """
    lines = spark.read.text(paths).select(
        "value", "_metadata.file_path", F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("at")
    )
    lines = lines.filter(F.trim(F.regexp_replace("value", r"\s", " ")) != "")
    first = lines.groupBy("file_path").agg(F.min_by("value", "at").alias("first"))
    layout = first.select(F.col("file_path").alias("file"), F.from_json("first", _OBJECT).isNotNull().alias("by_line"))
    known = lines.join(layout, F.col("file_path") == F.col("file"))
    ordered = F.array_sort(F.collect_list(F.struct("at", "value")))
    spread = known.filter("not by_line").groupBy("file_path").agg(
        F.array_join(F.transform(ordered, lambda x: x["value"]), "\n").alias("doc")
    )
    # Told by both sides of the join, so that the test of documents below stays above it: before
    # it, lines of other files would be taken for malformed documents.
    line = F.when(F.col("by_line"), F.col("value")).alias("doc")
    docs = known.filter("by_line").select("file_path", line).unionByName(spread)
    docs = docs.withColumns({"fields": F.from_json("doc", _OBJECT), "read": F.from_json("doc", METRICS_SCHEMA)})
    stop = F.raise_error(F.concat(F.lit("malformed metrics document in "), "file_path")).cast("boolean")
    return docs.filter(F.when(F.col("fields").isNull(), stop).otherwise(True)).select(
        F.coalesce("read.run_id", "file_path").alias("run_id"),
        *[F.col(f"read.{name}").alias(name) for name in _FIELDS if name != "run_id"],
        F.map_filter("fields", lambda k, _: ~k.isin(_FIELDS)).alias("extra"),
    )


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, path): the lines of log files and the file each comes from, as it is named."""
    named = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    return spark.read.text(path).select("value", named.alias("path"))
