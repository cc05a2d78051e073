"""Run metrics and resource logs as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.operators.quantiles import exact_percentiles

# The recorded phases, their display names, and the recorded total.
PHASES = {
    "ingestion_s": "Ingest",
    "cleansing_s": "Clean",
    "join_s": "Join",
    "udf_s": "UDF",
    "aggregate_s": "Aggregate",
    "export_s": "Export",
    "total_s": "Total",
}

# Fixed patterns: a sampled line is "[time] cpu text | memory text", where the texts come
# from top and free on Linux and from top on macOS.
LOG_TIME = r"^\[([^\]]+)\]"
LOG_IDLE = r"([0-9]+(?:\.[0-9]+)?)%?\s*id(?:le)?\b"
LOG_USED_MB = r"mem_used_mb=([0-9]+)"
LOG_USED_MAC = r"PhysMem:\s*([0-9]+)([KMG])\s+used"
LOG_LABEL = r"top_([^/]+?)\.log"


def phases_long(metrics: DataFrame) -> DataFrame:
    """(run_id, variant, phase, seconds): one row per run and recorded phase."""
    return metrics.select(
        "run_id", F.col("framework").alias("variant"), F.explode("phases").alias("phase", "seconds")
    )


def compare_runs(long: DataFrame, left: str, right: str) -> DataFrame:
    """Per phase: mean seconds of either variant and their ratio, null where undefined.

    A recorded total is a phase like any other; it is not the sum of the others, since it
    also covers the start of the session.
    """

    def mean_of(variant: str):
        return F.avg(F.when(F.col("variant") == variant, F.col("seconds")))

    means = long.groupBy("phase").agg(
        mean_of(left).alias("left_s"), mean_of(right).alias("right_s")
    )
    return means.withColumn("ratio", F.try_divide("left_s", "right_s"))


def name_phases(compared: DataFrame) -> DataFrame:
    """The comparison with display names, in pipeline order, the total last."""
    names = F.create_map(*[F.lit(x) for pair in PHASES.items() for x in pair])
    order = F.array_position(F.array(*[F.lit(p) for p in PHASES]), F.col("phase"))
    shown = F.coalesce(names[F.col("phase")], F.col("phase"))
    return compared.orderBy(F.when(order > 0, order).asc_nulls_last(), "phase").withColumn(
        "phase", shown
    )


def repeat_spread(long: DataFrame) -> DataFrame:
    """Per variant and phase: exact median and inter-quartile range over the runs."""
    quartiles = exact_percentiles(long, ["variant", "phase"], "seconds", [0.25, 0.5, 0.75])
    p = F.col("percentiles")
    return quartiles.select(
        "variant", "phase", p[1].alias("median_s"), (p[2] - p[0]).alias("iqr_s")
    )


def parse_resource_log(lines: DataFrame) -> DataFrame:
    """(label, sampled_at, cpu_pct, mem_mb) from columns value (a line) and path (its file).

    Values a line does not carry are null.
    """

    def part(pattern: str, group: int = 1, text: str = "value"):
        return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))

    used_mac = part(LOG_USED_MAC).try_cast("double") * F.element_at(
        F.create_map(*[F.lit(x) for x in ("K", 1 / 1024, "M", 1.0, "G", 1024.0)]),
        part(LOG_USED_MAC, 2),
    )
    return lines.select(
        part(LOG_LABEL, text="path").alias("label"),
        part(LOG_TIME).try_cast("timestamp").alias("sampled_at"),
        (F.lit(100.0) - part(LOG_IDLE).try_cast("double")).alias("cpu_pct"),
        F.coalesce(part(LOG_USED_MB).try_cast("double"), used_mac).alias("mem_mb"),
    )


def resource_peaks(samples: DataFrame) -> DataFrame:
    """Per label: highest CPU share and highest memory in use."""
    return samples.groupBy("label").agg(
        F.max("cpu_pct").alias("peak_cpu"), F.max("mem_mb").alias("peak_mem_mb")
    )
