"""What the steps of one run cost, told from the stages it ran."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spans of a run: planning the join (zones are measured, hot ones found) and writing the rows.
PLAN, ROWS = "plan", "rows"


def step_seconds(stages: DataFrame) -> DataFrame:
    """(phase, seconds) of ingestion, cleaning, join and export, from ``read_stages``.

    A stage's wall-clock time is shared out in proportion to what its tasks spent:

    - A stage that scans the trips reads them for as long as its scan took; the rest of it,
      filters, the first half of removing copies and the shuffle's writing, is cleaning.
    - The stages of a broadcast and, in a merge join, those that shuffle zones are the join, and so
      is what planning the join ran.
    - A stage between the scan and the writing ends the cleaning and deals trips to the join.
    - The stage that writes merges copies (building hash tables or sorting), which is cleaning,
      or in a merge join sorts for the join; what is left of it is the export. Probing a
      broadcast and the native speed are fused into that, and have no time of their own.

    Stages that run side by side count in full, and time between stages in none, so the sum is
    not the time of the run.
    """

    def has(name: str) -> Column:
        return F.exists("operators", lambda o: o.startswith(name))

    broadcast, trips, write = has("BroadcastExchange"), has("Scan parquet"), has("WriteFiles")
    others = has("Scan") | has("ExistingRDD") | has("LocalTableScan")
    kind = (
        F.when((F.col("span") == PLAN) | broadcast, "join")
        .when(write, "write")
        .when(trips, "scan")
        .when(others, "zones")
        .otherwise("between")
    )
    ours = stages.filter(F.col("span").isin(PLAN, ROWS)).withColumn("kind", kind)

    def share(*parts: str) -> Column:
        spent = sum((F.col(p) for p in parts), F.lit(0.0))
        part = F.coalesce(F.try_divide(spent, F.col("run_s")), F.lit(0.0))
        return F.col("wall_s") * F.least(part, F.lit(1.0))

    def total(seconds: Column, *kinds: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind").isin(*kinds), seconds)), F.lit(0.0))

    wall, merging = F.col("wall_s"), share("build_s", "sort_s")
    sums = ours.agg(
        total(share("scan_s"), "scan").alias("ingestion_s"),
        (total(wall - share("scan_s"), "scan") + total(wall, "between")).alias("cleansing_s"),
        total(wall, "join", "zones").alias("join_s"),
        total(wall - merging, "write").alias("export_s"),
        total(merging, "write").alias("merging"),
        # With zones shuffled beside the trips, the writing stage sorts for the join.
        F.coalesce(F.max(F.col("kind") == "zones"), F.lit(False)).alias("merged"),
    )
    of_clean = F.when(F.col("merged"), 0.0).otherwise(F.col("merging"))
    seconds = {
        "ingestion_s": F.col("ingestion_s"),
        "cleansing_s": F.col("cleansing_s") + of_clean,
        "join_s": F.col("join_s") + F.col("merging") - of_clean,
        "export_s": F.col("export_s"),
    }
    cells = [F.struct(F.lit(n).alias("phase"), c.alias("seconds")) for n, c in seconds.items()]
    return sums.select(F.inline(F.array(*cells)))
