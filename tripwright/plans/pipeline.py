"""The two trip pipelines, lazily composed, and a runner that writes their results."""

from __future__ import annotations

import platform
import socket
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripwright.contract import EXPORT_COLUMNS, TRIPS
from tripwright.operators import reconcile
from tripwright.operators.clean import clean, clean_by_key
from tripwright.operators.enrich import (
    BROADCAST_LIMIT_BYTES,
    add_hour,
    add_speed,
    join_zone,
    look_up_zone,
    measure_zones,
    refuse_repeated,
    zone_columns,
)
from tripwright.operators.stages import PLAN, ROWS, step_seconds
from tripwright.operators.summarise import export_rows, speed_by_group
from tripwright.session import use_utc
from tripwright.sinks import published
from tripwright.sinks.files import write_rows, write_run_metrics, write_summary
from tripwright.sources import events
from tripwright.sources.records import METRICS_SCHEMA
from tripwright.sources.tables import read_normalized, read_zones


@dataclass(frozen=True)
class Pipeline:
    """What tells one pipeline from the other: how it cleans and how it joins."""

    name: str
    clean: Callable[[DataFrame], DataFrame]
    join: Callable[..., DataFrame]
    named_zones_only: bool = False

    def joined(self, trips: DataFrame, zones: DataFrame) -> DataFrame:
        # Hot zones, where they matter, are told from the trips as read: cleaning runs once.
        return self.join(self.clean(trips), zones, like=trips)

    def enriched(self, trips: DataFrame, zones: DataFrame) -> DataFrame:
        joined = self.joined(trips, zones)
        return joined.transform(add_speed).transform(add_hour).transform(export_rows)

    def summary(self, trips: DataFrame, zones: DataFrame) -> DataFrame:
        return speed_by_group(self.enriched(trips, zones))


# Copies are equal rows; every zone match counts, also one without a borough.
STRICT = Pipeline("strict", clean, join_zone)
# Copies share the trip key; zones are looked up by a unique key and need a borough.
KEYED = Pipeline("keyed", clean_by_key, look_up_zone, named_zones_only=True)


def compare(left: Pipeline, right: Pipeline, trips: DataFrame, zones: DataFrame) -> DataFrame:
    """The report on two pipelines over the same trips: each cleans once, and nothing is written."""
    facts = measure_zones(zones)
    sides = {"left": left, "right": right}
    if any(p.named_zones_only for p in sides.values()):
        refuse_repeated(facts)
    cells = {
        side: reconcile.speed_cells(p.clean(trips).transform(add_speed).transform(add_hour))
        for side, p in sides.items()
    }
    counted = trips.agg(F.count("*").alias("left_input"))
    return reconcile.report_on_cells(
        cells,
        counted.withColumn("right_input", F.col("left_input")),
        zone_columns(zones),
        {side: p.named_zones_only for side, p in sides.items()},
        facts.bytes <= BROADCAST_LIMIT_BYTES,
    )


class StageTimer:
    """Seconds per stage, by running each stage's plan to its end without keeping the rows.

    Stages build on one another and are not stored in between, so a stage's own share is its
    time less that of the stage before. Meant for measuring: it does the work again and again.
    """

    def __init__(self) -> None:
        self.seconds: dict[str, float] = {}
        self.whole = 0.0

    def run(self, stage: str, df: DataFrame) -> DataFrame:
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        elapsed = time.perf_counter() - start
        self.seconds[stage] = max(0.0, elapsed - self.whole)
        self.whole = elapsed
        return df


def time_stages(pipeline: Pipeline, trips: DataFrame, zones: DataFrame) -> StageTimer:
    """Seconds per stage of one pipeline, over whole inputs, and of its rows to nowhere."""
    timer = StageTimer()
    timer.run("ingestion_s", trips)
    cleaned = timer.run("cleansing_s", pipeline.clean(trips))
    joined = timer.run("join_s", pipeline.join(cleaned, zones, like=trips))
    timer.run("udf_s", joined.transform(add_speed).transform(add_hour).transform(export_rows))
    return timer


def stage_seconds(
    pipeline: Pipeline, trips: DataFrame, zones: DataFrame, rows: DataFrame, spent: float
) -> dict[str, float]:
    """Seconds per recorded stage. ``rows`` are the rows as written, and writing them and the
    summary took ``spent``: what exceeds the same plans run to nowhere is the export."""
    timer = time_stages(pipeline, trips, zones)
    to_nowhere = timer.whole
    timer.whole = 0.0
    timer.run("aggregate_s", speed_by_group(rows))
    export = max(0.0, spent - to_nowhere - timer.seconds["aggregate_s"])
    return timer.seconds | {"export_s": export}


def logged_seconds(spark: SparkSession, run_id: str, since: float) -> dict[str, float]:
    """Seconds per phase of a run just ended, from the event log; none if it lags too far."""
    stages = events.written_stages(spark, run_id, since)
    if stages is None:
        return {}
    return {r.phase: r.seconds for r in step_seconds(stages).collect()}


def run(
    spark: SparkSession,
    trips_path: str,
    zones_path: str,
    rows_path: str,
    summary_path: str,
    metrics_path: str | None = None,
    pipeline: Pipeline = STRICT,
    timed: str | bool = False,
) -> DataFrame:
    """Read, clean, join, enrich and write one pipeline's rows and summary.

    The trips go through the heavy part once: the summary is taken from the rows as written,
    of which it reads three columns, so nothing large is cached and a lost executor costs
    only its own tasks. With a metrics path the row counts are recorded as well, from the
    written results and from a counter on the cleaned rows. A counter is exact only in the
    stage that writes (a map task that is run again counts twice), so it stands before a
    broadcast join and behind a merge join, whichever the zones call for. Only where the
    optimizer has removed the counter, as it may if nothing can come out, are the cleaned
    rows counted in a job of their own. Returns the summary as written.

    ``timed`` adds seconds per phase after the total is taken. ``"log"`` reads them from the
    session's event log, which has to be kept uncompressed, and repeats nothing: phases are
    those of ``step_seconds``, without one for the speed, which is fused into the export.
    ``"repeat"`` (or True) runs the steps again, each to its end.
    """
    if timed not in (False, True, "log", "repeat"):
        raise ValueError(f"timed is 'log', 'repeat' or false, not {timed!r}")
    if timed == "log":
        events.log_path(spark)  # refused before any work is done
    run_id, began, start = uuid.uuid4().hex, time.time(), time.perf_counter()
    use_utc(spark)
    trips = read_normalized(spark, trips_path)
    zones = read_zones(spark, zones_path)
    read_s = time.perf_counter() - start
    counter, counted = None, pipeline
    if metrics_path is not None:
        counter = Observation("cleaned")
        counted = replace(pipeline, join=partial(pipeline.join, tell=partial(_count, counter)))
    before_export = time.perf_counter()
    with events.span(spark, run_id, PLAN):
        enriched = counted.enriched(trips, zones)
    with events.span(spark, run_id, ROWS):
        write_rows(enriched, rows_path)
    written = spark.read.parquet(rows_path)
    before_summary = time.perf_counter()
    write_summary(speed_by_group(written), summary_path)
    ended = time.perf_counter()
    summary = spark.read.parquet(summary_path)
    if metrics_path is not None:
        phases = {"total_s": time.perf_counter() - start}
        if timed == "log":
            phases |= logged_seconds(spark, run_id, began)
            phases["aggregate_s"] = ended - before_summary
            phases["ingestion_s"] = phases.get("ingestion_s", 0.0) + read_s
        elif timed:
            phases |= stage_seconds(pipeline, trips, zones, written, ended - before_export)
        cleaned = _observed(counter)
        counts = {
            "input_rows": trips.count(),
            "cleaned_rows": pipeline.clean(trips).count() if cleaned is None else cleaned,
            "joined_rows": written.count(),
            "agg_rows": summary.count(),
        }
        document = run_document(spark, pipeline.name, counts, phases, run_id)
        write_run_metrics(document, metrics_path)
    return summary


def run_published(
    spark: SparkSession,
    trips_path: str,
    zones_path: str,
    result: str,
    pipeline: Pipeline = STRICT,
    timed: str | bool = False,
    append: bool = False,
) -> published.Version:
    """``run`` into a result folder, where rows, summary and metrics appear together or not at all.

    Everything is written to a folder of the run's own; one rename at the end publishes it, so
    a run that ends early leaves the state before. With ``append`` the rows of that state stay
    and the summary covers all of them. Of two runs at a time the second to end is refused.
    """
    own = published.draft(spark, result)
    paths = [f"{own.folder}/{part}" for part in ("rows", "summary", "metrics")]
    run(spark, trips_path, zones_path, *paths, pipeline, timed)
    if append and own.before:
        rows = published.read_rows(spark, result, own.before).unionByName(spark.read.parquet(paths[0]))
        write_summary(speed_by_group(rows), paths[1])
    return published.publish(spark, own, append)


def _observed(counter: Observation) -> int | None:
    """What the counter counted, or None if it was not part of the plan."""
    try:
        return counter.get["n"]
    except (Py4JError, PySparkException):
        return None


def _count(counter: Observation, rows: DataFrame, once: Column) -> DataFrame:
    # Cleaning is done where this stands, so the counter holds back no pushed-down filter; the
    # columns the export drops are dropped here because pruning does not pass a counter.
    unused = set(TRIPS.names) - set(EXPORT_COLUMNS)
    return rows.drop(*unused).observe(counter, F.count_if(once).alias("n"))


def run_document(
    spark: SparkSession,
    variant: str,
    counts: dict[str, int],
    phases: dict[str, float],
    run_id: str | None = None,
) -> DataFrame:
    """One run's metrics as a one-row table."""
    context = spark.sparkContext
    values = {
        "run_id": run_id or uuid.uuid4().hex,
        "framework": variant,
        "hostname": socket.gethostname(),
        "platform": platform.platform(),
        "spark_version": spark.version,
        "master": context.master,
        "default_parallelism": context.defaultParallelism,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
        **counts,
        "phases": phases,
    }
    return spark.createDataFrame([values], METRICS_SCHEMA)
