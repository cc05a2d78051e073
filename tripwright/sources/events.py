"""Reading Spark's event log: what the stages of a run cost, while its application still runs."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The local property that marks the stages of a span of a run; its value is "run/span".
SPAN = "tripwright.span"
# Span of the job whose end shows that all earlier events are in the log.
LAST = "last"
# Settings and names of Spark's event log.
LOG_ON, LOG_DIR, LOG_COMPRESS, LOG_ROLLING = (
    f"spark.eventLog.{name}" for name in ("enabled", "dir", "compress", "rolling.enabled")
)
SUBMITTED, COMPLETED = "SparkListenerStageSubmitted", "SparkListenerStageCompleted"
EVENT_SCHEMA = (
    "Event string, Properties map<string, string>, `Stage Info` struct<`Stage ID`: bigint, "
    "`Stage Attempt ID`: bigint, `Submission Time`: bigint, `Completion Time`: bigint, "
    "`Number of Tasks`: bigint, `RDD Info`: array<struct<Scope: string>>, "
    "Accumulables: array<struct<Name: string, Value: string>>>"
)
# Spark's names of times that are summed over a stage's tasks, and their units.
TASK_TIMES = {
    "run_s": ("internal.metrics.executorRunTime", 1e3),
    "scan_s": ("scan time", 1e3),
    "build_s": ("time in aggregation build", 1e3),
    "sort_s": ("sort time", 1e3),
    "shuffle_write_s": ("shuffle write time", 1e9),
}


class NoEventLogError(RuntimeError):
    """The session keeps no event log that can be read while it runs."""


def log_path(spark: SparkSession) -> str:
    """A pattern of the files of this session's event log.

    The log has to be kept and not compressed: Spark reads its compressed form only after the
    application, and not by its text reader.
    """
    conf = spark.sparkContext.getConf()
    if conf.get(LOG_ON, "false").lower() != "true" or conf.get(LOG_COMPRESS, "true").lower() != "false":
        raise NoEventLogError(f"times from the event log need {LOG_ON}=true and {LOG_COMPRESS}=false")
    folder, app = conf.get(LOG_DIR, "file:///tmp/spark-events").rstrip("/"), spark.sparkContext.applicationId
    if conf.get(LOG_ROLLING, "true").lower() == "true":
        return f"{folder}/eventlog_v2_{app}*/events_*"
    return f"{folder}/{app}*"


@contextmanager
def span(spark: SparkSession, run: str, name: str) -> Iterator[None]:
    """Mark the stages that are submitted meanwhile, by this thread, as those of a span."""
    context = spark.sparkContext
    before = context.getLocalProperty(SPAN)
    context.setLocalProperty(SPAN, f"{run}/{name}")
    try:
        yield
    finally:
        context.setLocalProperty(SPAN, before)


def read_stages(spark: SparkSession, path: str, run: str, since: float = 0.0) -> DataFrame:
    """A row per finished attempt of a stage of one run: (span, stage, attempt, tasks,
    operators, wall_s, run_s, scan_s, build_s, sort_s, shuffle_write_s).

    ``wall_s`` is the time from submission to completion; the others are sums over tasks, of
    which ``run_s`` is their whole running time; a time a stage does not keep is 0.
    ``operators`` are the names of its scopes, such as "Scan parquet", sorted. Of a log in
    many files, only those written since a time (seconds of the epoch) are read.
    """
    moment = datetime.fromtimestamp(since, timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
    lines = spark.read.option("modifiedAfter", moment).option("timeZone", "UTC").text(path)
    # Other events, tasks above all, are left out before they are parsed.
    wanted = lines.filter(F.col("value").rlike(f'^\\{{"Event":"({SUBMITTED}|{COMPLETED})"'))
    event = wanted.select(F.from_json("value", EVENT_SCHEMA).alias("e")).select("e.*")
    info = F.col("`Stage Info`")

    def total(name: str, unit: float):
        values = F.filter(info["Accumulables"], lambda a: a["Name"] == name)
        seconds = F.transform(values, lambda a: a["Value"].cast("double") / unit)
        return F.aggregate(F.coalesce(seconds, F.array()), F.lit(0.0), lambda x, y: x + y)

    scopes = F.transform(
        info["RDD Info"], lambda r: F.trim(F.get_json_object(r["Scope"], "$.name"))
    )
    ended = F.struct(
        info["Number of Tasks"].alias("tasks"),
        F.array_sort(F.array_distinct(F.array_compact(scopes))).alias("operators"),
        ((info["Completion Time"] - info["Submission Time"]) / 1e3).alias("wall_s"),
        *[total(*of).alias(name) for name, of in TASK_TIMES.items()],
    )
    # Both events of an attempt are put together in one pass over the log.
    attempts = event.groupBy(
        info["Stage ID"].alias("stage"), info["Stage Attempt ID"].alias("attempt")
    ).agg(
        F.max(F.when(F.col("Event") == SUBMITTED, F.col("Properties")[SPAN])).alias("mark"),
        F.any_value(F.when(F.col("Event") == COMPLETED, ended), True).alias("ended"),
    )
    ours = F.col("mark").startswith(f"{run}/") & F.col("ended").isNotNull()
    return attempts.filter(ours).select(
        F.substr("mark", F.lit(len(run) + 2)).alias("span"), "stage", "attempt", "ended.*"
    )


def written_stages(
    spark: SparkSession, run: str, since: float, patience: float = 30.0
) -> DataFrame | None:
    """``read_stages`` of this session's own log, once all stages so far are in it.

    Events are written in their order, a moment after they happen: a last small job is awaited.
    None if it does not appear in time.
    """
    path = log_path(spark)
    with span(spark, run, LAST):
        spark.sparkContext.setJobDescription("await the event log")
        spark.range(1, numPartitions=1).write.format("noop").mode("overwrite").save()
        spark.sparkContext.setJobDescription(None)
    # File times are whole seconds on some stores.
    stages, end = read_stages(spark, path, run, since - 2), time.monotonic() + patience
    while True:
        found = stages.collect()  # as many rows as the run had stages, however large its tables
        if any(r.span == LAST for r in found):
            return spark.createDataFrame([r for r in found if r.span != LAST], stages.schema)
        if time.monotonic() > end:
            return None
        time.sleep(0.1)
        stages = read_stages(spark, path, run, since - 2)
