"""Results that are whole or not there: runs are written apart and published by a log.

A result folder holds ``runs/<id>/`` with what one run wrote, and ``_log/`` with one small
numbered file per published run, which names the folders that belong together. Readers take
the file with the highest number. A run that ends early leaves a folder that no file names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from tripwright.sources.files import NoInputError
from tripwright.sources.records import read_run_metrics

LOG, RUNS = "_log", "runs"


class PublishedMeanwhileError(RuntimeError):
    """Another run was published since this one began."""


@dataclass(frozen=True)
class Version:
    """A published state: its number, and folders relative to the result folder."""

    number: int
    run_id: str
    rows: tuple[str, ...]
    summary: str
    metrics: str


@dataclass(frozen=True)
class Draft:
    """A run that is not published yet, and the state it began from."""

    run_id: str
    result: str
    before: Version | None

    @property
    def folder(self) -> str:
        return f"{self.result}/{RUNS}/{self.run_id}"


def _store(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where, jvm.org.apache.hadoop.fs.Path


def versions(spark: SparkSession, result: str) -> list[int]:
    store, log, _ = _store(spark, f"{result}/{LOG}")
    if not store.exists(log):
        return []
    names = [f.getPath().getName() for f in store.listStatus(log)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def latest(spark: SparkSession, result: str) -> Version | None:
    """The last published state, or None."""
    numbers = versions(spark, result)
    return read_version(spark, result, numbers[-1]) if numbers else None


def read_version(spark: SparkSession, result: str, number: int) -> Version:
    text = spark.read.text(f"{result}/{LOG}/{number:020}.json", wholetext=True).head()[0]
    fields = json.loads(text)
    return Version(**{**fields, "rows": tuple(fields["rows"])})


def draft(spark: SparkSession, result: str) -> Draft:
    """A place for a new run, which nothing reads until it is published."""
    return Draft(uuid.uuid4().hex, result, latest(spark, result))


def publish(spark: SparkSession, run: Draft, append: bool = False) -> Version:
    """Make a draft's rows, summary and metrics the state that readers see, all at once.

    With ``append`` rows of the state before stay beside the new ones. The log file is written
    under another name first and gets its number by a rename, which succeeds for one run only.
    """
    number = (run.before.number if run.before else 0) + 1
    folder = f"{RUNS}/{run.run_id}"
    earlier = run.before.rows if run.before and append else ()
    version = Version(number, run.run_id, (*earlier, f"{folder}/rows"), f"{folder}/summary", f"{folder}/metrics")
    store, log, path = _store(spark, f"{run.result}/{LOG}")
    store.mkdirs(log)
    hidden, final = path(log, f".{run.run_id}"), path(log, f"{number:020}.json")
    out = store.create(hidden, True)
    try:
        out.write(bytearray(json.dumps(asdict(version)).encode()))
    finally:
        out.close()
    if store.exists(final) or not store.rename(hidden, final):
        store.delete(hidden, False)
        raise PublishedMeanwhileError(f"{run.result} has a version {number} already")
    return version


def _wanted(spark: SparkSession, result: str, version: Version | None) -> Version:
    found = version or latest(spark, result)
    if found is None:
        raise NoInputError(f"nothing is published in {result}")
    return found


def is_result(spark: SparkSession, path: str) -> bool:
    store, log, _ = _store(spark, f"{path}/{LOG}")
    return store.exists(log)


def read_rows(spark: SparkSession, result: str, version: Version | None = None) -> DataFrame:
    found = _wanted(spark, result, version)
    return spark.read.parquet(*[f"{result}/{folder}" for folder in found.rows])


def read_summary(spark: SparkSession, result: str, version: Version | None = None) -> DataFrame:
    return spark.read.parquet(f"{result}/{_wanted(spark, result, version).summary}")


def read_metrics(spark: SparkSession, result: str, version: Version | None = None) -> DataFrame:
    """The metrics of the one run that made this state."""
    return read_run_metrics(spark, f"{result}/{_wanted(spark, result, version).metrics}")


def drop_unread(spark: SparkSession, result: str, keep: int = 2) -> Sequence[str]:
    """Delete run folders and log files that belong to none of the last ``keep`` states.

    Names of the deleted run folders are returned. No run may be under way meanwhile.
    """
    numbers = versions(spark, result)
    kept = [read_version(spark, result, n) for n in numbers[-keep:]] if keep else []
    used = {folder.split("/")[1] for v in kept for folder in (*v.rows, v.summary, v.metrics)}
    store, runs, path = _store(spark, f"{result}/{RUNS}")
    gone = []
    if store.exists(runs):
        for found in store.listStatus(runs):
            if found.getPath().getName() not in used:
                gone.append(found.getPath().getName())
                store.delete(found.getPath(), True)
    for n in numbers[: len(numbers) - len(kept)]:
        store.delete(path(f"{result}/{LOG}/{n:020}.json"), False)
    return sorted(gone)
