"""Results appear whole or not at all."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest
from given import TESTDATA

from tripwright import __main__ as command
from tripwright.plans import derive
from tripwright.plans import pipeline as pipelines
from tripwright.plans.pipeline import KEYED, STRICT, run_published
from tripwright.sinks import published
from tripwright.sources.files import NoInputError

SMALL = str(TESTDATA / "sf0.001")


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    derive.trips(spark, SMALL).write.parquet(f"{root}/trips")
    derive.zones(spark, SMALL).coalesce(1).write.option("header", True).csv(f"{root}/zones")
    return f"{root}/trips", f"{root}/zones"


def state(spark, result):
    """Rows, trips that the summary counts, and joined rows as the metrics have them."""
    trips = published.read_summary(spark, result).selectExpr("sum(trip_count)").head()[0]
    (doc,) = published.read_metrics(spark, result).collect()
    return published.read_rows(spark, result).count(), trips, doc.joined_rows


def test_a_run_replaces_the_one_before(spark, inputs, tmp_path):
    result = f"{tmp_path}/result"
    with pytest.raises(NoInputError, match="nothing is published"):
        published.read_rows(spark, result)
    assert run_published(spark, *inputs, result, STRICT).number == 1
    assert state(spark, result) == (1002, 1002, 1002)
    run_published(spark, *inputs, result, KEYED)
    assert state(spark, result) == (956, 956, 956)
    first = published.read_version(spark, result, 1)
    assert published.read_rows(spark, result, first).count() == 1002


def test_appended_rows_are_summarised_together(spark, inputs, tmp_path):
    result = f"{tmp_path}/result"
    run_published(spark, *inputs, result, STRICT)
    run_published(spark, *inputs, result, KEYED, append=True)
    assert state(spark, result) == (1002 + 956, 1002 + 956, 956)


@pytest.mark.parametrize("step", ["write_summary", "write_run_metrics"])
def test_a_run_that_fails_between_its_writes_changes_nothing(spark, inputs, tmp_path, monkeypatch, step):
    result = f"{tmp_path}/result"
    run_published(spark, *inputs, result, STRICT)

    def fail(*_):
        raise OSError("store is full")

    monkeypatch.setattr(pipelines, step, fail)
    for append in (False, True):
        with pytest.raises(OSError, match="full"):
            run_published(spark, *inputs, result, KEYED, append=append)
        assert state(spark, result) == (1002, 1002, 1002)
    monkeypatch.undo()
    assert len(published.drop_unread(spark, result, keep=1)) == 2
    assert state(spark, result) == (1002, 1002, 1002)


def test_a_process_killed_between_its_writes_changes_nothing(spark, inputs, tmp_path):
    """The process ends by a signal when the rows are there and the summary is not."""
    result = f"{tmp_path}/result"
    run_published(spark, *inputs, result, STRICT)
    code = (
        "import os, signal\n"
        "from pyspark.sql import SparkSession\n"
        "from tripwright.plans import pipeline\n"
        "pipeline.write_summary = lambda *_: os.kill(os.getpid(), signal.SIGKILL)\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        f"pipeline.run_published(spark, {inputs[0]!r}, {inputs[1]!r}, {result!r}, pipeline.KEYED)\n"
    )
    root = Path(__file__).resolve().parent.parent
    env = os.environ | {"PYTHONPATH": str(root)}
    ended = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, timeout=120, capture_output=True)
    assert ended.returncode == -9
    (left,) = set(os.listdir(f"{result}/runs")) - {published.latest(spark, result).run_id}
    assert os.listdir(f"{result}/runs/{left}") == ["rows"]
    assert state(spark, result) == (1002, 1002, 1002)


def test_of_two_runs_at_a_time_one_is_refused(spark, inputs, tmp_path):
    result = f"{tmp_path}/result"
    slow = published.draft(spark, result)
    run_published(spark, *inputs, result, STRICT)
    with pytest.raises(published.PublishedMeanwhileError):
        published.publish(spark, slow)
    assert state(spark, result) == (1002, 1002, 1002)


def test_commands_take_result_folders(spark, inputs, tmp_path, capsys):
    where = ["--trips", inputs[0], "--zones", inputs[1]]
    for name in ("strict", "keyed"):
        assert command.main(["run", *where, "--pipeline", name, "--result", f"{tmp_path}/{name}"]) == 0
    capsys.readouterr()
    assert command.main(["reconcile", "--left", f"{tmp_path}/strict", "--right", f"{tmp_path}/strict"]) == 0
    assert command.main(["reconcile", "--left", f"{tmp_path}/strict", "--right", f"{tmp_path}/keyed"]) == 1
    assert "row_counts       2 differ" in capsys.readouterr().out
    with pytest.raises(SystemExit, match="--result"):
        command.main(["run", *where])
