from __future__ import annotations

import json
import subprocess
import sys
from pathlib import Path

import pytest
from given import TESTDATA

from tripwright.operators.stages import step_seconds
from tripwright.plans import derive
from tripwright.plans.pipeline import run
from tripwright.sources import events

STEPS = {"ingestion_s", "cleansing_s", "join_s", "export_s"}
COLUMNS = (
    "span string, stage bigint, attempt bigint, tasks bigint, operators array<string>, wall_s double, "
    "run_s double, scan_s double, build_s double, sort_s double, shuffle_write_s double"
)


@pytest.fixture(scope="module", params=["true", "false"])
def logged(spark, tmp_path_factory, request):
    """What a process with an event log, in many files or in one, said about its runs."""
    root = tmp_path_factory.mktemp("logged")
    small = str(TESTDATA / "sf0.001")
    derive.trips(spark, small).write.parquet(f"{root}/trips")
    derive.zones(spark, small).coalesce(1).write.option("header", True).csv(f"{root}/zones")
    script = str(Path(__file__).parent / "log_run.py")
    words = [sys.executable, script, str(root), f"{root}/trips", f"{root}/zones", request.param]
    done = subprocess.run(words, capture_output=True, text=True, timeout=300, check=True)
    return json.loads(done.stdout.splitlines()[-1])


@pytest.mark.parametrize("name", ["strict", "keyed", "merged"])
def test_a_run_timed_by_the_log_has_its_phases(logged, name):
    said = logged[name]
    phases = said["phases"]
    assert set(phases) == STEPS | {"aggregate_s", "total_s"}
    assert all(phases[p] > 0 for p in phases)
    # Reading the layouts counts as ingestion besides the scan, nothing else is added later.
    for step in STEPS - {"ingestion_s"}:
        assert phases[step] == pytest.approx(said["again"][step])
    assert phases["ingestion_s"] > said["again"]["ingestion_s"]


@pytest.mark.parametrize("name", ["strict", "keyed", "merged"])
def test_a_run_timed_by_the_log_repeats_nothing(logged, name):
    rows = [s for s in logged[name]["stages"] if s["span"] == "rows"]
    assert sum("Scan parquet" in s["operators"] for s in rows) == 1
    assert sum("WriteFiles" in s["operators"] for s in rows) == 1
    assert {s["span"] for s in logged[name]["stages"]} == {"plan", "rows", "last"}
    broadcast = any("BroadcastExchange" in s["operators"] and "Scan csv" in s["operators"] for s in rows)
    assert broadcast == (name != "merged")


def test_stages_of_other_runs_are_left_out(logged):
    assert logged["none"] == [[s, 0.0] for s in ("ingestion_s", "cleansing_s", "join_s", "export_s")]


def times(spark, *stages):
    table = spark.createDataFrame(list(stages), COLUMNS)
    return {r.phase: r.seconds for r in step_seconds(table).collect()}


def test_a_stage_is_shared_out_by_what_its_tasks_spent(spark):
    got = times(
        spark,
        ("plan", 0, 0, 1, ["Scan csv", "Exchange"], 0.5, 1.0, 0.0, 0.0, 0.0, 0.0),
        ("rows", 1, 0, 9, ["Exchange", "Scan parquet"], 10.0, 40.0, 10.0, 4.0, 0.0, 1.0),
        ("rows", 2, 0, 1, ["BroadcastExchange", "Scan csv"], 1.0, 1.0, 0.0, 0.0, 0.0, 0.0),
        ("rows", 3, 0, 8, ["WriteFiles"], 8.0, 16.0, 0.0, 2.0, 2.0, 0.0),
        ("other", 4, 0, 8, ["Scan parquet"], 8.0, 16.0, 3.0, 2.0, 2.0, 0.0),
    )
    assert got == {"ingestion_s": 2.5, "cleansing_s": 9.5, "join_s": 1.5, "export_s": 6.0}


def test_in_a_merge_join_the_last_sort_is_the_joins(spark):
    got = times(
        spark,
        ("rows", 1, 0, 9, ["Exchange", "Scan parquet"], 10.0, 40.0, 10.0, 4.0, 0.0, 1.0),
        ("rows", 2, 0, 9, ["AQEShuffleRead", "Exchange"], 3.0, 9.0, 0.0, 4.0, 0.0, 1.0),
        ("rows", 3, 0, 9, ["Exchange", "Scan csv"], 2.0, 9.0, 0.0, 0.0, 0.0, 1.0),
        ("rows", 4, 0, 8, ["WriteFiles"], 8.0, 16.0, 0.0, 0.0, 4.0, 0.0),
    )
    assert got == {"ingestion_s": 2.5, "cleansing_s": 10.5, "join_s": 4.0, "export_s": 6.0}


def test_every_attempt_counts_and_odd_times_stay_in_bounds(spark):
    got = times(
        spark,
        ("rows", 1, 0, 9, ["Scan parquet"], 4.0, 0.0, 0.0, 0.0, 0.0, 0.0),
        ("rows", 1, 1, 9, ["Scan parquet"], 6.0, 2.0, 3.0, 0.0, 0.0, 0.0),
    )
    assert got == {"ingestion_s": 6.0, "cleansing_s": 4.0, "join_s": 0.0, "export_s": 0.0}


def test_a_log_is_read_as_it_is_written(spark, tmp_path):
    def event(kind, stage, attempt=0, **more):
        info = {"Stage ID": stage, "Stage Attempt ID": attempt}
        return {"Event": f"SparkListenerStage{kind}", "Stage Info": info | more.pop("info", {})} | more

    end = {
        "Submission Time": 1000, "Completion Time": 3500, "Number of Tasks": 4,
        "RDD Info": [{"Scope": '{"id":"1","name":"Scan parquet "}'}, {"RDD ID": 3},
                     {"Scope": '{"id":"1","name":"Scan parquet "}'}],
        "Accumulables": [{"ID": 1, "Name": "internal.metrics.executorRunTime", "Value": 8000},
                         {"ID": 2, "Name": "scan time", "Value": "1500"},
                         {"ID": 3, "Name": "scan time", "Value": "500"},
                         {"ID": 4, "Name": "shuffle write time", "Value": "2000000000"},
                         {"ID": 5, "Name": "whose", "Value": {"a": 1}}],
    }
    lines = [
        json.dumps(event("Submitted", 1, Properties={events.SPAN: "a/rows"})),
        json.dumps({"Event": "SparkListenerTaskEnd", "Stage ID": 1}),
        json.dumps(event("Completed", 1, info=end)),
        json.dumps(event("Submitted", 2, Properties={events.SPAN: "a/rows"})),
        json.dumps(event("Submitted", 3, Properties={events.SPAN: "ab/rows"})),
        json.dumps(event("Completed", 3, info=end)),
        json.dumps(event("Submitted", 4, Properties={})),
        json.dumps(event("Completed", 4, info=end)),
        '{"Event":"SparkListenerStageCompleted","Stage In',
    ]
    # As Spark writes them: no space behind a colon or comma outside texts.
    log = "\n".join(line.replace('": ', '":').replace(', "', ',"') for line in lines)
    (tmp_path / "events_1").write_text(log)
    (row,) = events.read_stages(spark, str(tmp_path), "a").collect()
    assert row.asDict() == {
        "span": "rows", "stage": 1, "attempt": 0, "tasks": 4, "operators": ["Scan parquet"],
        "wall_s": 2.5, "run_s": 8.0, "scan_s": 2.0, "build_s": 0.0, "sort_s": 0.0,
        "shuffle_write_s": 2.0,
    }


def test_a_session_without_a_readable_log_is_refused_before_any_work(spark, tmp_path):
    with pytest.raises(events.NoEventLogError, match="spark.eventLog.enabled=true"):
        run(spark, "/none", "/none", f"{tmp_path}/rows", f"{tmp_path}/summary", timed="log")
    with pytest.raises(ValueError, match="timed is"):
        run(spark, "/none", "/none", f"{tmp_path}/rows", f"{tmp_path}/summary", timed="seconds")
