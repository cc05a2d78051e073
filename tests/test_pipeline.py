from __future__ import annotations

import csv
import json
from dataclasses import replace
from functools import partial

import pytest
from given import TESTDATA
from plans_of import final, formatted

from tripwright import __main__ as command
from tripwright.operators.enrich import join_zone_merge
from tripwright.operators.funnel import recorded_funnel, row_funnel
from tripwright.operators.runs import phases_long
from tripwright.plans import derive
from tripwright.plans.pipeline import KEYED, STRICT, run, time_stages
from tripwright.sinks import files as sinks
from tripwright.sources.records import read_run_metrics
from tripwright.sources.tables import read_zones

SMALL = str(TESTDATA / "sf0.001")


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    derive.trips(spark, SMALL).write.parquet(f"{root}/trips")
    derive.zones(spark, SMALL).coalesce(1).write.option("header", True).csv(f"{root}/zones")
    return f"{root}/trips", f"{root}/zones"


@pytest.mark.parametrize(("pipeline", "cleaned"), [(STRICT, 1002), (KEYED, 956)])
def test_run_writes_rows_summary_and_metrics(spark, inputs, tmp_path, pipeline, cleaned):
    rows, summary, metrics = (f"{tmp_path}/{n}" for n in ("rows", "summary", "metrics"))
    out = run(spark, *inputs, rows, summary, metrics, pipeline)
    assert out.count() == 120
    assert spark.read.parquet(rows).count() == cleaned
    want = pipeline.summary(derive.trips(spark, SMALL), derive.zones(spark, SMALL)).collect()
    assert [tuple(r)[:2] for r in out.collect()] == [tuple(r)[:2] for r in want]
    (doc,) = read_run_metrics(spark, metrics).collect()
    assert (doc.input_rows, doc.cleaned_rows, doc.joined_rows, doc.agg_rows) == (
        1150, cleaned, cleaned, 120
    )
    assert list(doc.phases) == ["total_s"] and doc.phases["total_s"] > 0


@pytest.mark.parametrize("copies", [1, 2])
@pytest.mark.parametrize("pipeline", [STRICT, KEYED])
def test_a_merge_join_is_counted_without_a_second_cleaning(
    spark, inputs, tmp_path, pipeline, copies
):
    if copies == 2 and pipeline is KEYED:
        pytest.skip("refuses repeated zones")
    zones = spark.read.option("header", True).csv(inputs[1]).filter("LocationID != 3")
    for _ in range(copies):
        zones.coalesce(1).write.mode("append").option("header", True).csv(f"{tmp_path}/zones")
    cleanings = []

    def clean(trips):
        cleanings.append(trips)
        return pipeline.clean(trips)

    merged = replace(pipeline, clean=clean, join=partial(pipeline.join, broadcast_limit=0))
    rows, summary, metrics = (f"{tmp_path}/{n}" for n in ("rows", "summary", "metrics"))
    out = run(spark, inputs[0], f"{tmp_path}/zones", rows, summary, metrics, merged)
    assert len(cleanings) == 1
    (doc,) = read_run_metrics(spark, metrics).collect()
    joined = pipeline.joined(derive.trips(spark, SMALL), read_zones(spark, f"{tmp_path}/zones"))
    cleaned = pipeline.clean(derive.trips(spark, SMALL)).count()
    assert 0 < joined.count() != cleaned
    assert (doc.cleaned_rows, doc.joined_rows, doc.agg_rows) == (
        cleaned, joined.count(), out.count()
    )


def test_a_merge_join_given_as_it_is_counts_too(spark, inputs, tmp_path):
    merged = replace(STRICT, join=join_zone_merge)
    rows, summary, metrics = (f"{tmp_path}/{n}" for n in ("rows", "summary", "metrics"))
    run(spark, *inputs, rows, summary, metrics, merged)
    (doc,) = read_run_metrics(spark, metrics).collect()
    assert (doc.cleaned_rows, doc.joined_rows, doc.agg_rows) == (1002, 1002, 120)


def test_a_second_run_replaces_results_and_adds_metrics(spark, inputs, tmp_path):
    paths = [f"{tmp_path}/{n}" for n in ("rows", "summary", "metrics")]
    for _ in range(2):
        run(spark, *inputs, *paths)
    assert spark.read.parquet(paths[0]).count() == 1002
    assert spark.read.parquet(paths[1]).count() == 120
    assert read_run_metrics(spark, paths[2]).select("run_id").distinct().count() == 2


def test_appending_keeps_earlier_rows(spark, tmp_path):
    enriched = STRICT.enriched(derive.trips(spark, SMALL), derive.zones(spark, SMALL))
    path = f"{tmp_path}/rows"
    sinks.write_rows(enriched, path)
    sinks.write_rows(enriched, path, append=True)
    assert spark.read.parquet(path).count() == 2 * 1002


def test_the_summary_is_one_file_in_key_order(spark, tmp_path):
    summary = STRICT.summary(derive.trips(spark, SMALL), derive.zones(spark, SMALL))
    sinks.write_summary(summary, f"{tmp_path}/summary")
    assert len(list((tmp_path / "summary").glob("*.parquet"))) == 1
    keys = [tuple(r)[:2] for r in spark.read.parquet(f"{tmp_path}/summary").collect()]
    assert keys == sorted(keys)


def test_a_run_over_trips_that_are_all_dropped_ends(spark, inputs, tmp_path):
    empty = f"{tmp_path}/none"
    derive.trips(spark, SMALL).filter("trip_distance < 0").write.parquet(empty)
    derive.trips(spark, SMALL).limit(3).selectExpr(
        "* except (trip_distance)", "0D as trip_distance"
    ).write.mode("append").parquet(empty)
    paths = [f"{tmp_path}/{n}" for n in ("rows", "summary", "metrics")]
    assert run(spark, empty, inputs[1], *paths).count() == 0
    (doc,) = read_run_metrics(spark, paths[2]).collect()
    assert (doc.input_rows, doc.cleaned_rows, doc.joined_rows, doc.agg_rows) == (3, 0, 0, 0)


def test_stage_times_are_those_of_the_stages(spark):
    timer = time_stages(STRICT, derive.trips(spark, SMALL), derive.zones(spark, SMALL))
    assert list(timer.seconds) == ["ingestion_s", "cleansing_s", "join_s", "udf_s"]
    assert all(s >= 0 for s in timer.seconds.values())
    assert sum(timer.seconds.values()) >= timer.whole


def test_the_total_leaves_out_the_timing(spark, inputs, tmp_path):
    def phases(timed):
        paths = [f"{tmp_path}/{timed}/{n}" for n in ("rows", "summary", "metrics")]
        run(spark, *inputs, *paths, timed=timed)
        return read_run_metrics(spark, paths[2]).head().phases

    phases(False)
    plain, timed = phases(False), phases(True)
    assert set(timed) == {
        "ingestion_s", "cleansing_s", "join_s", "udf_s", "aggregate_s", "export_s", "total_s"
    }
    assert timed["total_s"] < 3 * plain["total_s"] and timed["export_s"] <= timed["total_s"]


@pytest.mark.parametrize("pipeline", [STRICT, KEYED])
@pytest.mark.parametrize("zones", ["LocationID,Borough,Zone\n", "LocationID,Borough,Zone\n1,,x\n"])
def test_a_run_without_usable_zones_records_its_counts(spark, inputs, tmp_path, pipeline, zones):
    (tmp_path / "zones.csv").write_text(zones)
    paths = [f"{tmp_path}/{n}" for n in ("rows", "summary", "metrics")]
    out = run(spark, inputs[0], str(tmp_path / "zones.csv"), *paths, pipeline)
    (doc,) = read_run_metrics(spark, paths[2]).collect()
    cleaned = pipeline.clean(derive.trips(spark, SMALL)).count()
    joined = pipeline.joined(derive.trips(spark, SMALL), read_zones(spark, str(tmp_path / "zones.csv"))).count()
    assert (doc.input_rows, doc.cleaned_rows, doc.joined_rows, doc.agg_rows) == (
        1150, cleaned, joined, out.count()
    )


def test_one_run_of_several_is_named(spark, inputs, tmp_path):
    paths = [f"{tmp_path}/{n}" for n in ("rows", "summary", "metrics")]
    for _ in range(2):
        run(spark, *inputs, *paths)
    metrics = read_run_metrics(spark, paths[2])
    with pytest.raises(ValueError, match="several runs"):
        recorded_funnel(metrics)
    with pytest.raises(ValueError, match="no runs named"):
        recorded_funnel(metrics, "none")
    assert recorded_funnel(metrics, metrics.head().run_id).count() == 4


def test_a_keyed_funnel_refuses_repeated_zones(spark):
    trips = derive.trips(spark, SMALL)
    zones = derive.zones(spark, SMALL)
    with pytest.raises(ValueError, match="more than once"):
        row_funnel(trips, trips, zones.union(zones), named_zones_only=True)


@pytest.mark.parametrize("pipeline", [STRICT, KEYED])
def test_funnel_equals_plain_counts(spark, pipeline):
    folder = str(TESTDATA / "sf0.01")
    trips, zones = derive.trips(spark, folder), derive.zones(spark, folder)
    cleaned = pipeline.clean(trips)
    funnel = row_funnel(trips, cleaned, zones, pipeline.named_zones_only)
    assert {r.stage: r.row_count for r in funnel.collect()} == {
        "input_rows": trips.count(),
        "cleaned_rows": cleaned.count(),
        "joined_rows": pipeline.join(cleaned, zones).count(),
        "agg_rows": pipeline.summary(trips, zones).count(),
    }


def test_funnel_counts_repeated_zones_and_cleans_once(spark):
    trips, zones = derive.trips(spark, SMALL), derive.zones(spark, SMALL)
    doubled = zones.unionByName(zones)
    funnel = row_funnel(trips, STRICT.clean(trips), doubled)
    got = {r.stage: r.row_count for r in funnel.collect()}
    assert (got["cleaned_rows"], got["joined_rows"]) == (1002, 2004)
    plan = final(funnel)
    assert "ReusedExchange" in plan
    assert plan.count("events.parquet") == 2


def test_no_python_and_no_cache_in_a_pipeline(spark):
    for pipeline in (STRICT, KEYED):
        plan = formatted(pipeline.summary(derive.trips(spark, SMALL), derive.zones(spark, SMALL)))
        assert "Python" not in plan and "InMemory" not in plan.replace("InMemoryFileIndex", "")


def test_commands(spark, inputs, tmp_path, capsys):
    def go(*words):
        return command.main([*words])

    for name in ("strict", "keyed"):
        assert go(
            "run", "--trips", inputs[0], "--zones", inputs[1], "--pipeline", name, "--timed",
            "--rows", f"{tmp_path}/{name}/rows", "--summary", f"{tmp_path}/{name}/summary",
            "--metrics", f"{tmp_path}/{name}/metrics",
        ) == 0
    strict, keyed = f"{tmp_path}/strict", f"{tmp_path}/keyed"
    assert go("reconcile", "--left", f"{strict}/summary", "--right", f"{strict}/summary") == 0
    capsys.readouterr()
    assert go(
        "reconcile", "--left", f"{strict}/summary", "--right", f"{keyed}/summary",
        "--left-metrics", f"{strict}/metrics", "--right-metrics", f"{keyed}/metrics",
    ) == 1
    said = dict(line.split(None, 1) for line in capsys.readouterr().out.splitlines())
    assert said == {
        "row_counts": "2 differ", "columns_present": "ok", "repeated_keys": "ok",
        "group_counts": "ok", "group_keys": "ok",
        "trip_counts": "38 differ", "mean_speeds": said["mean_speeds"],
    }
    with pytest.raises(SystemExit):
        go("reconcile", "--left", strict, "--right", keyed, "--left-metrics", f"{strict}/metrics")
    assert go(
        "compare", "--metrics", f"{strict}/metrics", f"{keyed}/metrics", "--left", "strict",
        "--right", "keyed", "--table", f"{tmp_path}/table",
    ) == 0
    (table,) = (tmp_path / "table").glob("*.csv")
    rows = list(csv.DictReader(table.read_text().splitlines()))
    assert [r["phase"] for r in rows] == [
        "Ingest", "Clean", "Join", "UDF", "Aggregate", "Export", "Total"
    ]
    long = phases_long(read_run_metrics(spark, f"{strict}/metrics"))
    recorded = {r.phase: r.seconds for r in long.collect()}
    assert float(rows[-1]["left_s"]) == recorded["total_s"]
    funnel = recorded_funnel(read_run_metrics(spark, f"{keyed}/metrics"))
    assert funnel.count() == 4


def test_metrics_are_one_document_per_line(spark, inputs, tmp_path):
    run(spark, *inputs, *(f"{tmp_path}/{n}" for n in ("rows", "summary", "metrics")))
    (part,) = [p for p in (tmp_path / "metrics").glob("part-*") if p.stat().st_size]
    assert json.loads(part.read_text())["framework"] == "strict"
