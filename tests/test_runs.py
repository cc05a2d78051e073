from __future__ import annotations

from pyspark.sql import functions as F

from tripwright.operators import runs
from tripwright.sources import records


def long(spark, *rows):
    return spark.createDataFrame(list(rows), "variant string, phase string, seconds double")


def test_total_is_what_was_recorded_and_comes_last(spark):
    table = runs.name_phases(
        runs.compare_runs(
            long(
                spark,
                ("a", "total_s", 9.0), ("b", "total_s", 3.0),
                ("a", "join_s", 1.0), ("b", "join_s", 4.0),
                ("a", "ingestion_s", 2.0), ("b", "ingestion_s", 0.0),
                ("a", "extra_s", 1.0),
            ),
            "a",
            "b",
        )
    )
    assert list(map(tuple, table.collect())) == [
        ("Ingest", 2.0, 0.0, None),
        ("Join", 1.0, 4.0, 0.25),
        ("Total", 9.0, 3.0, 3.0),
        ("extra_s", 1.0, None, None),
    ]


def test_repeated_runs(spark):
    rows = [("a", "join_s", float(v)) for v in (5, 1, 2, 4, 3)] + [("b", "join_s", 7.0)]
    got = {tuple(r) for r in runs.repeat_spread(long(spark, *rows)).collect()}
    assert got == {("a", "join_s", 3.0, 2.0), ("b", "join_s", 7.0, 0.0)}


def test_log_lines_of_both_systems(spark, tmp_path):
    (tmp_path / "top_linux.log").write_text(
        "[2024-01-01T10:00:00+00:00] %Cpu(s):  2.0 us,  1.1 sy,  0.0 ni, 95.9 id,  0.0 wa"
        " | mem_used_mb=1234 mem_total_mb=8000\n"
        "[2024-01-01T12:00:02+02:00] %Cpu(s): 50.0 us,  0.0 sy,  0.0 ni, 50.0 id,  0.0 wa"
        " | mem_used_mb=1000 mem_total_mb=8000\n"
        "garbled\n"
    )
    (tmp_path / "top_mac.log").write_text(
        "[2024-01-01T10:00:00+00:00] CPU usage: 5.0% user, 10.5% sys, 84.5% idle"
        " | PhysMem: 15G used (2341M wired), 654M unused.\n"
    )
    samples = runs.parse_resource_log(records.read_log_lines(spark, str(tmp_path)))
    times = samples.filter("label = 'linux' and sampled_at is not null")
    assert sorted(r[0] for r in times.select(F.unix_seconds("sampled_at")).collect()) == [
        1704103200, 1704103202
    ]
    assert samples.filter("cpu_pct is null and mem_mb is null").count() == 1
    peaks = runs.resource_peaks(samples).collect()
    got = {r.label: (round(r.peak_cpu, 6), r.peak_mem_mb) for r in peaks}
    assert got == {"linux": (50.0, 1234.0), "mac": (15.5, 15360.0)}
