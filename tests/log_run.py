"""A process of its own that keeps an event log: runs pipelines timed by the log.

python log_run.py FOLDER TRIPS ZONES ROLLING [RUNS] prints one JSON line. RUNS repeats untimed
and timed runs by turns, to compare what they take.
"""

from __future__ import annotations

import json
import sys
import time
from dataclasses import replace
from functools import partial
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tripwright.operators.stages import step_seconds  # noqa: E402
from tripwright.plans.pipeline import KEYED, STRICT, run  # noqa: E402
from tripwright.sources import events  # noqa: E402
from tripwright.sources.records import read_run_metrics  # noqa: E402


def main(folder: str, trips: str, zones: str, rolling: str, runs: str = "0") -> None:
    Path(folder, "log").mkdir()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", rolling)
        .config("spark.eventLog.dir", f"file://{folder}/log")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    merged = replace(STRICT, name="merged", join=partial(STRICT.join, broadcast_limit=0))
    said = {}
    for p in (STRICT, KEYED, merged):
        spent = {}
        for timed in (False, *[False, "log"] * int(runs)) if int(runs) else ("log",):
            start = time.perf_counter()
            paths = [f"{folder}/{p.name}/{timed}/{n}" for n in ("rows", "summary", "metrics")]
            run(spark, trips, zones, *paths, p, timed=timed)
            spent.setdefault(str(timed), []).append(time.perf_counter() - start)
        (doc,) = read_run_metrics(spark, paths[2]).tail(1)
        stages = events.read_stages(spark, events.log_path(spark), doc.run_id)
        again = {r.phase: r.seconds for r in step_seconds(stages).collect()}
        table = [r.asDict() for r in stages.orderBy("stage").collect()]
        said[p.name] = {"phases": doc.phases, "again": again, "stages": table, "spent": spent}
    none = events.read_stages(spark, events.log_path(spark), "no such run")
    said["none"] = [tuple(r) for r in step_seconds(none).collect()]
    print(json.dumps(said))


if __name__ == "__main__":
    main(*sys.argv[1:])
