"""Command line: run a pipeline, reconcile two results, compare recorded runs.

python -m tripwright run --trips DIR --zones FILE --result DIR
python -m tripwright run --trips DIR --zones FILE --rows DIR --summary DIR --metrics DIR
python -m tripwright reconcile --left DIR --right DIR --left-metrics DIR --right-metrics DIR
python -m tripwright compare --metrics DIR [DIR ...] --left NAME --right NAME --table DIR
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession

from tripwright.operators import reconcile, runs
from tripwright.operators.funnel import recorded_funnel
from tripwright.plans.pipeline import KEYED, STRICT, run, run_published
from tripwright.session import use_utc
from tripwright.sinks import published
from tripwright.sinks.files import write_comparison
from tripwright.sources.records import read_run_metrics
from tripwright.sources.tables import read_directory

PIPELINES = {p.name: p for p in (STRICT, KEYED)}


def arguments(given: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tripwright", description=__doc__)
    parser.add_argument("--master", default=os.environ.get("MASTER_URL"))
    commands = parser.add_subparsers(dest="command", required=True)

    c = commands.add_parser("run")
    for name in ("trips", "zones"):
        c.add_argument(f"--{name}", required=True)
    c.add_argument("--result", help="folder in which rows, summary and metrics are published together")
    c.add_argument("--append", action="store_true", help="keep the published rows beside the new ones")
    for name in ("rows", "summary", "metrics"):
        c.add_argument(f"--{name}")
    c.add_argument("--pipeline", choices=sorted(PIPELINES), default=STRICT.name)
    c.add_argument(
        "--timed",
        nargs="?",
        const="repeat",
        default=False,
        choices=("log", "repeat"),
        help="also record seconds per phase: from the session's event log, or by running steps again",
    )

    c = commands.add_parser("reconcile")
    for name in ("left", "right"):
        c.add_argument(f"--{name}", required=True)
        c.add_argument(f"--{name}-metrics", help="metrics, of that run alone or with --run")
        c.add_argument(f"--{name}-run", help="which run of the metrics")
    c.add_argument("--tolerance", type=float, default=reconcile.SPEED_TOLERANCE)

    c = commands.add_parser("compare")
    c.add_argument("--metrics", nargs="+", required=True)
    c.add_argument("--left", required=True)
    c.add_argument("--right", required=True)
    c.add_argument("--table", required=True)
    return parser.parse_args(given)


def session(master: str | None) -> SparkSession:
    builder = SparkSession.builder.appName("tripwright")
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    use_utc(spark)
    return spark


def _summary(spark: SparkSession, path: str) -> DataFrame:
    """A summary by itself, or that of a result folder's last published run."""
    if published.is_result(spark, path):
        return published.read_summary(spark, path)
    return read_directory(spark, path)


def reconciled(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    recorded = ((args.left_metrics, args.left_run), (args.right_metrics, args.right_run))
    funnels = [recorded_funnel(read_run_metrics(spark, p), run_id) for p, run_id in recorded if p]
    if len(funnels) == 1:
        raise SystemExit("give the metrics of both runs, or of neither")
    if not funnels and all(published.is_result(spark, p) for p in (args.left, args.right)):
        funnels = [recorded_funnel(published.read_metrics(spark, p)) for p in (args.left, args.right)]
    return reconcile.report(
        _summary(spark, args.left),
        _summary(spark, args.right),
        *(funnels or [None, None]),
        tolerance=args.tolerance,
    )


def main(given: list[str] | None = None) -> int:
    args = arguments(given)
    spark = session(args.master)
    if args.command == "run" and args.result:
        run_published(
            spark, args.trips, args.zones, args.result, PIPELINES[args.pipeline], args.timed, args.append
        )
        return 0
    if args.command == "run":
        if not (args.rows and args.summary):
            raise SystemExit("give --result, or --rows and --summary")
        run(
            spark,
            args.trips,
            args.zones,
            args.rows,
            args.summary,
            args.metrics,
            PIPELINES[args.pipeline],
            args.timed,
        )
        return 0
    if args.command == "reconcile":
        # A handful of rows, one per check.
        checks = reconciled(spark, args).collect()
        for check in checks:
            print(f"{check.check:16} {'ok' if check.ok else f'{check.failures} differ'}")
        return 0 if all(check.ok for check in checks) else 1
    long = runs.phases_long(read_run_metrics(spark, args.metrics))
    compared = runs.name_phases(runs.compare_runs(long, args.left, args.right))
    write_comparison(compared, args.table)
    return 0


if __name__ == "__main__":
    sys.exit(main())
