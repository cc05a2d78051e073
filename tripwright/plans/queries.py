"""The registered queries: every operator over whole test tables.

Each takes a session and a folder of tables and returns a DataFrame. Timestamps are shown as
wall-clock values and means are rounded, so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwright.contract import Contract
from tripwright.functions.speed import speed_mph, speed_mph_by_batch, speed_mph_by_row
from tripwright.operators import clean, enrich, reconcile, runs, summarise
from tripwright.operators.funnel import row_funnel
from tripwright.plans import derive
from tripwright.plans.pipeline import KEYED, STRICT, Pipeline, compare
from tripwright.session import use_utc, work_dir
from tripwright.operators.summarise import speed_by_group_unsorted
from tripwright.sinks import published
from tripwright.sinks.files import write_comparison, write_rows, write_run_metrics, write_summary
from tripwright.sources import files, records, tables

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(body: Query) -> Query:
    """Register a query under its function's name, with the session set and times shown."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        use_utc(spark)
        return shown(body(spark, folder))

    REGISTRY[body.__name__] = run
    return run


def shown(df: DataFrame) -> DataFrame:
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


Inputs = tuple[DataFrame, DataFrame]


def inputs(spark: SparkSession, folder: str) -> Inputs:
    return derive.trips(spark, folder), derive.zones(spark, folder)


def summary_of(pipeline: Pipeline, spark: SparkSession, folder: str) -> DataFrame:
    return rounded(pipeline.summary(*inputs(spark, folder)), "mean_speed_mph")


def funnel_of(pipeline: Pipeline, given: Inputs) -> DataFrame:
    trips, zones = given
    return row_funnel(trips, pipeline.clean(trips), zones, pipeline.named_zones_only)


# --- sources and sinks ---


@query
def scan_normalized(spark: SparkSession, folder: str) -> DataFrame:
    """Trips written in three drifting layouts by kind of payment, read back as one table."""
    trips = derive.trips(spark, folder)
    root = work_dir(spark, "drift")
    kind = F.coalesce(F.col("payment_type"), F.lit(0))
    narrow = {c: F.col(c).cast("int") for c in ("VendorID", "PULocationID", "DOLocationID")}
    whole = {"passenger_count": F.col("passenger_count").cast("bigint")}
    local = {
        c: F.col(c).cast("timestamp_ntz")
        for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")
    }
    trips.filter(kind < 5).withColumns(narrow).write.parquet(f"{root}/a")
    # One layout holds a column in the names of its folders, one lies deeper, and its files,
    # copied under other names, have no suffix.
    by_kind = trips.filter(kind == 5).withColumns(whole | local)
    by_kind.write.partitionBy("payment_type").parquet(f"{root}/b")
    cased = trips.filter(kind > 5)
    cased.toDF(*[c.upper() for c in cased.columns]).write.parquet(f"{root}/c/2024/[01]")
    without_suffix(spark, f"{root}/c/2024/[01]")
    return tables.read_normalized(spark, root)


def without_suffix(spark: SparkSession, folder: str) -> None:
    """Take the suffix off the names of a folder's parquet files."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for file in store.listStatus(path):
        name = file.getPath().getName()
        if name.endswith(".parquet"):
            store.rename(file.getPath(), jvm.org.apache.hadoop.fs.Path(path, name.split(".")[0]))


@query
def scan_directory(spark: SparkSession, folder: str) -> DataFrame:
    """Events written in two goes to one folder, read as they are."""
    events = derive.table(spark, folder, "events")
    root = work_dir(spark, "parts")
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    events.filter(~late).write.parquet(root)
    events.filter(F.coalesce(late, F.lit(True))).write.mode("append").parquet(root)
    return tables.read_directory(spark, root)


@query
def scan_csv_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """Zones by way of a delimited file with a header."""
    root = work_dir(spark, "zones")
    derive.zones(spark, folder).write.option("header", True).csv(root)
    return tables.read_zones(spark, root)


@query
def sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Enriched rows written once, and from there twice over the same place, then read back."""
    root = work_dir(spark, "rows")
    write_rows(STRICT.enriched(*inputs(spark, folder)), f"{root}/once")
    once = tables.read_directory(spark, f"{root}/once")
    write_rows(once, f"{root}/twice")
    write_rows(once, f"{root}/twice")
    return tables.read_directory(spark, f"{root}/twice")


@query
def sink_append(spark: SparkSession, folder: str) -> DataFrame:
    """Enriched rows of either vendor written one after the other to one place."""
    trips, zones = inputs(spark, folder)
    root = work_dir(spark, "appended")
    first = F.col("VendorID") == 1
    write_rows(STRICT.enriched(trips.filter(first), zones), root, append=True)
    write_rows(STRICT.enriched(trips.filter(~first), zones), root, append=True)
    return tables.read_directory(spark, root)


@query
def sink_published(spark: SparkSession, folder: str) -> DataFrame:
    """Enriched rows as readers of a result folder see them, after one run was replaced by
    another, the rows of a third were added, and a fourth never came to be published."""
    trips, zones = inputs(spark, folder)
    root = work_dir(spark, "published")
    first = F.col("VendorID") == 1

    def draft(part: DataFrame) -> published.Draft:
        own = published.draft(spark, root)
        write_rows(STRICT.enriched(part, zones), f"{own.folder}/rows")
        return own

    published.publish(spark, draft(trips))
    published.publish(spark, draft(trips.filter(first)))
    published.publish(spark, draft(trips.filter(~first)), append=True)
    draft(trips)
    return published.read_rows(spark, root)


@query
def sink_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """The comparison of phases by way of the delimited file it is written to."""
    root = work_dir(spark, "comparison")
    compared = runs.compare_runs(derive.phase_seconds(spark, folder), "left", "right")
    write_comparison(runs.name_phases(compared), root)
    read = spark.read.option("header", True).csv(root)
    numbers = ("left_s", "right_s", "ratio")
    return read.select("phase", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in numbers])


@query
def sink_summary_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The speed summary taken from written rows, written as one file and read back."""
    enriched = STRICT.enriched(derive.trips(spark, folder), derive.zones(spark, folder))
    root = work_dir(spark, "summary")
    write_rows(enriched, f"{root}/rows")
    written = tables.read_directory(spark, f"{root}/rows")
    write_summary(summarise.speed_by_group(written), f"{root}/summary")
    return rounded(tables.read_directory(spark, f"{root}/summary"), "mean_speed_mph")


@query
def source_volume(spark: SparkSession, folder: str) -> DataFrame:
    """Files and rows of every table."""
    paths = {name: f"{folder}/{name}.parquet" for name in derive.TABLES}
    return files.source_volume(spark, paths).select("table_name", "files", "row_count")


# --- projections and set operations ---

ORDERS = Contract.of(
    {
        "O_OrderKey": T.IntegerType(),
        "O_CustKey": T.DoubleType(),
        "O_OrderDate": T.TimestampType(),
        "O_TotalPrice": T.DoubleType(),
        "O_OrderStatus": T.StringType(),
        "O_Clerk": T.StringType(),
    },
    required=["O_OrderKey"],
)


@query
def project_contract(spark: SparkSession, folder: str) -> DataFrame:
    """Orders laid under a contract with other types, other letter case and one column more."""
    return ORDERS.project(derive.table(spark, folder, "orders"), "orders")


@query
def union_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """Line items put together again from two parts whose columns stand in opposite order."""
    lines = derive.table(spark, folder, "lineitem")
    returned = F.coalesce(F.col("l_returnflag") == "R", F.lit(False))
    other = lines.filter(~returned).select(lines.columns[::-1])
    return tables.union_by_name([lines.filter(returned), other])


# --- cleaning ---


@query
def filter_required(spark: SparkSession, folder: str) -> DataFrame:
    return clean.drop_incomplete(derive.trips(spark, folder))


@query
def dedup_full_row(spark: SparkSession, folder: str) -> DataFrame:
    return clean.drop_copies(clean.drop_incomplete(derive.trips(spark, folder)))


@query
def derive_duration(spark: SparkSession, folder: str) -> DataFrame:
    """Duration and hour of every event that has both of its times."""
    timed = clean.add_duration(clean.drop_incomplete(derive.trips(spark, folder)))
    return enrich.add_hour(timed)


@query
def filter_ranges(spark: SparkSession, folder: str) -> DataFrame:
    return clean.clean(derive.trips(spark, folder))


@query
def dedup_by_keys(spark: SparkSession, folder: str) -> DataFrame:
    """One trip per key, out of the trips left after full-row copies are gone."""
    return clean.drop_copies_by_key(clean.clean(derive.trips(spark, folder)))


@query
def clean_keyed(spark: SparkSession, folder: str) -> DataFrame:
    """One trip per key, straight from the raw trips."""
    return clean.clean_by_key(derive.trips(spark, folder))


# --- joins and speed ---


@query
def join_zone_inner(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = clean.clean(derive.trips(spark, folder))
    return enrich.join_zone(cleaned, derive.zones(spark, folder))


@query
def join_zone_merge(spark: SparkSession, folder: str) -> DataFrame:
    trips = derive.trips(spark, folder)
    return enrich.join_zone_merge(clean.clean(trips), derive.zones(spark, folder), like=trips)


@query
def join_lookup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = clean.clean_by_key(derive.trips(spark, folder))
    return enrich.look_up_zone(cleaned, derive.zones(spark, folder))


@query
def speed_native(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.add_speed(clean.clean(derive.trips(spark, folder)), speed_mph)


@query
def speed_udf_row(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.add_speed(clean.clean(derive.trips(spark, folder)), speed_mph_by_row)


@query
def speed_udf_pandas(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.add_speed(clean.clean(derive.trips(spark, folder)), speed_mph_by_batch)


# --- pipelines ---


@query
def trips_enriched(spark: SparkSession, folder: str) -> DataFrame:
    return STRICT.enriched(derive.trips(spark, folder), derive.zones(spark, folder))


@query
def trips_enriched_keyed(spark: SparkSession, folder: str) -> DataFrame:
    return KEYED.enriched(derive.trips(spark, folder), derive.zones(spark, folder))


@query
def speed_by_hour_borough(spark: SparkSession, folder: str) -> DataFrame:
    return summary_of(STRICT, spark, folder)


@query
def speed_by_hour_borough_keyed(spark: SparkSession, folder: str) -> DataFrame:
    return summary_of(KEYED, spark, folder)


@query
def pipeline_funnel(spark: SparkSession, folder: str) -> DataFrame:
    return funnel_of(STRICT, inputs(spark, folder))


# --- reconciling the two pipelines ---


@query
def reconcile_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    given = inputs(spark, folder)
    return reconcile.compare_row_counts(funnel_of(STRICT, given), funnel_of(KEYED, given))


def both_summaries(given: Inputs) -> tuple[DataFrame, DataFrame]:
    """Both pipelines' summaries, exact and in no order: nothing shows or writes them."""
    strict, keyed = (speed_by_group_unsorted(p.enriched(*given)) for p in (STRICT, KEYED))
    return strict, keyed


@query
def reconcile_groups(spark: SparkSession, folder: str) -> DataFrame:
    compared = reconcile.compare_groups(*both_summaries(inputs(spark, folder)))
    return compared.select("pickup_hour", "Borough", "left_count", "right_count", "status")


@query
def reconcile_summary(spark: SparkSession, folder: str) -> DataFrame:
    compared = reconcile.compare_groups(*both_summaries(inputs(spark, folder)))
    return rounded(reconcile.summarise_groups(compared), "largest_mean_diff")


@query
def reconcile_key_diff(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.key_difference(*both_summaries(inputs(spark, folder)))


@query
def reconcile_schema(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.schema_check(*both_summaries(inputs(spark, folder)))


@query
def reconcile_report(spark: SparkSession, folder: str) -> DataFrame:
    return compare(STRICT, KEYED, *inputs(spark, folder))


# --- run metrics and resource logs ---


@query
def run_metrics_long(spark: SparkSession, folder: str) -> DataFrame:
    """Phase seconds of every run, by way of metrics documents on disk."""
    root = work_dir(spark, "metrics")
    write_run_metrics(derive.run_documents(spark, folder), root)
    return rounded(runs.phases_long(records.read_run_metrics(spark, root)), "seconds")


@query
def run_metrics_compare(spark: SparkSession, folder: str) -> DataFrame:
    compared = runs.compare_runs(derive.phase_seconds(spark, folder), "left", "right")
    return rounded(runs.name_phases(compared), "left_s", "right_s", "ratio")


@query
def run_metrics_repeat(spark: SparkSession, folder: str) -> DataFrame:
    spread = runs.repeat_spread(derive.phase_seconds(spark, folder))
    return rounded(spread, "median_s", "iqr_s")


@query
def resource_peaks(spark: SparkSession, folder: str) -> DataFrame:
    """Peaks per label, by way of sampled log lines on disk."""
    root = work_dir(spark, "logs")
    derive.log_lines(spark, folder).write.partitionBy("log").text(root)
    samples = runs.parse_resource_log(records.read_log_lines(spark, root))
    return rounded(runs.resource_peaks(samples), "peak_cpu", "peak_mem_mb")
