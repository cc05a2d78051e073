"""Reading trips and zones, and results this library wrote."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwright.contract import TRIPS, ZONES, Contract, ContractError
from tripwright.sources.files import (
    NotParquetError,
    Run,
    first_fault,
    layout_runs,
    literal_path,
    manifest,
    whole_folders,
)


# Ranges of file names that one scan may be restricted to.
RANGES_PER_SCAN = 200
# Fixed value: how a null is written in the name of a folder.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def read_normalized(
    spark: SparkSession, paths: str | Sequence[str], contract: Contract = TRIPS
) -> DataFrame:
    """Read parquet files whose schemas drift as one table with the contract's schema.

    Neither schema merging nor one imposed schema covers files that store the same column as
    integer here and as double there. So files are grouped by how they store the contract's
    columns, each group is read by one scan and projected to the contract, and the scans are
    put together by name. Filters and column choice still reach each of them. Files may lie at
    any depth and bear any name; columns that stand in ``name=value`` folders are columns like
    others.

    The files and their layouts are a table (see ``manifest``). The driver gets where layouts
    change in the order of names: a folder whose files are all laid out alike is read as a
    folder; where layouts lie side by side, a scan of what was asked for is restricted to
    ranges of file names, by which Spark leaves the other files out before it opens any.
    """
    files = manifest(spark, paths, contract.names, contract.required)
    fault = first_fault(files)
    if fault is not None and fault.no_parquet:
        raise NotParquetError(f"not a parquet file: {fault.path}")
    if fault is not None and fault.clash:
        first, second = fault.clash
        raise ContractError(f"{fault.path}: columns {first!r} and {second!r} differ only by case")
    if fault is not None:
        raise ContractError(f"{fault.path}: required columns are missing: {fault.absent}")
    runs = layout_runs(files)
    given = [paths] if isinstance(paths, str) else list(paths)
    kinds: dict[tuple, list[Run]] = {}
    for run in runs:
        kinds.setdefault((run.layout, run.folders), []).append(run)
    scans = []
    for own in kinds.values():
        one = own[0]
        schema, where = _stored(spark, one, contract), unquote(one.first)
        folders = given if len(runs) == 1 else whole_folders(spark, runs, own)
        if folders:
            scans.append(contract.project(_scan(spark, folders, schema, one.folders), where))
            continue
        for k in range(0, len(own), RANGES_PER_SCAN):
            scan = _scan(spark, given, schema, one.folders, own[k : k + RANGES_PER_SCAN])
            scans.append(contract.project(scan, where))
    return union_by_name(scans)


def _stored(spark: SparkSession, kind: Run, contract: Contract) -> T.StructType:
    """How the files of a kind store the contract's columns, from one of them."""
    names = {n.lower() for n in contract.names}
    fields = spark.read.parquet(literal_path(unquote(kind.first))).schema
    return T.StructType([f for f in fields if f.name.lower() in names and f.name not in kind.folders])


def _scan(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType, folders: Sequence[str], runs: Sequence[Run] = ()
) -> DataFrame:
    """Files of one layout, with the columns in the names of their folders as text."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*paths)
    file = F.col("_metadata.file_path")
    if runs:
        rows = rows.filter(reduce(Column.__or__, [file.between(r.first, r.last) for r in runs]))
    path = _decoded(file)
    found = {f: F.regexp_extract(path, f"^.*/{re.escape(f)}=([^/]*)/", 1) for f in folders}
    values = {f: F.when(v != NULL_FOLDER, F.coalesce(F.try_url_decode(F.replace(v, F.lit("+"), F.lit("%2B"))), v)) for f, v in found.items()}
    return rows.select(*[F.col(f"`{f.name}`") for f in schema], *[v.alias(f) for f, v in values.items()])


def _decoded(uri: Column) -> Column:
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def union_by_name(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts, columns matched by name; raises if a part lacks a column."""
    if not parts:
        raise ValueError("nothing to put together")
    return reduce(DataFrame.unionByName, parts)


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    """Read parquet as it is: a folder of parts or a single file."""
    return spark.read.parquet(path)


def read_zones(
    spark: SparkSession, path: str, contract: Contract = ZONES, null_text: str = ""
) -> DataFrame:
    """Read a zone file: delimited text with a header.

    Columns are found by header name, so the file may order them freely and hold others.
    Their types are given, not inferred. Empty fields and ``null_text`` read as null; "N/A"
    is a name like any other unless given as that text.
    """
    raw = spark.read.option("header", True).option("nullValue", null_text).csv(path)
    return contract.project(raw, path)
