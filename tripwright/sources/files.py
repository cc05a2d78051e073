"""Listing parquet files and reading their footers."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Collection, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.session import work_dir

MANIFEST_NAMES = ["path", "layout", "folders", "clash", "absent", "reached"]
MANIFEST_COLUMNS = (
    "path string, layout string, folders array<string>, clash array<string>, absent array<string>, reached boolean"
)
RUN_NAMES = ["layout", "folders", "first_path", "last_path", "files"]
RUN_COLUMNS = "layout string, folders array<string>, first_path string, last_path string, files long"
# Footers per task: each costs one or two small reads.
FILES_PER_TASK = 64
# Footers that Spark reads at a time where the tasks cannot.
CONCURRENT_READS = 16


class NoInputError(FileNotFoundError):
    """There is nothing to read where input was expected."""


class NotParquetError(ValueError):
    """A file among the input is not parquet."""


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    """Sorted paths of all files under folders, files or globs, at any depth and by any name.

    Spark does the listing, so any file system it can read will do, and for long listings it
    works in parallel. Names that begin with ``_`` or ``.`` are not data. Only names come
    back; no file is opened.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    found: list[str] = []
    if paths:
        found = sorted(unquote(uri) for uri in _binary(spark, paths).inputFiles())
    if not found:
        raise NoInputError(f"no files under {paths}")
    return found


def literal_path(path: str) -> str:
    """The path with the characters escaped that would make it a pattern."""
    return "".join(f"\\{c}" if c in "[]{}*?\\" else c for c in path)


def folder_columns(path: str) -> tuple[str, list[str]]:
    """The folder above a file's ``name=value`` folders, and their names."""
    parts = path.split("/")
    first = len(parts) - 1
    while first > 0 and "=" in parts[first - 1]:
        first -= 1
    return "/".join(parts[:first]), [p.split("=", 1)[0] for p in parts[first:-1]]


def _facts(columns: Sequence[tuple[str, str]], folders: Sequence[str], wanted: Collection[str], required: Sequence[str]):
    """Layout of the wanted columns, names that clash by case, and required names not there."""
    seen: dict[str, str] = {}
    clash: list[str] = []
    for name in [n for n, _ in columns] + [f for f in folders if f not in {n for n, _ in columns}]:
        other = seen.setdefault(name.lower(), name)
        if other != name and not clash:
            clash = [other, name]
    held = sorted((n, t) for n, t in columns if n.lower() in wanted)
    layout = hashlib.sha256(repr((held, list(folders))).encode()).hexdigest()
    return layout, clash, [n for n in required if n.lower() not in seen]


def listed(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path) of all files under folders, files or globs, as Spark names them (as URIs).

    Names go from Spark's listing into a table without passing through Python; no file is opened.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        raise NoInputError("no paths")
    files = _binary(spark, paths)
    n = _count_files(files)
    if not n:
        raise NoInputError(f"no files under {paths}")
    return files.select(F.col("_metadata.file_path").alias("path")).repartition(-(-n // FILES_PER_TASK))


def _binary(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)


def _count_files(df: DataFrame) -> int:
    """How many files a scan has, told by Spark's listing; their names stay there."""
    return len(df._jdf.inputFiles())


def manifest(
    spark: SparkSession, paths: str | Sequence[str], wanted: Sequence[str], required: Sequence[str]
) -> DataFrame:
    """One row per file: (path, layout, folders, clash, absent), written to the shared folder.

    ``layout`` digests how the file stores the ``wanted`` columns and is null if it is no
    parquet, ``folders`` names the columns that stand in ``name=value`` folders above it,
    ``clash`` two names that differ only by case, ``absent`` the required columns not there.
    Footers are read and judged in tasks, so a hundred thousand files are one short job. Files
    in a store that Python cannot open are judged by Spark, one by one.
    """
    lowered = frozenset(w.lower() for w in wanted)
    required = list(required)
    judge: Callable = _facts
    split: Callable = folder_columns

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        def one(uri: str) -> tuple:
            path = unquote(uri)
            scheme, _, rest = path.partition(":")
            folders = split(path)[1]
            try:
                if scheme == "file":
                    source = fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
                else:
                    store, inner = fs.FileSystem.from_uri(path)
                    source = store.open_input_file(inner)
            except (ValueError, OSError, ImportError):
                return uri, None, folders, [], [], False
            with source:
                try:
                    columns = [(f.name, str(f.type)) for f in pq.read_schema(source)]
                except pa.ArrowInvalid:
                    return uri, None, folders, [], [], True
            layout, clash, absent = judge(columns, folders, lowered, required)
            return uri, layout, folders, clash, absent, True

        for batch in batches:
            yield pd.DataFrame([one(p) for p in batch["path"]], columns=MANIFEST_NAMES)

    root = work_dir(spark, "manifest")
    listed(spark, paths).mapInPandas(read, MANIFEST_COLUMNS).write.parquet(f"{root}/judged")
    judged = spark.read.schema(MANIFEST_COLUMNS).parquet(f"{root}/judged")
    reached = judged.filter("reached").drop("reached")

    def by_spark(uri: str) -> tuple:
        path = unquote(uri)
        folders = folder_columns(path)[1]
        fields = spark.read.parquet(literal_path(path)).schema
        layout, clash, absent = _facts([(f.name, f.dataType.simpleString()) for f in fields], folders, lowered, required)
        return uri, layout, folders, clash, absent

    unreached = [r.path for r in judged.filter("not reached").select("path").toLocalIterator()]
    if not unreached:
        return reached
    with ThreadPoolExecutor(CONCURRENT_READS) as pool:
        rows = list(pool.map(by_spark, unreached))
    return reached.unionByName(spark.createDataFrame(rows, reached.schema))


@dataclass(frozen=True)
class Fault:
    """The first file, by name, of those that cannot be read as they should, and why."""

    path: str
    no_parquet: bool
    clash: list[str]
    absent: list[str]


def first_fault(files: DataFrame) -> Fault | None:
    wrong = files.filter("layout is null or size(clash) > 0 or size(absent) > 0")
    rows = wrong.orderBy(F.col("layout").isNotNull(), "path").limit(1).collect()
    return Fault(unquote(rows[0].path), rows[0].layout is None, rows[0].clash, rows[0].absent) if rows else None


@dataclass(frozen=True)
class Run:
    """Files that follow each other by name and are laid out alike."""

    layout: str
    folders: tuple[str, ...]
    first: str
    last: str
    files: int


def layout_runs(files: DataFrame) -> list[Run]:
    """The runs of a manifest, in order of names.

    Names are sorted and cut into runs in tasks: what comes to the driver is a row per change
    of layout in the order of names, and one per task, however many files there are.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list | None = None
        for batch in batches:
            rows = []
            for path, layout, folders in zip(batch["path"], batch["layout"], batch["folders"]):
                if held is not None and (held[0], held[1]) == (layout, list(folders)):
                    held[3], held[4] = path, held[4] + 1
                    continue
                if held is not None:
                    rows.append(held)
                held = [layout, list(folders), path, path, 1]
            yield pd.DataFrame(rows, columns=RUN_NAMES)
        if held is not None:
            yield pd.DataFrame([held], columns=RUN_NAMES)

    spark = files.sparkSession
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 64)
    ordered = files.repartitionByRange(parts, "path").sortWithinPartitions("path")
    found = ordered.select("path", "layout", "folders").mapInPandas(cut, RUN_COLUMNS).collect()
    runs: list[Run] = []
    for r in sorted(found, key=lambda r: r.first_path.encode()):
        own = Run(r.layout, tuple(r.folders), r.first_path, r.last_path, r.files)
        if runs and (runs[-1].layout, runs[-1].folders) == (own.layout, own.folders):
            before = runs.pop()
            own = replace(own, first=before.first, files=before.files + own.files)
        runs.append(own)
    return runs


def whole_folders(spark: SparkSession, runs: Sequence[Run], own: Sequence[Run]) -> list[str]:
    """Folders that hold the files of these runs out of ``runs`` and nothing else; else none."""
    at = {run: k for k, run in enumerate(runs)}
    out = []
    for run in own:
        folder = run.first[: run.first.rindex("/") + 1]
        while not run.last.startswith(folder) and folder.count("/") > 1:
            folder = folder[: folder.rindex("/", 0, -1) + 1]
        k = at[run]
        neighbours = [r.last for r in runs[max(0, k - 1) : k]] + [r.first for r in runs[k + 1 : k + 2]]
        at_root = "/" not in folder.rstrip("/")
        if at_root or not run.last.startswith(folder) or any(n.startswith(folder) for n in neighbours):
            return []
        out.append((literal_path(unquote(folder.rstrip("/"))), run.files))
    # What was asked for may be less than what the folders hold.
    return [p for p, _ in out] if all(_count_files(_binary(spark, p)) == n for p, n in out) else []


def source_volume(spark: SparkSession, sources: dict[str, str]) -> DataFrame:
    """(table_name, files, bytes, row_count) per named parquet source.

    No column is read: row counts come from the files' own metadata and each task combines
    its rows per file before the shuffle.
    """
    parts: DataFrame | None = None
    for name, path in sources.items():
        scan = spark.read.parquet(path).select(
            F.lit(name).alias("table_name"),
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_size").alias("size"),
        )
        parts = scan if parts is None else parts.unionByName(scan)
    if parts is None:
        raise NoInputError("no sources named")
    per_file = parts.groupBy("table_name", "path", "size").agg(F.count("*").alias("n"))
    return per_file.groupBy("table_name").agg(
        F.count("*").alias("files"), F.sum("size").alias("bytes"), F.sum("n").alias("row_count")
    )
