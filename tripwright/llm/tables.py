"""Reading the given tables, tables written on the way, and helpers for Arrow tasks."""

from __future__ import annotations

import pickle
import weakref
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.session import work_dir

#: Rows handled at a time inside a task, so that its arrays follow the texts of these rows only.
ROWS = 256
PIECE_BYTES = 1 << 20
#: Removes the shuffle files of a query when it ends; else they stay until the driver collects garbage.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The same rows read back from the shared folder: lineage ends, no executor is needed.

    What was shuffled for them is removed at once.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark, label)}/rows"
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEAN)
        else:
            spark.conf.set(_CLEAN, before)
    rows = spark.read.schema(df.schema).parquet(path)
    _PATHS[rows] = path
    return rows


def discard(rows: DataFrame) -> None:
    """Delete what ``written`` gave back, once nothing reads it any more."""
    jvm = rows.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_PATHS.pop(rows))
    path.getFileSystem(rows.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pieces(
    batches: Iterator[pa.RecordBatch], rows: int = ROWS, size: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of ``rows`` rows or ``size`` bytes of text at most, of one row at least."""
    for batch in batches:
        at, n = 0, batch.num_rows
        sizes = np.zeros(n, np.int64)
        if "text" in batch.schema.names and n:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        while at < n:
            full = ends[at] - sizes[at] + size
            stop = min(at + rows, max(at + 1, int(np.searchsorted(ends, full, "right"))))
            yield batch.slice(at, stop - at)
            at = stop


def carried(spark: SparkSession, value: object) -> Broadcast:
    """A broadcast of any object of this package; ``unpacked`` gives it back in a task."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def unpacked(parcel: Broadcast) -> object:
    return pickle.loads(parcel.value)


def texts(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def per_batch(
    make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: pa.Schema, rows: int = ROWS
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow``: ``make`` runs once in a task, its result on every piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for piece in pieces(batches, rows):
            yield pa.RecordBatch.from_pydict(work(piece), schema=schema)

    return run


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows with equal keys in one partition, as many partitions as the session shuffles to."""
    return df.repartition(partitions(df.sparkSession), *[F.col(k) for k in keys])
