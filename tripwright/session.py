"""What the library needs to know about the session it is handed."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


def use_utc(spark: SparkSession) -> None:
    """Read and show wall-clock timestamps as UTC, on which hours and epoch seconds rest."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder path every executor can reach, for tables written on the way.

    It lies under the shared folder the cluster names in ``spark.checkpoint.dir``, else under
    the session's warehouse, which is shared as well. The file system it lies on deletes it
    when the session's JVM ends.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None) or spark.conf.get(WAREHOUSE_DIR)
    folder = f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{folder}/files"
