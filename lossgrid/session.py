"""Session settings the jobs are designed for, and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings above; cluster sizing stays with the cluster."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per Spark application.

    The zip is made beside the driver and handed over by Spark's own file service, so no shared folder is needed.
    """
    context = spark.sparkContext
    if getattr(context, "_lossgrid_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="lossgrid-"), "lossgrid.zip")
    with zipfile.ZipFile(target, "w") as packed:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                packed.write(full, os.path.join("lossgrid", os.path.relpath(full, root)))
    context.addPyFile(target)
    context._lossgrid_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read: ``spark.checkpoint.dir``, or a folder of the configured warehouse."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_lossgrid"


def run_dir(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables."""
    return f"{shared_dir(spark)}/lossgrid/{spark.sparkContext.applicationId}"


def clear_run(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; frames that read them cannot be used any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Whether Spark deletes the shuffle files of a job when the job ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_writing: dict[SparkSession, tuple[int, str]] = {}
_lock = threading.Lock()


@contextmanager
def _cleaning(spark: SparkSession) -> Iterator[None]:
    """``CLEANUP`` is on while a thread writes; the last one to end puts back what it was."""
    with _lock:
        running, before = _writing.get(spark) or (0, spark.conf.get(CLEANUP, "false"))
        _writing[spark] = running + 1, before
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            running, before = _writing.pop(spark)
            if running > 1:
                _writing[spark] = running - 1, before
            else:
                spark.conf.set(CLEANUP, before)


def materialise(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder once and read it back.

    Used where a result feeds several branches or rounds: the work before it runs once, a lost executor does
    not replay it, and the columnar copy keeps column pruning and real sizes for the joins after it. The shuffle
    files of the write are not needed any more and go with it.
    """
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{uuid.uuid4().hex}"
    with _cleaning(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
