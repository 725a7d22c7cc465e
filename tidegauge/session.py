"""Session settings and the folder shared by all executors."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What the jobs expect of a session. Joins carry no broadcast hints: Spark
# broadcasts a side only when its size is below the threshold, decided from
# file statistics at planning time and from shuffle statistics at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot partition from one advisory partition size on, not from four.
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Recording the Python call site of every column takes longer than planning.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}

_own_folders: dict[str, str] = {}
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str = "*", memory: str = "8g", **extra: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tidegauge")
    builder = builder.config("spark.driver.memory", memory)
    partitions = "8" if cores == "*" else cores
    for key, value in {
        **SETTINGS,
        "spark.sql.shuffle.partitions": partitions,
        "spark.ui.showConsoleProgress": "false",
        **extra,
    }.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder every executor reaches, for written tables of this application.

    It lies under `spark.checkpoint.dir`. Only a local session without that
    setting gets a temporary folder of its own.
    """
    app = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if app not in _own_folders:
            _own_folders[app] = tempfile.mkdtemp(prefix="tidegauge-")
        base = _own_folders[app]
    return f"{base.rstrip('/')}/{app}/{name}"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is executed inside are deleted once it ends, for writes that are read back.

    Otherwise they stay until Spark's driver happens to collect what refers to them.
    """
    before = spark.conf.get(_RELEASE, "false")
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(_RELEASE, before)
