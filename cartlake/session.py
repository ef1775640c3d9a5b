"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# ANSI casts make bad numbers fail the job, UTC makes text timestamps portable,
# AQE coalesces small partitions and splits skewed join partitions. A task meets a
# handful of event types, so it keeps one file open for each and skips the sort of
# wide rows that a partitioned write would need.
REQUIRED_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def build_session(app_name: str = "cartlake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the required settings; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for as long as the block runs. Of blocks side by side only those that change it restore it."""
    before = spark.conf.get(name, None)
    if before == value:
        yield
        return
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def no_shuffle_left(spark: SparkSession):
    """Queries begun in the block delete their shuffle files when they end.

    Else these stay on disk until the driver happens to collect its garbage, beside all that is written meanwhile.
    """
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for tables that cut lineage.

    The cluster names it in `spark.checkpoint.dir`. Only a local session may go
    without; it gets one temporary folder for the life of the process.
    """
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="cartlake-")
    return _local_folder
