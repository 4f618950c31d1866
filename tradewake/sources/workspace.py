"""The shared folder for tables that a job writes for itself.

A frame that is used several times (by an iterative fit, or for both a ranking and the rows it
selects) is written once and read back. Unlike a cached frame it survives the loss of executors,
and unlike a checkpoint it keeps column pruning, filter pushdown and size statistics.

What a job writes lies under one folder. ``job_folder`` opens such a folder for a block of code and
deletes it afterwards; outside a block the tables lie in a folder of the application, which
``release`` deletes once the frames read from it are no longer needed. Files are deleted through the
Hadoop file system of the path, so a shared store works as well as a disk.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_open_folder: ContextVar[str | None] = ContextVar("open_folder", default=None)


@cache
def _own_folder() -> str:
    """For single-machine sessions without the setting, as in tests."""
    return tempfile.mkdtemp(prefix="tradewake-")


def _shared_dir(spark: SparkSession) -> str:
    context = spark.sparkContext
    folder = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that every executor can reach")
    return _own_folder()


def _application_folder(spark: SparkSession) -> str:
    return f"{_shared_dir(spark)}/tradewake/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def job_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for the tables stored inside the block; it is deleted at the end, also after an error.

    Frames read from it must have been used up by then. A block inside another one shares its folder.
    """
    outer = _open_folder.get()
    if outer is not None:
        yield outer
        return
    folder = f"{_application_folder(spark)}/{uuid.uuid4().hex}"
    token = _open_folder.set(folder)
    try:
        yield folder
    finally:
        _open_folder.reset(token)
        _delete(spark, folder)


def release(spark: SparkSession) -> None:
    """Delete everything this application has stored; frames read from it end here."""
    _delete(spark, _application_folder(spark))


def discard(spark: SparkSession, path: str) -> None:
    """Delete one stored table; frames read from it end here."""
    _delete(spark, path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; nothing exists there yet."""
    return f"{_open_folder.get() or _application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and return it as a scan of what was written."""
    path = scratch_path(df.sparkSession, label)
    if partition_by:
        df.hint("rebalance", partition_by).write.partitionBy(partition_by).parquet(path)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
