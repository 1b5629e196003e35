"""Shared working storage: intermediate tables that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: the one the program has set, else ``spark.checkpoint.dir``.

    Only a session that runs on one machine, and names neither, gets a temporary
    folder; on a cluster such a folder would be another one on every machine, so
    there a missing setting is an error.
    """
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="strataload-")
        context.setCheckpointDir(named)
    return named


_SCOPE = "strataload.scratch"
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder, or the scope that is open, that nothing has used before."""
    root = spark.sparkContext.getLocalProperty(_SCOPE) or shared_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scope(spark: SparkSession, name: str = "scope") -> Iterator[None]:
    """Everything settled inside, also by ``side_by_side``, is deleted at the end; frames on it must be used up by then."""
    context = spark.sparkContext
    before = context.getLocalProperty(_SCOPE)
    own = fresh_path(spark, name)
    context.setLocalProperty(_SCOPE, own)
    try:
        yield
    finally:
        context.setLocalProperty(_SCOPE, before)
        remove(spark, own)


def settle(df: DataFrame, name: str = "step") -> DataFrame:
    """Write a frame to shared storage and read it back.

    This cuts the lineage: what follows survives lost executors without
    recomputing the steps before, sees real file sizes when it picks joins, and
    still prunes columns and pushes filters.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    # Hashed keys as text are half as large in zstd as in snappy.
    df.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    _PATHS[stored] = path
    return stored


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Hands Python at most so many rows at a time in what is settled inside, for long texts: a task holds several batches at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Each query run inside deletes its shuffle files as it ends.

    They would stay on the executors' disks until the driver collects its garbage, which over a load of many
    queries may be never. A frame made inside that runs again makes its shuffles again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def discard(*frames: DataFrame) -> None:
    """Delete settled tables that nothing reads any more."""
    for frame in frames:
        if path := _PATHS.pop(frame, None):
            remove(frame.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete files that a finished load no longer needs."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
