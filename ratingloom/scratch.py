"""Tables written once in the cluster's shared folder and read back.

Writing cuts lineage in a way that survives lost executors, and gives Catalyst
the real size of an intermediate result, so that its broadcast choice rests on
measured bytes.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_Result = TypeVar("_Result")

# While this holds, the shuffle files of a query go when it ends, not when the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# The paths written inside the innermost ``scratch_tables`` block around the
# caller; threads started by ``side_by_side`` share their starter's.
_owned: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Without that setting a checkpoint folder already given to the context is
    used, and a local-mode session gets a temporary one.  A cluster without a
    shared folder is an error: executors cannot read each other's disks.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ratingloom-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    run = spark.sparkContext.applicationId
    path = f"{shared_folder(spark).rstrip('/')}/ratingloom/{run}/{label}-{uuid.uuid4().hex}"
    owned = _owned.get()
    if owned is not None:
        owned.append(path)
    return path


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries written inside the block leave no shuffle files: the next step has their disk."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        # Of two threads the first to end may take this from the other's next query, which then leaves its files.
        spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a scratch table and return the table; its shuffle files go at once."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, *steps: Callable[[], _Result]) -> list[_Result]:
    """Run independent steps, each with jobs of its own, at the same time."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(steps)) as pool:
        jobs = [pool.submit(copy_context().run, inherit(step)) for step in steps]
        return [job.result() for job in jobs]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Drop the scratch tables written inside the block when it ends.

    Only the block's own tables go; other threads' and outer blocks' stay.
    """
    owned: list[str] = []
    token = _owned.set(owned)
    try:
        yield
    finally:
        _owned.reset(token)
        for name in owned:
            discard(spark, name)
