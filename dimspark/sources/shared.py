"""Tables written to the cluster's shared folder to cut lineage."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"

# Spark's own setting: the files of an execution's shuffles go at its end. Else they stay until the
# driver happens to collect its garbage, and those of all jobs of a build lie on disk together.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_freeing = threading.Lock()
_before: list[str | None] = []  # what the setting was, once for each use that is open


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Executions started inside, also by other threads of the session, leave no shuffle files behind.

    For a DataFrame that is executed once; executed again, Spark makes its shuffles again.
    """
    with _freeing:
        _before.append(_before[0] if _before else spark.conf.get(FREED, None))
        spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        with _freeing:
            before = _before.pop()
            if not _before:
                spark.conf.unset(FREED) if before is None else spark.conf.set(FREED, before)


class Scratch:
    """The tables stored while it is open."""

    def __init__(self) -> None:
        self.paths: list[str] = []

    @contextmanager
    def suspended(self) -> Iterator[None]:
        """Tables stored inside belong to whoever surrounds this scratch, and outlive it."""
        place = _open.index(self)
        _open.remove(self)
        try:
            yield
        finally:
            _open.insert(place, self)

    def remove(self, spark: SparkSession) -> None:
        while self.paths:
            delete(spark, self.paths.pop())


# The innermost is last. The first holds what no other does.
_open: list[Scratch] = [Scratch()]


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or set as checkpoint folder.

    It is always required: a folder of this machine's own would lose data with an
    executor. ``dimspark.session`` has a function that gives local sessions one.
    """
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError(f"set {SETTING} to a folder that every executor can reach")
    return folder.rstrip("/")


def store(df: DataFrame) -> DataFrame:
    """Write ``df`` once and return a scan of the written table.

    The result has no lineage to recompute, exact size statistics for the
    planner and parquet column pruning for each of its readers. The table stays
    until the surrounding ``scratch`` ends, or ``remove_stored`` is called.
    """
    return store_named(df)[0]


def store_named(df: DataFrame) -> tuple[DataFrame, str]:
    """``store``, and the path of the table, for ``remove_named``."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    _open[-1].paths.append(path)
    with freed_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove_named(spark: SparkSession, path: str) -> None:
    """Remove one stored table before its scratch ends; no DataFrame may read it any more."""
    for scratch in _open:
        if path in scratch.paths:
            scratch.paths.remove(path)
    delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def remove_stored(spark: SparkSession) -> None:
    """Remove all tables stored outside a ``scratch``; no DataFrame may read them any more."""
    _open[0].remove(spark)


@contextmanager
def collected() -> Iterator[Scratch]:
    """Tables stored inside are noted, to be removed by the caller when they are no longer read."""
    scratch = Scratch()
    _open.append(scratch)
    try:
        yield scratch
    finally:
        _open.remove(scratch)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Tables stored inside are removed at the end, also after a failure.

    For work that ends with a written result. Threads started inside share it.
    """
    own = None
    try:
        with collected() as own:
            yield own
    finally:
        if own is not None:
            own.remove(spark)
