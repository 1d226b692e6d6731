"""Shared storage for intermediate tables.

Iterative operators cut their lineage by writing a table to the folder the
cluster names in ``spark.checkpoint.dir`` and reading it back.  A written
table survives the loss of executors, and Spark knows its true size, so the
planner can choose a broadcast join only where the table is really small.
"""

from __future__ import annotations

import functools
import gc
import re
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can read; made up only where driver and executors are one.

    A folder named in ``spark.checkpoint.dir`` is taken at its word: a ``file:`` path there may
    well be a mounted share.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    chosen = spark.sparkContext.getCheckpointDir()
    if chosen:
        return chosen
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="routeloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


#: Paths made since the innermost :func:`releasing` function was entered.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_folder(spark)}/routeloom/{name}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


def releasing(name: str) -> Callable:
    """Store what the decorated function returns, and delete every table stored on the way to it.

    They are deleted if the function fails, too.  Only the result stays in the shared folder.
    """

    def decorate(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(function)
        def run(*args: object, **named: object) -> DataFrame:
            paths: list[str] = []
            token = _made.set(paths)
            try:
                result = function(*args, **named)
                if getattr(result, "stored_at", None) not in paths:
                    result = freeze(result, name)
                paths.remove(result.stored_at)
            finally:
                _made.reset(token)
                spark = SparkSession.getActiveSession()
                for path in paths:
                    remove(spark, path)
            outer = _made.get()
            if outer is not None:
                outer.append(result.stored_at)
            return result

        return run

    return decorate


def freeze(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once and return the written table."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    frozen = df.sparkSession.read.schema(df.schema).parquet(path)
    frozen.stored_at = path
    return frozen


def freeze_counting(df: DataFrame, name: str, where: str | None = None) -> tuple[DataFrame, int]:
    """As :func:`freeze`, also counting the stored rows (that satisfy ``where``)."""
    frozen = freeze(df, name)
    return frozen, (frozen if where is None else frozen.where(where)).count()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder, if it is there."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that :func:`freeze` wrote and nothing reads any more."""
    path = getattr(df, "stored_at", None)
    if path:
        remove(df.sparkSession, path)


def release_shuffles(spark: SparkSession) -> None:
    """Have the files deleted of shuffles that nothing refers to any more.

    Else they stay until the driver happens to collect its garbage, which may be never.
    """
    gc.collect()  # the session's objects are held by those of Python
    spark.sparkContext._jvm.System.gc()
