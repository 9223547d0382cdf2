"""Folders for intermediate tables, always on storage every executor can reach."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Folders made so far, by application; ``release`` empties its entry.
_made: dict[str, list[str]] = {}
#: Tables stored inside ``passing_tables``; None outside.
_passing: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("passing", default=None)


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session in local mode may do without the setting: it gets a folder below its
    warehouse, because there all tasks share the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    warehouse = re.sub("^file:(//)?(?=/)", "", spark.conf.get("spark.sql.warehouse.dir"))
    return f"{warehouse.rstrip('/')}/_scratch"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that no other run uses (not created yet)."""
    app = spark.sparkContext.applicationId
    path = f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"
    _made.setdefault(app, []).append(path)
    return path


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df``, computed once and written to a table in the shared folder.

    Later steps neither recompute them nor depend on the executors that did, and the size of
    the table is known when they are planned. ``release`` deletes it.
    """
    path = new_folder(df.sparkSession, purpose)
    if (passing := _passing.get()) is not None:
        passing.append((df.sparkSession, path))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing_tables() -> Iterator[None]:
    """Deletes the tables that ``stored`` makes inside, at the end: nothing may be left that reads them."""
    mark = _passing.set(tables := [])
    try:
        yield
    finally:
        _passing.reset(mark)
        for spark, path in tables:
            delete_folder(spark, path)


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if there is no such folder."""
    if not path_exists(spark, path):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [entry.getPath().getName() for entry in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Put a folder in the place of another, in one step where the file system can rename."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(new, True)
    if not files.rename(old, new):
        raise OSError(f"cannot move {path} to {to}")


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's estimate of the rows' bytes is within its own limit for a broadcast."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= limit


def release(spark: SparkSession) -> int:
    """Delete every folder made for this application so far; how many there were.

    For the end of a job: DataFrames that read one of them can no longer be computed.
    """
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return len(paths)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let the ALS solver cut its lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
