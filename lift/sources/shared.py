"""Intermediate results in the folder all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
#: A master that runs everything on this machine, in one process.
LOCAL = re.compile(r"local(\[[^\]]*\])?")

_current: ContextVar[str | None] = ContextVar("lift_scratch", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a master that runs all tasks in this process may go without, as in
    tests: there a temporary folder is chosen once for the session.
    """
    folder = spark.conf.get(SETTING, None)
    if folder is None:
        if not LOCAL.fullmatch(spark.sparkContext.master):
            raise ValueError(f"set {SETTING} to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="lift-")
        spark.conf.set(SETTING, folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path, in the scratch folder of the run if one is open."""
    return f"{_current.get() or shared_folder(spark) + '/lift'}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[None]:
    """Whatever is materialised inside goes to a folder that is removed at the end.

    Results that are read later are kept with ``lasting``.
    """
    folder = f"{shared_folder(spark)}/lift/{label}-{uuid.uuid4().hex}"
    token = _current.set(folder)
    try:
        yield
    finally:
        _current.reset(token)
        remove(spark, folder)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage, so a lost executor costs a re-read and not a
    recomputation, and later passes read only the columns they use.
    """
    return _written(df, fresh_path(df.sparkSession, label))


def lasting(df: DataFrame, label: str) -> DataFrame:
    """``materialise``, in a folder that outlives the scratch folder of the run."""
    return _written(df, f"{shared_folder(df.sparkSession)}/lift/{label}-{uuid.uuid4().hex}")


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
