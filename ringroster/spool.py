"""Intermediate results that must not be recomputed.

A job whose row numbers or extract must stay the same when a task is rerun writes them to
the cluster's shared checkpoint folder and reads them back.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"

_written: ContextVar[list[str] | None] = ContextVar("spooled", default=None)


def checkpoint_folder(spark: SparkSession) -> str:
    """Folder named by `spark.checkpoint.dir`.

    Only a local-mode session without that setting falls back to a temporary folder.
    """
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="ringroster-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def _write(df: DataFrame) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/spool-{uuid.uuid4().hex}"
    df.write.parquet(path)
    within = _written.get()
    if within is not None:
        within.append(path)
    return spark.read.schema(df.schema).parquet(path), path


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder that no plan reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def spooled(df: DataFrame) -> DataFrame:
    """The rows of `df`, written once and read back; later plans start from there.

    The result is lazy, so the files stay for as long as the folder keeps them, or to the end
    of an enclosing `spool_scope`.
    """
    return _write(df)[0]


@contextmanager
def spooling(df: DataFrame) -> Iterator[DataFrame]:
    """As `spooled`, for the length of a block; the files are then deleted."""
    rows, path = _write(df)
    try:
        yield rows
    finally:
        delete(df.sparkSession, path)


@contextmanager
def spool_scope(spark: SparkSession) -> Iterator[None]:
    """A block at whose end everything spooled in it is deleted, so results that rest on it
    must have been written by then."""
    token = _written.set([])
    try:
        yield
    finally:
        for path in _written.get():
            delete(spark, path)
        _written.reset(token)
