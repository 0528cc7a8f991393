"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

Stage = Callable[..., DataFrame]
_own: list[tempfile.TemporaryDirectory] = []  # each removes its folder when the process ends


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.

    Where none is set and Spark is one local process, a temporary folder that goes when the process ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    _own.append(tempfile.TemporaryDirectory(prefix="lineledger-", ignore_cleanup_errors=True))
    spark.sparkContext.setCheckpointDir(_own[-1].name)
    return _own[-1].name


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid4().hex}"


def folder_exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Stage]:
    """Gives ``stage(df, name)``, which writes ``df`` and returns it read back; the copies go at the end.

    A staged DataFrame is computed once, survives the loss of executors, and has its true size in the
    statistics, so the planner itself decides whether it can be broadcast. Rows are rebalanced first, so that a
    few rows out of many scan tasks do not become as many files; ``rebalance=False`` saves that shuffle where
    every task has a fair share.
    """
    folder = new_folder(spark, "stage")

    def stage(df: DataFrame, name: str, *, rebalance: bool = True) -> DataFrame:
        path = f"{folder}/{name}"
        (df.hint("rebalance") if rebalance else df).write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield stage
    finally:
        delete_folder(spark, folder)
