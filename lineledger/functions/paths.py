"""Folder paths: arrays of names from the root folder down."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_start(name: Column) -> Column:
    return F.array(name)


def path_append(path: Column, name: Column) -> Column:
    return F.array_append(path, name)


def path_entry(path: Column, index: int, length: int) -> Column:
    """Entry ``index`` (from 0) cut to ``length`` characters; NULL past the end of the path."""
    # A cast to varchar(n) does not cut in Spark, and path[index] raises under ANSI mode.
    return F.left(F.get(path, F.lit(index)), F.lit(length))
