"""Reading a source table over JDBC, in parallel."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from lineledger.functions.dates import Day, as_day
from lineledger.sources.tables import Reader

FETCH_SIZE = "10000"
LARGE_TABLES = ("documents", "documents_tabular_part")  # never read over a single connection


def date_predicates(column: str, start: Day, end: Day, days: int = 1, only_window: bool = False) -> list[str]:
    """Conditions that cut ``[start, end)`` into half-open slices of ``days``, one per read task.

    The last condition takes all other rows, so that the table is read whole: documents of any date can be the
    invoice of a shipment in the window. ``only_window`` leaves it out.
    """
    if days < 1:
        raise ValueError("days must be at least 1")
    day, end = as_day(start), as_day(end)
    slices = []
    while day < end:
        stop = min(day + dt.timedelta(days=days), end)
        slices.append(f"{column} >= '{day}' AND {column} < '{stop}'")
        day = stop
    if not only_window:
        slices.append(f"{column} < '{as_day(start)}' OR {column} >= '{end}' OR {column} IS NULL")
    return slices


def read_source(
    spark: SparkSession,
    table: str,
    *,
    url: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[Any, Any] | None = None,
    num_partitions: int | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """A database table as a DataFrame; filters and column selection go to the database.

    Split the read with ``partition_column``, ``bounds`` and ``num_partitions``, or with ``predicates``, one
    task each. Bounds only place the cuts: rows beyond them are read by the first and the last task. A read
    without a split is a single task and is meant for small tables.
    """
    if predicates is not None and partition_column is not None:
        raise ValueError("give either predicates or partition_column")
    if (partition_column is None) != (bounds is None) or (partition_column is None) != (num_partitions is None):
        raise ValueError("partition_column, bounds and num_partitions go together")
    settings = {"fetchsize": FETCH_SIZE, **(properties or {})}
    if predicates is not None:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=settings)
    if partition_column is not None:
        return spark.read.jdbc(
            url,
            table,
            column=partition_column,
            lowerBound=bounds[0],
            upperBound=bounds[1],
            numPartitions=num_partitions,
            properties=settings,
        )
    return spark.read.jdbc(url, table, properties=settings)


def database_reader(
    url: str,
    properties: Mapping[str, str] | None = None,
    splits: Mapping[str, Mapping[str, Any]] | None = None,
) -> Reader:
    """Reader for ``load_sources``; ``splits`` holds the split arguments of ``read_source`` by table.

    Documents and their lines need a split.
    """
    splits = splits or {}
    if missing := [table for table in LARGE_TABLES if not splits.get(table)]:
        raise ValueError(f"say how to split the read of {', '.join(missing)}")
    return lambda spark, table: read_source(
        spark, table, url=url, properties=properties, **splits.get(table, {})
    )
