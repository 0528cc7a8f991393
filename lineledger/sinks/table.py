"""The mart as a parquet table partitioned by month and day.

Rows that replace others are written to a new version of their days (:mod:`lineledger.sinks.versions`), to which one
catalog call then points the table. The table is read through the catalog, not by its folder.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType

from lineledger.functions import as_day, in_window, month_window, next_day, yyyymm
from lineledger.functions.dates import Day
from lineledger.schemas import MART_COLUMNS, MART_SCHEMA
from lineledger.scratch import delete_folder, folder_exists
from lineledger.sinks.versions import (
    attach,
    day_folder,
    described,
    drop_days,
    folders,
    literal,
    new_version,
    note_days,
    noted_days,
    point,
    quoted,
)

PARTITION_COLUMNS = ("yyyymm", "date")
COMPACTED_BYTES = 512 * 1024**2  # of stored rows that make one compacted file
_LOAD = "lineledger.load."  # and the load's name: a parameter of the days that got rows from it
_DATA_COLUMNS = tuple(c for c in MART_COLUMNS if c != "date")
_TYPES: dict[str, DataType] = {**{f.name: f.dataType for f in MART_SCHEMA}, "yyyymm": IntegerType()}


def _columns(names: Iterable[str]) -> str:
    return ", ".join(f"`{c}` {_TYPES[c].simpleString()}" for c in names)


def ensure_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    """Creates the mart table if there is none; days already at ``location`` become part of it.

    A table that is there is made to fit: columns of the mart that it lacks are added, and are null in its old rows. It
    may have its columns in any order, and more of them, which are null in new rows. A table that is no parquet table
    partitioned by month and day, or has a column of another type, is refused before anything is written.
    """
    if spark.catalog.tableExists(table):
        _reconcile(spark, table)
        return
    placed = "" if location is None else f" LOCATION {literal(location)}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({_columns([*_DATA_COLUMNS, *PARTITION_COLUMNS])}) "
        f"USING parquet PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}){placed}"
    )
    if location is not None and folder_exists(spark, location):
        attach(spark, table)


def _reconcile(spark: SparkSession, table: str) -> None:
    if spark.catalog.getTable(quoted(table)).tableType not in ("MANAGED", "EXTERNAL"):
        raise ValueError(f"{table} can't hold the mart: it is a view")
    about, wrong = described(spark, table), []
    if about.get("provider", "").lower() != "parquet":
        wrong.append(f"it is a table of format {about.get('provider')}")
    by = [c.lower() for c in about.get("partition_columns", [])]
    if by != list(PARTITION_COLUMNS):
        wrong.append(f"it is partitioned by {', '.join(by) or 'nothing'}")
    if about.get("num_buckets"):
        wrong.append("it has buckets")
    kinds = {row["col_name"].lower(): row["data_type"] for row in spark.sql(f"DESCRIBE TABLE {quoted(table)}").collect()}
    for name, kind in _TYPES.items():
        if kinds.get(name, kind.simpleString()) != kind.simpleString():
            wrong.append(f"column {name} is {kinds[name]} instead of {kind.simpleString()}")
    fixed = [c["name"] for c in about["columns"] if not c.get("nullable", True)]
    wrong += [f"column {name} needs a value" for name in fixed if name.lower() not in _TYPES]
    if wrong:
        raise ValueError(f"{table} can't hold the mart: {'; '.join(wrong)}")
    missing = [c for c in _DATA_COLUMNS if c not in kinds]
    if missing:
        spark.sql(f"ALTER TABLE {quoted(table)} ADD COLUMNS ({_columns(missing)})")


def read_mart(spark: SparkSession, table: str) -> DataFrame:
    """The mart's 14 columns in load order."""
    return spark.table(table).select(*MART_COLUMNS)


def month_of_mart(spark: SparkSession, table: str, month: int) -> DataFrame:
    """One month, given as 202501; reads that month's partitions only."""
    return spark.table(table).where(F.col("yyyymm") == month).select(*MART_COLUMNS)


def _failing(message: Column) -> Column:
    return F.raise_error(message).cast("date")


def _laid_out(df: DataFrame, written: Observation | None = None) -> DataFrame:
    """Rows in table order, brought together by day and sorted within each file; a row without a date fails.

    Rebalancing sends a day to one task if it is small, so that it makes few files, and splits a large one
    over several tasks.
    """
    date = F.coalesce("date", _failing(F.lit("a row of the mart has no date")))
    df = df.withColumn("date", date)
    out = df.select(*_DATA_COLUMNS, yyyymm(F.col("date")).alias("yyyymm"), "date")
    out = out.hint("rebalance", *PARTITION_COLUMNS)
    if written is not None:
        # Above the rebalance: below it, an empty result would be planned away together with the metric.
        out = out.observe(written, F.collect_set("date").alias("days"), F.count("*").alias("rows"))
    return out.sortWithinPartitions(*PARTITION_COLUMNS, "number")


def append_mart(df: DataFrame, table: str) -> None:
    """Adds rows without looking at what is there; a second run doubles them.

    Columns go by name to a table that has them in any order; other columns of the table are null in the new rows.
    """
    spark = df.sparkSession
    ensure_table(spark, table)
    here = {c: F.col(c) for c in (*_DATA_COLUMNS, *PARTITION_COLUMNS)}
    own = spark.table(table).schema
    _laid_out(df).select(
        *(here.get(f.name.lower(), F.lit(None).cast(f.dataType)).alias(f.name) for f in own)
    ).write.insertInto(table)


def append_once(df: DataFrame, table: str, load: str) -> bool:
    """Adds the rows of a load unless it has been added before; returns whether it did.

    The ledger of loads is part of the days' entries in the catalog and changes in the one call that makes the new rows
    visible. So a load that is cut off at any point has added all its rows or none, and running it again under the
    same name adds what is missing: all or nothing. Days that had rows before are stored again with the new ones;
    rows that others add to these days meanwhile fail the load and not get lost.
    """
    spark = df.sparkSession
    ensure_table(spark, table)
    if load in committed_loads(spark, table):
        return False
    written, version = Observation(), new_version(spark, table)
    try:
        _laid_out(df, written).write.partitionBy(*PARTITION_COLUMNS).parquet(version)
        days, rows = written.get["days"], written.get["rows"]
        old = F.col("date").isin(days) & F.col("yyyymm").isin(sorted({d.year * 100 + d.month for d in days}))
        before = _stored(spark, table, old) if days else {}
        if before:
            held = spark.table(table).where(old).hint("rebalance", *PARTITION_COLUMNS)
            held = held.sortWithinPartitions(*PARTITION_COLUMNS, "number")
            held.write.mode("append").partitionBy(*PARTITION_COLUMNS).parquet(version)
        if days and _stored(spark, table, old) != before:
            raise RuntimeError(f"rows of the days of load {load} changed while it was stored")
    except Exception:
        delete_folder(spark, version)
        raise
    if days:
        _switch(spark, table, version, days, days, {f"{_LOAD}{load}": f"{rows} rows, {min(days)} to {max(days)}"})
    return True


def committed_loads(spark: SparkSession, table: str) -> dict[str, str]:
    """Names of the loads that :func:`append_once` has added, with the number of their rows and their window.

    A load is known as long as one of its days has a partition.
    """
    return {load: next(iter(days.values())) for load, days in noted_days(spark, table, _LOAD).items()}


def day_digests(rows: DataFrame) -> DataFrame:
    """``(date, rows, digest)`` of mart rows: equal for equal bags of rows of a day, in any order and layout."""
    columns = [F.col(c) for c in MART_COLUMNS]
    sums = [F.sum(F.xxhash64(F.lit(salt), *columns).cast("decimal(38,0)")).cast("string") for salt in (0, 1)]
    return rows.groupBy("date").agg(F.count("*").alias("rows"), F.concat_ws(":", *sums).alias("digest"))


def loaded_days(spark: SparkSession, table: str) -> list[dt.date]:
    """Days that have a partition; a list of names from the catalog, no data is read."""
    return sorted(folders(spark, table))


def _switch(
    spark: SparkSession,
    table: str,
    version: str,
    replaced: Iterable[dt.date],
    with_rows: Iterable[dt.date],
    noted: Mapping[str, str] | None = None,
) -> None:
    """Makes a stored version the rows of the days that it replaces, all at once."""
    replaced, with_rows = set(replaced), set(with_rows)
    note_days(spark, version, replaced, with_rows)
    point(spark, table, {day: day_folder(version, day) for day in replaced}, noted)
    drop_days(spark, table, replaced - with_rows)


def replace_range(df: DataFrame, table: str, start: Day, end: Day) -> None:
    """Replaces the days in ``[start, end)`` by ``df``; days without rows end empty.

    A row outside the range or without a date fails the job instead of replacing a day nobody asked for. The new rows
    are stored beside the old ones, and one catalog call makes them the table's, for the whole range. A load that is
    cut off at any point leaves all old rows or all new ones; running it again gives the table of a load that was
    not. The old rows stay on disk until :func:`~lineledger.sinks.versions.remove_old_versions`.
    """
    start, end = as_day(start), as_day(end)
    window = in_window(F.col("date"), start, end)
    _replace(df, table, window, f"[{start}, {end})", lambda day: start <= day < end)


def replace_days(df: DataFrame, table: str, days: Iterable[dt.date]) -> None:
    """As :func:`replace_range`, for single days."""
    days = sorted(days)
    _replace(df, table, F.col("date").isin(days), "the days to replace", set(days).__contains__)


def _replace(df: DataFrame, table: str, inside: Column, where: str, belongs: Callable[[dt.date], bool]) -> None:
    spark = df.sparkSession
    ensure_table(spark, table)
    outside = F.concat(F.lit(f"date outside {where}: "), F.col("date").cast("string"))
    checked = df.withColumn("date", F.when(F.col("date").isNull() | inside, F.col("date")).otherwise(_failing(outside)))
    written, version = Observation(), new_version(spark, table)
    try:
        _laid_out(checked, written).write.partitionBy(*PARTITION_COLUMNS).parquet(version)
    except Exception:
        delete_folder(spark, version)
        raise
    days = written.get["days"]
    _switch(spark, table, version, {*filter(belongs, loaded_days(spark, table)), *days}, days)


def replace_day(df: DataFrame, table: str, day: Day) -> None:
    replace_range(df, table, day, next_day(day))


def clear_day(spark: SparkSession, table: str, day: Day) -> None:
    """Removes a day's rows and its partition."""
    day = as_day(day)
    if day in loaded_days(spark, table):
        _switch(spark, table, new_version(spark, table), [day], [])


def _stored(spark: SparkSession, table: str, days: Column) -> dict[dt.date, tuple[int, int, int]]:
    """Number of files of each day, their bytes, and a number that changes with their names; a row per day."""
    files = spark.table(table).where(days).select("date", "_metadata.file_path", "_metadata.file_size").distinct()
    per_day = files.groupBy("date").agg(
        F.count("*").alias("files"),
        F.sum("file_size").alias("bytes"),
        F.sum(F.xxhash64("file_path").cast("decimal(38,0)")).cast("string").alias("names"),
    )
    return {row["date"]: (row["files"], row["bytes"], row["names"]) for row in per_day.collect()}


def _bins(sizes: dict[dt.date, int], capacity: int) -> dict[dt.date, int]:
    """A number for each day so that days with the same one have no more than ``capacity`` together; large ones first."""
    bins: list[int] = []
    out = {}
    for day, size in sorted(sizes.items(), key=lambda item: (-item[1], item[0])):
        at = next((k for k, used in enumerate(bins) if used + size <= capacity), len(bins))
        bins[at:] = bins[at:] or [0]
        bins[at] += size
        out[day] = at
    return out


def compact_range(
    spark: SparkSession, table: str, start: Day | None = None, end: Day | None = None, file_bytes: int = COMPACTED_BYTES
) -> list[dt.date]:
    """Rewrites the days in ``[start, end)`` whose small files can become fewer; returns them. The rows stay the same.

    Without bounds it looks at the whole table. Sizes come from the file system. A day that fits into a file becomes
    one, and small days share a task; a larger day is cut by ``number``, so that its files do not overlap and a number
    is found in one of them (two at a border), also if a single number has most rows. All days are rewritten by
    one job and switched to at once; other days keep their files. Rows that are added to one of the days
    meanwhile fail the compaction and not get lost.
    """
    wanted = F.lit(True)
    if start is not None:
        start = as_day(start)
        wanted &= (F.col("yyyymm") >= start.year * 100 + start.month) & (F.col("date") >= F.lit(start))
    if end is not None:
        end = as_day(end)
        wanted &= (F.col("yyyymm") <= end.year * 100 + end.month) & (F.col("date") < F.lit(end))
    before = _stored(spark, table, wanted)
    needed = {day: math.ceil(size / file_bytes) for day, (_, size, _) in before.items()}
    # a large day shares its first and its last range with other days
    days = sorted(day for day, n in needed.items() if before[day][0] > (n if n == 1 else n + 1))
    if not days:
        return []
    small = _bins({day: before[day][1] for day in days if needed[day] == 1}, file_bytes)
    large = [day for day in days if needed[day] > 1]
    rows = spark.table(table)
    columns = [c for c in rows.columns if c.lower() not in PARTITION_COLUMNS] + list(PARTITION_COLUMNS)
    parts = []
    if small:
        task = spark.createDataFrame([(day, at) for day, at in small.items()], "date date, task int")
        of_days = rows.where(wanted & F.col("date").isin(list(small))).select(*columns)
        parts.append(of_days.join(F.broadcast(task), "date").repartitionById(max(small.values()) + 1, F.col("task")))
    if large:
        of_days = rows.where(wanted & F.col("date").isin(large))
        spread = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("spread")
        ranges = sum(needed[day] for day in large)
        parts.append(of_days.select(*columns, spread).repartitionByRange(ranges, "date", "number", "spread"))
    version = new_version(spark, table)
    laid_out = [part.select(*columns).sortWithinPartitions(*PARTITION_COLUMNS, "number") for part in parts]
    laid_out = laid_out[0] if len(laid_out) == 1 else laid_out[0].unionByName(laid_out[1])
    try:
        # where numbers overlap, as with files that were appended since, a filter tells which row groups have one
        blooms = {"parquet.bloom.filter.enabled#number": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
        laid_out.write.options(**blooms).partitionBy(*PARTITION_COLUMNS).parquet(version)
        now = _stored(spark, table, wanted)
        changed = [day for day in days if now.get(day) != before[day]]
        if changed:
            raise RuntimeError(f"rows of {changed[0]} changed while it was compacted")
    except Exception:
        delete_folder(spark, version)
        raise
    _switch(spark, table, version, days, days)
    return days


def compact_day(spark: SparkSession, table: str, day: Day) -> None:
    """Rewrites a day's small files as few large ones; the rows stay the same."""
    compact_range(spark, table, day, next_day(day))


def compact_month(spark: SparkSession, table: str, month: int) -> list[dt.date]:
    """Compacts the days of a month, given as 202501."""
    return compact_range(spark, table, *month_window(month))
