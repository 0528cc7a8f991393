"""Versions of a table's days: new rows go to a folder of their own, and one catalog call makes them the table's."""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Iterable, Mapping
from uuid import uuid4

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lineledger.scratch import delete_folder, folder_exists

VERSIONS = "_versions"  # below the table's own folder; readers of folders skip names with this first sign
_DAYS = "_days"  # in a version: which days it replaced, for a table that is made anew over the folder


def quoted(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.replace("`", "").split("."))


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def partition(day: dt.date) -> str:
    return f"PARTITION (yyyymm = {day.year * 100 + day.month}, date = DATE '{day}')"


def day_folder(parent: str, day: dt.date) -> str:
    return f"{parent}/yyyymm={day.year * 100 + day.month}/date={day}"


def described(spark: SparkSession, table: str) -> dict:
    """What the catalog says about a table."""
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)} AS JSON").first()[0])


def location(spark: SparkSession, table: str) -> str:
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").where("col_name = 'Location'").first()
    return found["data_type"].rstrip("/")


def new_version(spark: SparkSession, table: str) -> str:
    """A folder for the rows of one load; folders of later loads have later names."""
    return f"{location(spark, table)}/{VERSIONS}/{time.time_ns():020d}-{uuid4().hex}"


def _path(spark: SparkSession, folder: str):
    return spark._jvm.org.apache.hadoop.fs.Path(folder)


def _partitions(spark: SparkSession, table: str) -> tuple[object, object, dict[dt.date, object]]:
    """The session's catalog, its name of the table, and the catalog's entry of each day; a list of names, no data."""
    state = spark._jsparkSession.sessionState()
    catalog, name = state.catalog(), state.sqlParser().parseTableIdentifier(quoted(table))
    entries = catalog.listPartitions(name, spark._jvm.scala.Option.apply(None)).iterator()
    found = {}
    while entries.hasNext():
        entry = entries.next()
        day = entry.spec().apply("date")
        if day not in ("__HIVE_DEFAULT_PARTITION__", "null"):
            found[dt.date.fromisoformat(day)] = entry
    return catalog, name, found


def folders(spark: SparkSession, table: str) -> dict[dt.date, str]:
    """Where the rows of each day are that has a partition."""
    return {day: entry.location().toString() for day, entry in _partitions(spark, table)[2].items()}


def _moved(spark: SparkSession, entry, folder: str, noted: Mapping[str, str]):
    """The catalog's entry of a day with another folder and more parameters; all else stays."""

    def rest(case, first: int) -> list:
        return [getattr(case, f"copy$default${k}")() for k in range(first, case.productArity() + 1)]

    storage, parameters = entry.storage(), entry.parameters()
    storage = storage.copy(spark._jvm.scala.Option.apply(_path(spark, folder).toUri()), *rest(storage, 2))
    for name, value in noted.items():
        parameters = parameters.updated(name, value)
    return entry.copy(entry.spec(), storage, parameters, *rest(entry, 4))


def point(spark: SparkSession, table: str, to: Mapping[dt.date, str], noted: Mapping[str, str] | None = None) -> None:
    """Makes each day's rows those in its folder: all days in one catalog call, so that readers see all or none.

    Days that have no partition yet get one first, with a folder where nothing is. ``noted`` becomes part of each
    day's parameters in the same call.
    """
    known = _partitions(spark, table)[2]
    new = sorted(set(to) - set(known))
    if new:
        nowhere = f"{location(spark, table)}/{VERSIONS}/none"
        added = " ".join(f"{partition(day)} LOCATION {literal(day_folder(nowhere, day))}" for day in new)
        spark.sql(f"ALTER TABLE {quoted(table)} ADD IF NOT EXISTS {added}")
    catalog, name, known = _partitions(spark, table)
    moved = spark._jvm.java.util.ArrayList()
    for day in sorted(to):
        moved.add(_moved(spark, known[day], to[day], noted or {}))
    if to:
        catalog.alterPartitions(name, spark._jvm.scala.jdk.javaapi.CollectionConverters.asScala(moved).toSeq())
    spark.catalog.refreshTable(quoted(table))


def noted_days(spark: SparkSession, table: str, prefix: str) -> dict[str, dict[dt.date, str]]:
    """Parameters of days whose names begin with ``prefix``: the rest of the name, and the value by day."""
    found: dict[str, dict[dt.date, str]] = {}
    for day, entry in _partitions(spark, table)[2].items():
        names = entry.parameters().keysIterator()
        while names.hasNext():
            name = names.next()
            if name.startswith(prefix):
                found.setdefault(name.removeprefix(prefix), {})[day] = entry.parameters().apply(name)
    return found


def note_days(spark: SparkSession, version: str, replaced: Iterable[dt.date], with_rows: Iterable[dt.date]) -> None:
    """Writes down which days a version replaces, before it does."""
    held = set(with_rows)
    rows = [(str(day), day in held) for day in sorted(replaced)]
    spark.createDataFrame(rows, "day string, rows boolean").coalesce(1).write.json(f"{version}/{_DAYS}")


def _below(spark: SparkSession, folder: str, start: str = "") -> list[tuple[str, int]]:
    """Folders directly below one, with their time of change in milliseconds; names only, no data."""
    if not folder_exists(spark, folder):
        return []
    path = _path(spark, folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(
        (f"{folder}/{status.getPath().getName()}", status.getModificationTime())
        for status in found
        if status.isDirectory() and status.getPath().getName().startswith(start)
    )


def _day_folders(spark: SparkSession, parent: str) -> list[tuple[str, int]]:
    return [day for month, _ in _below(spark, parent, "yyyymm=") for day in _below(spark, month, "date=")]


def attach(spark: SparkSession, table: str) -> None:
    """Gives a table that is made over an existing folder the days that a former table had there.

    Versions count in the order of their loads. One whose load was cut off after its rows were stored counts, too.
    """
    spark.sql(f"MSCK REPAIR TABLE {quoted(table)}")
    current: dict[dt.date, str] = {}
    for version, _ in _below(spark, f"{location(spark, table)}/{VERSIONS}"):
        if folder_exists(spark, f"{version}/{_DAYS}"):
            for row in spark.read.schema("day string, rows boolean").json(f"{version}/{_DAYS}").collect():
                day = dt.date.fromisoformat(row["day"])
                current.pop(day, None)
                if row["rows"]:
                    current[day] = day_folder(version, day)
    point(spark, table, current)


def drop_days(spark: SparkSession, table: str, days: Iterable[dt.date]) -> None:
    """Removes the partitions of days without rows, and what former versions left where appended rows would go."""
    own = location(spark, table)
    for day in sorted(days):
        delete_folder(spark, day_folder(own, day))
        spark.sql(f"ALTER TABLE {quoted(table)} DROP IF EXISTS {partition(day)}")


def remove_old_versions(spark: SparkSession, table: str, hours: float = 24.0) -> int:
    """Deletes folders of days that the table does not point to any more; returns how many.

    Younger ones stay: queries that began before a replacement may still read them, and a load may be writing them.
    """
    own = location(spark, table)
    last = (time.time() - 3600 * hours) * 1000
    used = {_path(spark, folder).toUri().getPath() for folder in folders(spark, table).values()}
    removed = 0
    versions = [version for version, _ in _below(spark, f"{own}/{VERSIONS}")]
    places = [place for parent in (own, *versions) for place in _day_folders(spark, parent)]
    for folder, changed in places:
        if changed <= last and _path(spark, folder).toUri().getPath() not in used:
            delete_folder(spark, folder)
            removed += 1
    return removed
