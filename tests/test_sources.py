"""Scans, shared folder and the database connectors; the latter without a database, on a stand-in session."""

from __future__ import annotations

from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from lineledger.schemas import SOURCE_SCHEMAS
from lineledger.scratch import delete_folder, folder_exists, new_folder, shared_folder, staging
from lineledger.sinks import append_database
from lineledger.sources import (
    catalog_reader,
    conform,
    database_reader,
    date_predicates,
    load_sources,
    read_source,
)
from tests.data import DEPARTMENTS, bag, edge_sources, frame, mart_frame

URL = "jdbc:example://host/db"


def test_conform_orders_casts_and_drops(spark):
    loose = spark.createDataFrame([("x", "7", "Имя", 3)], "extra string, parent_department_id string, "
                                  "department_name string, department_id int")
    fixed = conform(loose, "departments")
    assert fixed.dtypes == [(f.name, f.dataType.simpleString()) for f in SOURCE_SCHEMAS["departments"]]
    assert fixed.collect() == [(3, "Имя", 7)]


def test_sources_are_opened_when_used(spark):
    opened = []

    def reader(spark, table):
        opened.append(table)
        return frame(spark, table, [])

    src = load_sources(spark, reader)
    assert opened == []
    for _ in range(2):
        assert src.departments.count() == 0
    assert opened == ["departments"]


def test_catalog_reader(spark):
    frame(spark, "departments", DEPARTMENTS).createOrReplaceTempView("departments")
    try:
        assert bag(load_sources(spark, catalog_reader()).departments) == bag(edge_sources(spark).departments)
    finally:
        spark.catalog.dropTempView("departments")


def test_date_predicates():
    others = "d < '2025-01-30' OR d >= '2025-02-02' OR d IS NULL"
    assert date_predicates("d", "2025-01-30", "2025-02-02") == [
        "d >= '2025-01-30' AND d < '2025-01-31'",
        "d >= '2025-01-31' AND d < '2025-02-01'",
        "d >= '2025-02-01' AND d < '2025-02-02'",
        others,
    ]
    assert date_predicates("d", "2025-01-30", "2025-02-02", days=2, only_window=True) == [
        "d >= '2025-01-30' AND d < '2025-02-01'",
        "d >= '2025-02-01' AND d < '2025-02-02'",
    ]
    assert date_predicates("d", "2025-01-30", "2025-01-30", only_window=True) == []
    with pytest.raises(ValueError):
        date_predicates("d", "2025-01-30", "2025-01-31", days=0)


def test_date_predicates_cover_every_row_once(spark):
    times = ["2024-01-01 00:00:00", "2025-01-30 00:00:00", "2025-01-31 23:59:59", "2025-02-01 12:00:00",
             "2025-02-02 00:00:00", None]
    rows = spark.createDataFrame([(t,) for t in times], "d string").withColumn("d", F.col("d").cast("timestamp_ntz"))
    predicates = date_predicates("d", "2025-01-30", "2025-02-02")
    hits = sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates), F.lit(0))
    assert {r[0] for r in rows.select(hits).collect()} == {1}


def test_read_source_splits():
    session = MagicMock()
    read_source(session, "employees", url=URL, properties={"user": "u"})
    session.read.jdbc.assert_called_with(URL, "employees", properties={"fetchsize": "10000", "user": "u"})
    read_source(session, "documents", url=URL, predicates=["a", "b"])
    assert session.read.jdbc.call_args.kwargs["predicates"] == ["a", "b"]
    read_source(session, "lines", url=URL, partition_column="document_id", bounds=(1, 900), num_partitions=30)
    split = session.read.jdbc.call_args.kwargs
    keys = ("column", "lowerBound", "upperBound", "numPartitions")
    assert tuple(split[key] for key in keys) == ("document_id", 1, 900, 30)
    for wrong in (
        {"predicates": ["a"], "partition_column": "c", "bounds": (1, 2), "num_partitions": 2},
        {"partition_column": "c"},
        {"bounds": (1, 2)},
        {"num_partitions": 2},
    ):
        with pytest.raises(ValueError):
            read_source(session, "t", url=URL, **wrong)


def test_database_reader_looks_up_the_split():
    session = MagicMock()
    lines = {"partition_column": "document_id", "bounds": (1, 9), "num_partitions": 3}
    reader = database_reader(URL, splits={"documents": {"predicates": ["p"]}, "documents_tabular_part": lines})
    reader(session, "documents")
    assert session.read.jdbc.call_args.kwargs["predicates"] == ["p"]
    reader(session, "employees")
    assert "predicates" not in session.read.jdbc.call_args.kwargs
    for splits in (None, {"documents": {"predicates": ["p"]}}, {"documents_tabular_part": lines, "documents": {}}):
        with pytest.raises(ValueError, match="how to split the read of documents"):
            database_reader(URL, splits=splits)


def stand_in(spark, monkeypatch, counts):
    """A writer that only counts rows, and table counts given in advance."""
    from pyspark.sql.readwriter import DataFrameReader, DataFrameWriter

    calls = {}

    def write(self, url, table, mode=None, properties=None):
        calls.update(url=url, table=table, mode=mode, properties=properties)
        self.format("noop").mode("overwrite").save()

    remaining = iter(counts)
    monkeypatch.setattr(DataFrameWriter, "jdbc", write)
    monkeypatch.setattr(
        DataFrameReader, "jdbc", lambda self, url, table, properties=None: spark.sql(f"SELECT {next(remaining)} AS n")
    )
    return calls


def test_append_database(spark, monkeypatch):
    calls = stand_in(spark, monkeypatch, [10, 12])
    append_database(mart_frame(spark, "2025-01-01", "2025-01-02"), "mart", url=URL, properties={"user": "u"})
    assert calls == {"url": URL, "table": "mart", "mode": "append", "properties": {"batchsize": "10000", "user": "u"}}


def test_append_database_notices_repeated_rows(spark, monkeypatch):
    stand_in(spark, monkeypatch, [10, 13])
    with pytest.raises(RuntimeError, match="grew by 3 rows, 2 were sent"):
        append_database(mart_frame(spark, "2025-01-01", "2025-01-02"), "mart", url=URL)


def test_append_database_of_nothing(spark, monkeypatch):
    stand_in(spark, monkeypatch, [10, 10])
    append_database(mart_frame(spark).where(F.col("number") == "x"), "mart", url=URL)


def test_shared_folder_is_the_sessions(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert shared_folder(spark) == named.rstrip("/")
    assert new_folder(spark, "x") != new_folder(spark, "x")


def session_without_folder(master):
    session = MagicMock()
    session.conf.get.return_value = None
    session.sparkContext.getCheckpointDir.return_value = None
    session.sparkContext.master = master
    return session


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session_without_folder("spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session_without_folder("local-cluster[2,1,1024]"))
    local = session_without_folder("local[4]")
    assert shared_folder(local) == local.sparkContext.setCheckpointDir.call_args.args[0]


def test_staging_reads_back_and_cleans_up(spark):
    rows = frame(spark, "departments", DEPARTMENTS)
    with staging(spark) as stage:
        copy = stage(rows, "departments")
        assert copy.schema == rows.schema
        assert bag(copy) == bag(rows)
        folder = copy.inputFiles()[0].rpartition("/")[0]
        assert folder_exists(spark, folder)
    assert not folder_exists(spark, folder)
    with pytest.raises(ZeroDivisionError), staging(spark) as stage:
        folder = stage(rows, "departments").inputFiles()[0].rpartition("/")[0]
        1 / 0  # noqa: B018
    assert not folder_exists(spark, folder)
    delete_folder(spark, folder)  # already gone
