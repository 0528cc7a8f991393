"""One query per stage of the mart, over the test data."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineledger import normalize_mart, run_backfill, run_corrections, run_daily, sales_mart
from lineledger.config import UNKNOWN, UNKNOWN_SECTION
from lineledger.functions import department_group, label_or, month_window, next_day, short_name, yyyymm
from lineledger.operators import (
    child_folders,
    department_hierarchy,
    department_subtree,
    folder_listing,
    folder_tree,
    outgoing_invoices,
    partner_shipments,
    root_folders,
    sales,
    sales_changed,
    sales_not_changed,
    shipped_documents,
)
from lineledger.plans import credited_sales, mart_rows, products
from lineledger.schemas import MART_COLUMNS, MART_SCHEMA
from lineledger.scratch import delete_folder, shared_folder
from lineledger.sinks import compact_day, compact_month, compact_range, month_of_mart, read_mart
from lineledger.sources import read_extract, write_extract
from registry.fixtures import CONFIG, DAY, END, MONTH, START, test_sources

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _path_as_text(tree: DataFrame) -> DataFrame:
    return tree.withColumn("full_path", F.array_join("full_path", " / "))


@query
def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = test_sources(spark, sf_dir)
    sold = sales_not_changed(src.documents, START, END)
    return sold.join(src.document_lines, "document_id").select(
        F.col("sbis_shipment_date").alias("date"), "number", "nomenclature_price_total", "realization"
    )


@query
def root_folders_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _path_as_text(root_folders(test_sources(spark, sf_dir).nomenclatures))


@query
def child_folders_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second level: one step down from the roots."""
    nomenclatures = test_sources(spark, sf_dir).nomenclatures
    return _path_as_text(child_folders(nomenclatures, root_folders(nomenclatures)))


@query
def folder_tree_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _path_as_text(folder_tree(test_sources(spark, sf_dir).nomenclatures, CONFIG.folder_depth))


@query
def folder_listing_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _path_as_text(folder_listing(test_sources(spark, sf_dir).nomenclatures, CONFIG.folder_depth))


@query
def product_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products(test_sources(spark, sf_dir), CONFIG)


@query
def department_subtree_by_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return department_subtree(test_sources(spark, sf_dir).departments, parent_ids=CONFIG.section_parent_ids)


@query
def department_subtree_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return department_subtree(test_sources(spark, sf_dir).departments, ids=CONFIG.section_ids)


@query
def department_hierarchy_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return department_hierarchy(test_sources(spark, sf_dir).departments, CONFIG)


@query
def shipped_documents_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shipped_documents(test_sources(spark, sf_dir).documents, START, END).select(
        "document_id", "number", "sbis_shipment_date", "department_id", "employee_id"
    )


@query
def outgoing_invoices_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outgoing_invoices(test_sources(spark, sf_dir).documents, CONFIG.invoice_type).select(
        "document_id", "number", "department_id", "employee_id"
    )


@query
def partner_shipments_(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = test_sources(spark, sf_dir)
    shipped = shipped_documents(src.documents, START, END)
    return partner_shipments(shipped, src.department_roots, CONFIG.partner_root).select(
        "document_id", "number", "department_id", "employee_id"
    )


@query
def sales_changed_(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = test_sources(spark, sf_dir)
    return sales_changed(src.documents, src.department_roots, START, END, CONFIG)


@query
def sales_not_changed_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_not_changed(test_sources(spark, sf_dir).documents, START, END)


@query
def sales_(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = test_sources(spark, sf_dir)
    return sales(src.documents, src.department_roots, START, END, CONFIG)


@query
def employee_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    employees = test_sources(spark, sf_dir).employees
    return employees.select("employee_id", short_name(F.col("first_name"), F.col("last_name")).alias("employe_name"))


@query
def department_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    departments = test_sources(spark, sf_dir).departments
    units = department_hierarchy(departments, CONFIG)
    department = F.col("department")
    return (
        departments.select("department_id")
        .join(units, "department_id", "left")
        .select(
            "department_id",
            department_group(department, CONFIG.representatives).alias("root_department"),
            label_or(department, UNKNOWN).alias("department"),
            label_or(F.col("section"), UNKNOWN_SECTION).alias("section"),
            label_or(F.col("sector"), UNKNOWN).alias("sector"),
        )
    )


@query
def credited_sales_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credited_sales(test_sources(spark, sf_dir), START, END, CONFIG)


@query
def sales_mart_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_mart(test_sources(spark, sf_dir), START, END, CONFIG)


@query
def sales_mart_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_mart(test_sources(spark, sf_dir), DAY, next_day(DAY), CONFIG)


@query
def sales_mart_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_mart(mart_rows(test_sources(spark, sf_dir), START, END, CONFIG))


@query
def sales_mart_normalized_null_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_mart(mart_rows(test_sources(spark, sf_dir), START, END, CONFIG), nan_price=False)


@query
def sales_mart_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a month of the window; the month is a window of its own, so only its documents are read."""
    mart = normalize_mart(mart_rows(test_sources(spark, sf_dir), *month_window(MONTH), CONFIG))
    return mart.select(yyyymm(F.col("date")).alias("yyyymm"), *MART_COLUMNS)


@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = sales_mart(test_sources(spark, sf_dir), START, END, CONFIG)
    path = write_extract(mart, _folder(spark, "extract", sf_dir), dt.datetime.combine(END, dt.time()))
    return normalize_mart(read_extract(spark, path))


def _folder(spark: SparkSession, purpose: str, sf_dir: str) -> str:
    """A folder that the last run of the same query in this session had, emptied.

    The result is read from it after the query has returned, so it cannot go at once; a session leaves no more than
    one behind per query and input.
    """
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}-{purpose}-{crc32(sf_dir.encode()):08x}"
    delete_folder(spark, folder)
    return folder


def _table(spark: SparkSession, query: str, sf_dir: str) -> dict[str, str]:
    """An empty table for one run, in place of the last run's."""
    table = f"registry_{query}_{crc32(sf_dir.encode()):08x}"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    return {"table": table, "location": _folder(spark, query, sf_dir)}


@query
def backfill_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two backfills of the same range; the second replaces the first."""
    src, mart = test_sources(spark, sf_dir), _table(spark, "backfill_roundtrip", sf_dir)
    for _ in range(2):
        run_backfill(spark, src, start=START, end=END, config=CONFIG, **mart)
    return read_mart(spark, mart["table"])


@query
def append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appending backfills; every row is there twice."""
    src, mart = test_sources(spark, sf_dir), _table(spark, "append_roundtrip", sf_dir)
    for _ in range(2):
        run_backfill(spark, src, start=START, end=END, config=CONFIG, mode="append", **mart)
    return read_mart(spark, mart["table"])


@query
def daily_replace_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill, then the daily load of a day inside it, twice."""
    src, mart = test_sources(spark, sf_dir), _table(spark, "daily_replace_roundtrip", sf_dir)
    run_backfill(spark, src, start=START, end=END, config=CONFIG, **mart)
    for _ in range(2):
        run_daily(spark, src, day=DAY, config=CONFIG, **mart)
    return read_mart(spark, mart["table"])


@query
def daily_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily load of a table that does not exist yet."""
    src, mart = test_sources(spark, sf_dir), _table(spark, "daily_roundtrip", sf_dir)
    run_daily(spark, src, day=DAY, config=CONFIG, **mart)
    return read_mart(spark, mart["table"])


@query
def month_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month of a loaded table, read from that month's partitions."""
    src, mart = test_sources(spark, sf_dir), _table(spark, "month_partition_roundtrip", sf_dir)
    run_backfill(spark, src, start=START, end=END, config=CONFIG, **mart)
    return month_of_mart(spark, mart["table"], MONTH)


@query
def compact_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day loaded and compacted inside a backfilled table."""
    src, mart = test_sources(spark, sf_dir), _table(spark, "compact_roundtrip", sf_dir)
    run_backfill(spark, src, start=START, end=END, config=CONFIG, **mart)
    compact_day(spark, mart["table"], DAY)
    return read_mart(spark, mart["table"])


@query
def reconcile_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made elsewhere, with its columns in another order, one missing and one more, filled by name.

    The window is appended, its middle month replaced by itself, and the whole compacted.
    """
    src, mart = test_sources(spark, sf_dir), _table(spark, "reconcile_roundtrip", sf_dir)
    kinds = {f.name: f.dataType.simpleString() for f in MART_SCHEMA if f.name not in ("date", "folder_3")}
    columns = ", ".join(f"{name} {kinds[name]}" for name in sorted(kinds, reverse=True))
    spark.sql(
        f"CREATE TABLE {mart['table']} (seen timestamp, {columns}, yyyymm int, date date) USING parquet "
        f"PARTITIONED BY (yyyymm, date) LOCATION '{mart['location']}'"
    )
    run_backfill(spark, src, start=START, end=END, config=CONFIG, mode="append", **mart)
    first, after = month_window(MONTH)
    run_backfill(spark, src, start=first, end=after, config=CONFIG, **mart)
    compact_range(spark, mart["table"])
    return read_mart(spark, mart["table"])


@query
def compact_month_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window appended twice, so that its days have several files; one month is compacted."""
    src, mart = test_sources(spark, sf_dir), _table(spark, "compact_month_roundtrip", sf_dir)
    for _ in range(2):
        run_backfill(spark, src, start=START, end=END, config=CONFIG, mode="append", **mart)
    compact_month(spark, mart["table"], MONTH)
    return read_mart(spark, mart["table"])


@query
def number_lookup_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of each day's last number, found in a compacted table that is cut into files by number."""
    src, mart = test_sources(spark, sf_dir), _table(spark, "number_lookup_roundtrip", sf_dir)
    run_backfill(spark, src, start=START, end=END, config=CONFIG, mode="append", **mart)
    run_backfill(spark, src, start=START, end=END, config=CONFIG, mode="append", **mart)
    compact_range(spark, mart["table"], file_bytes=16 * 1024)
    rows = read_mart(spark, mart["table"])
    last = rows.groupBy("date").agg(F.max("number").alias("number"))
    return rows.join(last, ["date", "number"], "left_semi").select(*MART_COLUMNS)


@query
def append_once_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window appended under a name three times, beside a day that was there before; every row is there once more."""
    src, mart = test_sources(spark, sf_dir), _table(spark, "append_once_roundtrip", sf_dir)
    run_backfill(spark, src, start=DAY, end=next_day(DAY), config=CONFIG, mode="append", **mart)
    for _ in range(3):
        run_backfill(spark, src, start=START, end=END, config=CONFIG, mode="append", load="first", **mart)
    return read_mart(spark, mart["table"])


@query
def corrections_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window loaded while a day's documents were not there yet, and corrected when they are."""
    src, mart = test_sources(spark, sf_dir), _table(spark, "corrections_roundtrip", sf_dir)
    early = test_sources(spark, sf_dir)
    early.documents = src.documents.where(F.col("sbis_shipment_date") != F.lit(DAY))
    run_backfill(spark, early, start=START, end=END, config=CONFIG, **mart)
    run_corrections(spark, src, mart["table"], START, END, config=CONFIG)
    return read_mart(spark, mart["table"])


# A trailing underscore only keeps a query apart from the operator it calls.
QUERIES = {name.rstrip("_"): function for name, function in QUERIES.items()}
