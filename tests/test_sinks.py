from __future__ import annotations

import datetime as dt
import importlib
from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lineledger import normalize_mart
from lineledger.schemas import MART_COLUMNS, MART_SCHEMA
from lineledger.scratch import new_folder
from lineledger.sinks import (
    append_mart,
    clear_day,
    compact_day,
    compact_month,
    compact_range,
    ensure_table,
    loaded_days,
    month_of_mart,
    read_mart,
    remove_old_versions,
    replace_day,
    replace_range,
)
from lineledger.sources import extract_name, read_extract, write_extract
from tests.data import bag, mart_frame

MODE = "spark.sql.sources.partitionOverwriteMode"


def days(spark, table):
    return Counter(str(r.date) for r in read_mart(spark, table).select("date").collect())


@pytest.fixture(params=["managed", "with location"])
def mart(request, spark, table):
    ensure_table(spark, table, new_folder(spark, "mart") if request.param == "with location" else None)
    return table


def test_table_layout(spark, mart):
    ensure_table(spark, mart)  # a second time does nothing
    schema = spark.table(mart).schema
    assert schema.fieldNames() == [c for c in MART_COLUMNS if c != "date"] + ["yyyymm", "date"]
    assert {f.name: f.dataType for f in schema if f.name != "yyyymm"} == {f.name: f.dataType for f in MART_SCHEMA}
    assert tuple(read_mart(spark, mart).columns) == MART_COLUMNS


def test_append_twice_doubles(spark, mart):
    for _ in range(2):
        append_mart(mart_frame(spark, "2025-01-01", "2025-01-02"), mart)
    assert days(spark, mart) == Counter({"2025-01-01": 2, "2025-01-02": 2})


def test_replace_day_touches_no_other(spark, mart):
    append_mart(mart_frame(spark, "2025-01-01", "2025-01-02", "2025-01-02"), mart)
    for _ in range(2):
        replace_day(mart_frame(spark, "2025-01-02", price=7.0), mart, "2025-01-02")
    assert days(spark, mart) == Counter({"2025-01-01": 1, "2025-01-02": 1})
    assert read_mart(spark, mart).where("date = '2025-01-02'").first().nomenclature_price_total == 7.0
    assert spark.conf.get(MODE).upper() == "STATIC"


def test_empty_day_ends_empty(spark, mart):
    append_mart(mart_frame(spark, "2025-01-01", "2025-01-02"), mart)
    replace_day(mart_frame(spark), mart, "2025-01-02")
    assert days(spark, mart) == Counter({"2025-01-01": 1})
    assert loaded_days(spark, mart) == [dt.date(2025, 1, 1)]


def test_replace_range_clears_days_without_rows(spark, mart):
    append_mart(mart_frame(spark, "2024-12-31", "2025-01-01", "2025-01-02", "2025-01-03", "2025-01-04"), mart)
    replace_range(mart_frame(spark, "2025-01-02", "2025-01-02"), mart, "2025-01-01", "2025-01-04")
    assert days(spark, mart) == Counter({"2024-12-31": 1, "2025-01-02": 2, "2025-01-04": 1})


def test_rows_outside_the_range_fail_and_change_nothing(spark, mart):
    append_mart(mart_frame(spark, "2025-01-01", "2025-01-05"), mart)
    with pytest.raises(Exception, match="date outside"):
        replace_range(mart_frame(spark, "2025-01-01", "2025-01-05"), mart, "2025-01-01", "2025-01-02")
    assert days(spark, mart) == Counter({"2025-01-01": 1, "2025-01-05": 1})


def test_failure_half_way_keeps_the_day(spark, mart):
    append_mart(mart_frame(spark, "2025-01-01", "2025-01-02"), mart)
    before = bag(read_mart(spark, mart))
    rows = mart_frame(spark, *["2025-01-02"] * 50)
    broken = rows.withColumn(
        "name", F.when(F.col("number") == "n49", F.raise_error(F.lit("broken row"))).otherwise(F.col("name"))
    )
    with pytest.raises(Exception, match="broken row"):
        replace_day(broken, mart, "2025-01-02")
    assert bag(read_mart(spark, mart)) == before
    assert spark.conf.get(MODE).upper() == "STATIC"


def test_overlapping_replacements_keep_all_other_rows(spark, mart, table, monkeypatch):
    """Another replacement, of another day and of another table, runs from begin to end inside the first one's write."""
    from lineledger.sinks import table as sink

    other = f"{table}_other"
    try:
        ensure_table(spark, other)
        for name in (mart, other):
            append_mart(mart_frame(spark, "2025-01-01", "2025-01-02", "2025-01-03"), name)
        inner, plain = [], sink._laid_out

        def interrupted(*rows):
            if not inner:
                inner.append(True)
                replace_day(mart_frame(spark, "2025-01-02", price=2.0), mart, "2025-01-02")
                replace_day(mart_frame(spark, "2025-01-03", price=3.0), other, "2025-01-03")
                compact_day(spark, other, "2025-01-01")
            return plain(*rows)

        monkeypatch.setattr(sink, "_laid_out", interrupted)
        replace_day(mart_frame(spark, "2025-01-01", price=1.0), mart, "2025-01-01")
        prices = lambda name: {str(r.date): r.nomenclature_price_total for r in read_mart(spark, name).collect()}
        kept = mart_frame(spark, "2025-01-01").first().nomenclature_price_total
        assert prices(mart) == {"2025-01-01": 1.0, "2025-01-02": 2.0, "2025-01-03": kept}
        assert prices(other) == {"2025-01-01": kept, "2025-01-02": kept, "2025-01-03": 3.0}
        assert spark.conf.get(MODE).upper() == "STATIC"
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {other}")


STEPS = ["table.note_days", "table.point", "versions._moved", "table.drop_days", "versions.delete_folder"]


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("step", STEPS)
def test_a_load_that_is_cut_off_leaves_all_old_or_all_new_rows(spark, table, monkeypatch, step, after):
    """Every step of a replacement fails, before or after its work; the next run mends it."""
    location = new_folder(spark, "mart")
    ensure_table(spark, table, location)
    append_mart(mart_frame(spark, "2024-12-31", "2025-01-01", "2025-01-02", "2025-01-03"), table)
    old, kept = bag(read_mart(spark, table)), mart_frame(spark, "2024-12-31")
    new = mart_frame(spark, "2025-01-01", "2025-01-03", "2025-01-04", price=9.0)  # a day changes, one goes, one comes
    replaced = bag(kept.unionByName(new))
    module = f"lineledger.sinks.{step.partition('.')[0]}"
    plain = getattr(importlib.import_module(module), step.partition(".")[2])

    def broken(*args):
        if after:
            plain(*args)
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(f"lineledger.sinks.{step}", broken)
        with pytest.raises(OSError, match="lost"):
            replace_range(new, table, "2025-01-01", "2025-01-05")
    assert bag(read_mart(spark, table)) == bag(spark.table(table).select(*MART_COLUMNS)) in (old, replaced)
    append_mart(mart_frame(spark, "2025-01-02", price=5.0), table)  # what is left of a day that was cleared stays out
    replace_range(new, table, "2025-01-01", "2025-01-05")
    assert bag(read_mart(spark, table)) == replaced
    append_mart(mart_frame(spark, "2025-01-02", price=6.0), table)
    replaced += bag(mart_frame(spark, "2025-01-02", price=6.0))
    assert bag(read_mart(spark, table)) == replaced
    spark.sql(f"DROP TABLE {table}")
    ensure_table(spark, table, location)
    assert bag(read_mart(spark, table)) == replaced


def test_readers_see_a_range_change_at_once(spark, mart, monkeypatch):
    """What a reader sees before and after each call that a replacement makes to the catalog."""
    from lineledger.sinks import versions

    append_mart(mart_frame(spark, "2025-01-01", "2025-01-02", "2025-01-03"), mart)
    new, seen = mart_frame(spark, "2025-01-02", "2025-01-04", price=9.0), []
    for name in ("_moved", "drop_days"):
        plain = getattr(versions, name)

        def watched(*args, plain=plain):
            seen.append(bag(read_mart(spark, mart)))
            return plain(*args)

        monkeypatch.setattr(f"lineledger.sinks.{'versions' if name == '_moved' else 'table'}.{name}", watched)
    old = bag(read_mart(spark, mart))
    replace_range(new, mart, "2025-01-01", "2025-01-05")
    assert len(seen) == 5 and all(rows == old for rows in seen[:4]) and seen[4] == bag(new)


def test_old_versions_are_removed_later(spark, mart):
    append_mart(mart_frame(spark, "2025-01-01", "2025-01-02", "2025-01-03"), mart)
    for price in (1.0, 2.0, 3.0):
        replace_range(mart_frame(spark, "2025-01-01", "2025-01-02", price=price), mart, "2025-01-01", "2025-01-03")
    before = bag(read_mart(spark, mart))
    assert remove_old_versions(spark, mart) == 0  # a query may still read them
    assert remove_old_versions(spark, mart, hours=-1) == 2 * 3  # two days: as appended, and the first two versions
    assert bag(read_mart(spark, mart)) == before
    assert remove_old_versions(spark, mart, hours=-1) == 0
    append_mart(mart_frame(spark, "2025-01-01", price=7.0), mart)
    assert bag(read_mart(spark, mart)) == before + bag(mart_frame(spark, "2025-01-01", price=7.0))


def made(spark, table, columns, using="parquet", by="PARTITIONED BY (yyyymm, date)"):
    spark.sql(f"CREATE TABLE {table} ({columns}) USING {using} {by}")


COLUMNS = {c: MART_SCHEMA[c].dataType.simpleString() for c in MART_COLUMNS if c != "date"}
PARTITIONS = ", yyyymm int, date date"


def ddl(columns):
    return ", ".join(f"{name} {kind}" for name, kind in columns.items()) + PARTITIONS


def test_columns_go_by_name(spark, table):
    """A table made elsewhere, with columns in another order, one in other letters, one missing and one more."""
    order = sorted(set(COLUMNS) - {"folder_3"}, reverse=True)
    made(spark, table, ddl({("NAME" if c == "name" else c): COLUMNS[c] for c in order} | {"seen": "timestamp"}))
    rows = mart_frame(spark, "2025-01-01").withColumn("name", F.lit("NAME")).withColumn("number", F.lit("NUMBER"))
    append_mart(rows, table)
    assert bag(read_mart(spark, table)) == bag(rows)
    replace_day(rows.withColumn("date", F.lit(dt.date(2025, 1, 2))), table, "2025-01-02")
    append_mart(rows, table)
    compact_day(spark, table, "2025-01-01")
    found = spark.table(table)
    assert {r.asDict()["folder_3"] for r in found.collect()} == {"f3"} and found.where("seen IS NULL").count() == 3
    assert found.where("name = 'NAME' AND number = 'NUMBER'").count() == 3


def test_missing_columns_are_null_in_old_rows(spark, table):
    made(spark, table, ddl({c: k for c, k in COLUMNS.items() if c != "folder_1"}))
    spark.sql(f"INSERT INTO {table} BY NAME SELECT 'x' AS number, 1D AS nomenclature_price_total, 202501 AS yyyymm, DATE '2025-01-01' AS date")
    ensure_table(spark, table)
    append_mart(mart_frame(spark, "2025-01-01"), table)
    assert {(r.number, r.folder_1) for r in read_mart(spark, table).collect()} == {("x", None), ("n0", "f1")}


def test_compaction_keeps_columns_that_the_mart_lacks(spark, table):
    made(spark, table, ddl(COLUMNS | {"seen": "int"}))
    for n in (1, 2):
        spark.sql(f"INSERT INTO {table} BY NAME SELECT '{n}' AS number, {n} AS seen, 202501 AS yyyymm, DATE '2025-01-01' AS date")
    assert compact_range(spark, table) == [dt.date(2025, 1, 1)]
    assert {(r.number, r.seen) for r in spark.table(table).collect()} == {("1", 1), ("2", 2)}


WRONG = {
    "format orc": dict(columns=ddl(COLUMNS), using="orc"),
    "partitioned by yyyymm": dict(columns=ddl(COLUMNS), by="PARTITIONED BY (yyyymm)"),
    "partitioned by nothing": dict(columns=ddl(COLUMNS), by=""),
    "partitioned by date, yyyymm": dict(columns=ddl(COLUMNS), by="PARTITIONED BY (date, yyyymm)"),
    "nomenclature_price_total is decimal": dict(columns=ddl(COLUMNS | {"nomenclature_price_total": "decimal(10,2)"})),
    "number is varchar": dict(columns=ddl(COLUMNS | {"number": "varchar(5)"})),
    "buckets": dict(columns=ddl(COLUMNS), by="PARTITIONED BY (yyyymm, date) CLUSTERED BY (number) INTO 2 BUCKETS"),
}


@pytest.mark.parametrize("why", WRONG)
def test_tables_that_can_not_hold_the_mart_are_refused(spark, table, why):
    made(spark, table, **WRONG[why])
    rows = mart_frame(spark, "2025-01-01")
    for load in (
        lambda: ensure_table(spark, table),
        lambda: append_mart(rows, table),
        lambda: replace_day(rows, table, "2025-01-01"),
    ):
        with pytest.raises(ValueError, match=why):
            load()
    assert spark.table(table).collect() == []


def test_views_are_refused(spark, table):
    spark.range(1).createOrReplaceTempView(f"{table}_view")
    with pytest.raises(ValueError, match="a view"):
        ensure_table(spark, f"{table}_view")


def test_rows_without_a_date_are_refused(spark, mart):
    append_mart(mart_frame(spark, "2025-01-01"), mart)
    undated = mart_frame(spark, "2025-01-02").withColumn("date", F.lit(None).cast("date"))
    for load in (lambda: append_mart(undated, mart), lambda: replace_day(undated, mart, "2025-01-02")):
        with pytest.raises(Exception, match="no date"):
            load()
    assert loaded_days(spark, mart) == [dt.date(2025, 1, 1)]
    replace_day(mart_frame(spark, "2025-01-01", price=4.0), mart, "2025-01-01")
    assert days(spark, mart) == Counter({"2025-01-01": 1})


def test_location_with_a_quote(spark, table):
    ensure_table(spark, table, new_folder(spark, "it's a mart"))
    replace_day(mart_frame(spark, "2025-01-01"), table, "2025-01-01")
    assert days(spark, table) == Counter({"2025-01-01": 1})


def test_clear_day(spark, mart):
    append_mart(mart_frame(spark, "2025-01-01", "2025-01-02"), mart)
    clear_day(spark, mart, "2025-01-01")
    assert days(spark, mart) == Counter({"2025-01-02": 1})


def test_compact_day(spark, mart):
    for price in (1.0, 2.0, 3.0):
        append_mart(mart_frame(spark, "2025-01-01", "2025-01-02", price=price), mart)
    before = bag(read_mart(spark, mart))

    def files(day):
        return len(spark.table(mart).where(F.col("date") == day).inputFiles())

    assert files("2025-01-01") == 3
    compact_day(spark, mart, "2025-01-01")
    spark.catalog.refreshTable(mart)
    assert (files("2025-01-01"), files("2025-01-02")) == (1, 3)
    assert bag(read_mart(spark, mart)) == before
    compact_day(spark, mart, "2025-06-01")  # nothing there
    assert bag(read_mart(spark, mart)) == before


def day_files(spark, mart):
    spark.catalog.refreshTable(mart)
    files = spark.table(mart).select("date", "_metadata.file_path").distinct().collect()
    return {str(day): {r.file_path for r in files if r.date == day} for day in {r.date for r in files}}


def test_compact_a_month(spark, mart):
    days_of = {"2025-01-01": 3, "2025-01-02": 1, "2025-01-31": 4, "2025-02-01": 3}
    for n in range(4):
        append_mart(mart_frame(spark, *[d for d, files in days_of.items() if n < files], price=float(n)), mart)
    rows, before = bag(read_mart(spark, mart)), day_files(spark, mart)
    assert {d: len(f) for d, f in before.items()} == days_of
    assert compact_month(spark, mart, 202501) == [dt.date(2025, 1, 1), dt.date(2025, 1, 31)]
    after = day_files(spark, mart)
    assert {d: len(f) for d, f in after.items()} == days_of | {"2025-01-01": 1, "2025-01-31": 1}
    assert all(after[d] == before[d] for d in ("2025-01-02", "2025-02-01"))  # the very same files
    assert bag(read_mart(spark, mart)) == rows
    assert compact_month(spark, mart, 202501) == [] == compact_month(spark, mart, 202503)
    assert compact_range(spark, mart) == [dt.date(2025, 2, 1)]
    assert bag(read_mart(spark, mart)) == rows


def test_small_days_share_a_task(spark, mart):
    from lineledger.sinks.table import _bins

    sizes = {dt.date(2025, 1, d): size for d, size in enumerate([70, 10, 30, 20, 90, 60, 10], 1)}
    bins = _bins(sizes, 100)
    assert max(bins.values()) == 2  # 290 in three of 100
    for k in range(3):
        assert sum(sizes[d] for d, at in bins.items() if at == k) <= 100


def hot_day(spark, rows, distinct):
    """A day's rows in no order, a third of them with one number."""
    one = mart_frame(spark, "2025-01-01").drop("number", "name")
    number = F.when(F.col("id") % 3 == 0, "00042").otherwise(F.format_string("%05d", F.xxhash64("id") % distinct))
    return spark.range(rows).crossJoin(one).withColumn("number", number).withColumn("name", F.sha2(F.col("id").cast("string"), 256))


def test_a_number_of_a_hot_day_is_in_one_file(spark, mart):
    append_mart(hot_day(spark, 20_000, 3000).repartition(12).select(*MART_COLUMNS), mart)
    append_mart(mart_frame(spark, "2025-01-02"), mart)
    append_mart(hot_day(spark, 100, 50).select(*MART_COLUMNS), mart)
    rows, kept = bag(read_mart(spark, mart)), day_files(spark, mart)["2025-01-02"]
    size = sum(Path(f.removeprefix("file:")).stat().st_size for f in day_files(spark, mart)["2025-01-01"])
    for _ in range(7):
        append_mart(mart_frame(spark, "2025-01-01"), mart)
    rows += Counter({row: 7 * n for row, n in bag(mart_frame(spark, "2025-01-01")).items()})
    assert compact_range(spark, mart, file_bytes=size // 6) == [dt.date(2025, 1, 1)]
    files = day_files(spark, mart)
    assert files["2025-01-02"] == kept
    assert bag(read_mart(spark, mart)) == rows
    bounds = []
    for file in files["2025-01-01"]:
        group = pq.ParquetFile(file.removeprefix("file:")).metadata
        at = group.schema.names.index("number")
        stats = [group.row_group(k).column(at).statistics for k in range(group.num_row_groups)]
        bounds.append((min(s.min for s in stats), max(s.max for s in stats), group.num_rows))
    bounds.sort()
    assert 4 <= len(bounds) <= 9
    assert all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:]))  # no overlap but at a border
    assert max(n for _, _, n in bounds) < 20_000 / 3  # the hot number is cut, too
    looked_up = spark.table(mart).where("date = DATE '2025-01-01' AND number = '02999'")
    assert sum(low <= "02999" <= high for low, high, _ in bounds) == 1
    assert looked_up.select("_metadata.file_path").distinct().count() <= 1
    assert compact_range(spark, mart, file_bytes=size // 6) == []


def test_rows_that_come_during_a_compaction_are_not_lost(spark, mart, monkeypatch):
    from lineledger.sinks import table as sink

    for _ in range(2):
        append_mart(mart_frame(spark, "2025-01-01"), mart)
    plain, asked = sink._stored, []

    def late(*args):
        asked.append(True)
        if len(asked) == 2:
            append_mart(mart_frame(spark, "2025-01-01", price=8.0), mart)
        return plain(*args)

    monkeypatch.setattr(sink, "_stored", late)
    with pytest.raises(RuntimeError, match="changed while"):
        compact_range(spark, mart)
    assert days(spark, mart) == Counter({"2025-01-01": 3})


def test_table_over_existing_days(spark, table):
    location = new_folder(spark, "mart")
    ensure_table(spark, table, location)
    append_mart(mart_frame(spark, "2025-01-01", "2025-02-02"), table)
    spark.sql(f"DROP TABLE {table}")
    ensure_table(spark, table, location)
    assert days(spark, table) == Counter({"2025-01-01": 1, "2025-02-02": 1})


def test_month_and_day_prune_partitions(spark, mart):
    append_mart(mart_frame(spark, "2025-01-01", "2025-01-31", "2025-02-01"), mart)
    january = month_of_mart(spark, mart, 202501)
    assert Counter(str(r.date) for r in january.collect()) == Counter({"2025-01-01": 1, "2025-01-31": 1})
    assert len(january.inputFiles()) == 2
    one_day = read_mart(spark, mart).where(F.col("date") == dt.date(2025, 1, 31))
    assert len(one_day.inputFiles()) == 1


def test_files_are_sorted_by_number(spark, mart):
    rows = mart_frame(spark, *["2025-01-01"] * 40).repartition(5)
    append_mart(rows, mart)
    numbers = [r.number for r in spark.read.parquet(spark.table(mart).inputFiles()[0]).collect()]
    assert numbers == sorted(numbers)


def test_extract_keeps_text(spark):
    tricky = ["007", "N/A", "NA", "null", "", None, ' " ', 'a"b,c', "две\nстроки", "a\r\nb", " край ", "\\", "#", "'"]
    rows = [
        (dt.date(2025, 1, 1), text, "g", "d", "s", "t", "e", "r", None, "", "f3", text, price, "changed")
        for text in tricky
        for price in (1.25, None, float("nan"), 1e300)
    ]
    mart = spark.createDataFrame(rows, MART_SCHEMA)
    path = write_extract(mart, new_folder(spark, "extract"), dt.datetime(2025, 1, 2, 3, 4, 5))
    assert path.endswith("/sales_mart_20250102_030405.csv")
    back = read_extract(spark, path)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in MART_SCHEMA]
    empty_as_null = mart.select(*[F.when(F.col(c).cast("string") != "", F.col(c)).alias(c) for c in mart.columns])
    assert bag(back) == bag(empty_as_null)
    assert bag(normalize_mart(back)) == bag(normalize_mart(mart))


def test_extract_checks_its_header(spark):
    folder = new_folder(spark, "extract")
    at = dt.datetime(2025, 1, 2)
    mart = mart_frame(spark, "2025-01-01")
    path = write_extract(mart.select(*reversed(mart.columns)), folder, at)
    with pytest.raises(Exception, match="(?i)header"):
        read_extract(spark, path).collect()
    assert extract_name(at, "day").startswith("day_2025")
    assert extract_name(at) == "sales_mart_20250102_000000.csv"
