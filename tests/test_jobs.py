from __future__ import annotations

import datetime as dt
import importlib
import json
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from lineledger import normalize_mart, run_backfill, run_corrections, run_daily, sales_mart
from lineledger.plans import stage_trees
from lineledger.scratch import staging
from lineledger.sinks import append_mart, append_once, committed_loads, compact_range, day_digests, ensure_table, read_mart
from tests.data import END, LINES, START, bag, edge_sources, mart_frame


@pytest.fixture(scope="module")
def src(spark):
    return edge_sources(spark)


@pytest.fixture(scope="module")
def expected(src):
    return bag(normalize_mart(sales_mart(src, START, END)))


def test_backfill_twice(spark, src, expected, table):
    for _ in range(2):
        run_backfill(spark, src, table, START, END, source_bytes=10**6)
        assert bag(read_mart(spark, table)) == expected


def test_appending_backfill_twice(spark, src, expected, table):
    for times in (1, 2):
        run_backfill(spark, src, table, START, END, mode="append", source_bytes=10**6)
        assert bag(read_mart(spark, table)) == Counter({row: n * times for row, n in expected.items()})


def test_size_of_an_unknown_source_has_to_be_given(spark, src, table):
    with pytest.raises(ValueError, match="size in bytes"):
        run_daily(spark, src, table, "2025-03-15")
    assert not spark.catalog.tableExists(table)


def test_trees_can_be_shared_and_rows_sent_on(spark, src, expected, table):
    sent = []
    with staging(spark) as stage:
        trees = stage_trees(spark, stage, src)
        for day in ("2025-03-15", "2025-03-19"):
            run_daily(spark, src, table, day, source_bytes=10**6, trees=trees, sink=lambda rows: sent.append(bag(rows)))
    assert sent[0] + sent[1] == bag(read_mart(spark, table)) != Counter()
    sent.clear()
    for mode in ("replace", "append"):
        run_backfill(
            spark, src, table, START, END, source_bytes=10**6, mode=mode, sink=lambda rows: sent.append(bag(rows))
        )
    assert sent == [expected, expected]


def test_overlapping_loads_leave_the_session_as_it_was(spark, src, expected, table):
    other, before = f"{table}_other", dict(spark.sparkContext.getConf().getAll())
    keys = [k for k in spark.conf.getAll if k.startswith("spark.sql")]
    values = {k: spark.conf.get(k) for k in keys}
    try:
        with ThreadPoolExecutor(2) as threads:
            loads = [threads.submit(run_backfill, spark, src, t, START, END, source_bytes=10**6) for t in (table, other)]
            [load.result() for load in loads]
        assert bag(read_mart(spark, table)) == bag(read_mart(spark, other)) == expected
        assert {k: spark.conf.get(k) for k in keys} == values
        assert {k for k in spark.conf.getAll if k.startswith("spark.sql")} == set(keys)
        assert dict(spark.sparkContext.getConf().getAll()) == before
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {other}")


def test_unknown_mode(spark, src, table):
    with pytest.raises(ValueError):
        run_backfill(spark, src, table, START, END, mode="merge", source_bytes=10**6)
    assert not spark.catalog.tableExists(table)


def test_every_day_makes_the_window(spark, src, expected, table):
    day, end = dt.date(2025, 3, 15), dt.date(2025, 3, 21)
    while day < end:
        run_daily(spark, src, table, day, source_bytes=10**6)  # the first run creates the table
        day += dt.timedelta(days=1)
    in_window = Counter({row: n for row, n in expected.items() if dt.date(2025, 3, 15) <= row[0] < end})
    assert bag(read_mart(spark, table)) == in_window


def test_daily_replaces_its_day_only(spark, src, expected, table):
    run_backfill(spark, src, table, START, END, source_bytes=10**6)
    append_mart(mart_frame(spark, "2025-03-15", "2025-03-18"), table)  # rows that a rerun has to remove
    run_daily(spark, src, table, "2025-03-15", compact=True, source_bytes=10**6)
    left_over = bag(mart_frame(spark, "2025-03-15", "2025-03-18").where("date = '2025-03-18'"))
    assert bag(read_mart(spark, table)) == expected + left_over
    run_daily(spark, src, table, "2025-03-18", source_bytes=10**6)
    run_daily(spark, src, table, "2025-03-18", source_bytes=10**6)
    assert bag(read_mart(spark, table)) == expected


def files_by_day(spark, table):
    rows = spark.table(table).select("date", "_metadata.file_path").distinct().collect()
    return {day: {r.file_path for r in rows if r.date == day} for day in {r.date for r in rows}}


def test_late_corrections_change_their_days_only(spark, src, expected, table):
    """A price changes, a shipment is deleted and put back, a day is lost and another one too much."""
    run_backfill(spark, src, table, START, END, source_bytes=10**6)
    assert run_corrections(spark, src, table, START, END, source_bytes=10**6) == []
    before = files_by_day(spark, table)
    changed = edge_sources(spark, documents_tabular_part=[(*line[:2], 77.0) if line == (11, 700, 7.0) else line for line in LINES])
    deleted = edge_sources(spark)
    deleted.documents = deleted.documents.withColumn("deleted", F.when(F.col("document_id") == 11, 1).otherwise(F.col("deleted")))
    day = dt.date(2025, 3, 19)
    for late in (changed, deleted):
        assert run_corrections(spark, late, table, START, END, source_bytes=10**6) == [day]
        assert bag(read_mart(spark, table)) == bag(normalize_mart(sales_mart(late, START, END)))
        after = files_by_day(spark, table)
        assert {d: f for d, f in after.items() if d != day} == {d: f for d, f in before.items() if d != day}
    spark.sql(f"ALTER TABLE {table} DROP PARTITION (yyyymm = 202503, date = DATE '2025-03-15')")
    append_mart(mart_frame(spark, "2025-04-01"), table)  # a day that the sources do not have
    assert run_corrections(spark, src, table, START, END, source_bytes=10**6) == [dt.date(2025, 3, 15), day, dt.date(2025, 4, 1)]
    assert bag(read_mart(spark, table)) == expected


def test_digests_do_not_depend_on_the_layout(spark):
    rows = mart_frame(spark, "2025-01-01", "2025-01-01", "2025-01-02", price=float("nan"))
    other = rows.repartition(3).orderBy(F.desc("number"))
    assert bag(day_digests(rows)) == bag(day_digests(other))
    assert bag(day_digests(rows)) != bag(day_digests(rows.withColumn("number", F.lit("x"))))
    twice = {r.date: r for r in day_digests(rows.unionByName(rows)).collect()}
    assert twice[dt.date(2025, 1, 1)].rows == 4


@pytest.mark.parametrize(
    "step, after", [("table._stored", False), ("table.note_days", True), ("versions._moved", False), ("table.point", True)]
)
def test_a_named_load_adds_its_rows_once(spark, src, expected, table, monkeypatch, step, after):
    """Cut off at any step and run again, beside rows that were there before."""
    there = mart_frame(spark, "2025-03-15", "2025-12-31")
    ensure_table(spark, table)
    append_mart(there, table)
    module = importlib.import_module(f"lineledger.sinks.{step.partition('.')[0]}")
    plain = getattr(module, step.partition(".")[2])

    def broken(*args):
        if after:
            plain(*args)
        raise OSError("lost")

    rows = normalize_mart(sales_mart(src, START, END))
    with monkeypatch.context() as patch:
        patch.setattr(module, step.partition(".")[2], broken)
        with pytest.raises(OSError, match="lost"):
            append_once(rows, table, "march")
    both = expected + bag(there)
    assert bag(read_mart(spark, table)) in (bag(there), both)
    added = bag(read_mart(spark, table)) == both
    assert append_once(rows, table, "march") is not added
    assert append_once(rows, table, "march") is False
    assert bag(read_mart(spark, table)) == both
    assert list(committed_loads(spark, table)) == ["march"]


def test_named_loads(spark, src, expected, table):
    for load in ("a", "a", "b", "a"):
        run_backfill(spark, src, table, START, END, mode="append", source_bytes=10**6, load=load)
    assert bag(read_mart(spark, table)) == Counter({row: 2 * n for row, n in expected.items()})
    loads = committed_loads(spark, table)
    assert sorted(loads) == ["a", "b"] and loads["a"].startswith(f"{sum(expected.values())} rows, 2025-")
    compact_range(spark, table)
    run_backfill(spark, src, table, START, END, source_bytes=10**6)
    assert sorted(committed_loads(spark, table)) == ["a", "b"]  # what replaces rows does not forget their loads
    assert append_once(mart_frame(spark), table, "empty") is True
    with pytest.raises(ValueError, match="appending"):
        run_backfill(spark, src, table, START, END, source_bytes=10**6, load="c")


def test_day_that_lost_its_sales(spark, src, expected, table):
    run_backfill(spark, src, table, START, END, source_bytes=10**6)
    without = edge_sources(spark, documents_tabular_part=[line for line in LINES if line[0] != 11])
    run_daily(spark, without, table, "2025-03-19", source_bytes=10**6)
    gone = Counter({row: n for row, n in expected.items() if row[0] != dt.date(2025, 3, 19)})
    assert bag(read_mart(spark, table)) == gone


def test_staged_copies_are_removed(spark, src, table):
    from pathlib import Path

    from lineledger.scratch import shared_folder

    shared = Path(shared_folder(spark).removeprefix("file:"))
    before = set(shared.glob("stage-*"))
    run_daily(spark, src, table, "2025-03-15", source_bytes=10**6)
    assert shared.exists()
    assert set(shared.glob("stage-*")) == before


def test_command_line(spark, src, expected, table):
    from lineledger.__main__ import main
    from lineledger.scratch import new_folder

    folder = new_folder(spark, "sources")
    tables = {
        "nomenclatures": src.nomenclatures,
        "departments": src.departments,
        "documents": src.documents,
        "view_departments_with_root_folders": src.department_roots,
        "documents_tabular_part": src.document_lines,
        "employees": src.employees,
    }
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}")
    place = ["--parquet", folder, "--table", table, "--location", new_folder(spark, "mart")]
    main(["backfill", *place, "--start", START, "--end", END])
    main(["daily", *place, "--day", "2025-03-15", "--compact"])
    assert bag(read_mart(spark, table)) == expected
    for wrong in (["daily", *place], ["backfill", "--table", table, "--start", START, "--end", END]):
        with pytest.raises(SystemExit):
            main(wrong)


def test_command_line_of_a_database(spark, src, expected, table, tmp_path, monkeypatch):
    """Sources and sink in a database, which a stand-in plays."""
    import lineledger.__main__ as command

    names = {"view_departments_with_root_folders": "department_roots", "documents_tabular_part": "document_lines"}
    opened, sent = {}, []

    def reader(url, properties, splits):
        opened.update(url=url, properties=properties, splits=splits)
        return lambda _, name: getattr(src, names.get(name, name))

    def sink(rows, name, **to):
        sent.append((bag(rows), name, to))

    login, config = tmp_path / "login.json", tmp_path / "config.json"
    login.write_text(json.dumps({"user": "u"}))
    config.write_text(json.dumps({"representatives": ["Рефералы"], "folder_depth": 4}))
    splits = ["--split", "documents=document_id:1:900:4", "--split", "documents_tabular_part=document_id:1:900:8"]
    place = ["--jdbc", "jdbc:x:y", "--jdbc-options", str(login), "--table", table, "--config", str(config)]
    to = ["--sink-jdbc", "jdbc:z", "--sink-table", "mart", "--sink-options", str(login), "--sink-connections", "3"]
    window = ["--start", START, "--end", END]
    with monkeypatch.context() as patch:
        patch.setattr(command, "database_reader", reader)
        patch.setattr(command, "append_database", sink)
        command.main(["backfill", *place, *splits, *window, "--source-bytes", "1000000", *to])
    assert opened["url"] == "jdbc:x:y" and opened["properties"] == {"user": "u"}
    assert opened["splits"]["documents"] == {"partition_column": "document_id", "bounds": (1, 900), "num_partitions": 4}
    assert sent == [(expected, "mart", {"url": "jdbc:z", "properties": {"user": "u"}, "connections": 3})]
    assert bag(read_mart(spark, table)) == expected
    config.write_text(json.dumps({"depth": 4}))
    for wrong in (
        ["backfill", *place[:-2], *splits, *window],  # no size
        ["backfill", *place[:-2], *splits[:2], *window, "--source-bytes", "9"],  # lines not split
        ["backfill", *place[:-2], "--split", "documents=x", *window, "--source-bytes", "9"],
        ["backfill", *place[:-2], *splits, *window, "--source-bytes", "9", "--sink-jdbc", "jdbc:z"],
        ["backfill", *place, *splits, *window, "--source-bytes", "9"],  # unknown setting
    ):
        with pytest.raises(SystemExit):
            command.main(wrong)
