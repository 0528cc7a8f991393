"""The two loads: any range of days, and the replacement of one day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineledger.config import MartConfig
from lineledger.functions import as_day, in_window, next_day
from lineledger.functions.dates import Day
from lineledger.operators import (
    credited_to_invoice,
    credited_to_shipment,
    department_hierarchy,
    folder_tree,
    partner_shipments,
    shipped_documents,
)
from lineledger.plans.mart import join_lines, label_sales, lines_of, mart_rows, normalize_mart, products
from lineledger.schemas import MART_COLUMNS
from lineledger.scratch import Stage, staging
from lineledger.session import known_bytes, sized_shuffles
from lineledger.sinks.table import (
    append_mart,
    append_once,
    committed_loads,
    compact_day,
    day_digests,
    ensure_table,
    read_mart,
    replace_day,
    replace_days,
    replace_range,
)
from lineledger.sources.tables import Sources

SHIPPED_COLUMNS = ("sbis_shipment_date", "document_id", "number", "department_id", "employee_id")


@dataclass(frozen=True)
class Trees:
    """Department hierarchy and folder tree, stored; several loads can share them."""

    units: DataFrame
    folders: DataFrame


def stage_trees(spark: SparkSession, stage: Stage, sources: Sources, config: MartConfig = MartConfig()) -> Trees:
    """Both trees, stored at the same time.

    The planner cannot estimate them through a recursion and a chain of joins. Written down their sizes are
    known: a small one is broadcast and the large side stays where it is, a large one is joined by shuffle.
    """

    units, folders = at_once(
        spark,
        lambda: stage(department_hierarchy(sources.departments, config, stage), "units"),
        lambda: folder_tree(sources.nomenclatures, config.folder_depth, stage),
    )
    return Trees(units, folders)


def at_once(spark: SparkSession, *actions: Callable[[], Any]) -> list[Any]:
    """Results of actions whose jobs do not depend on each other; the first error is raised when all have ended."""
    with ThreadPoolExecutor(len(actions)) as threads:
        running = [threads.submit(inheritable_thread_target(spark)(action)) for action in actions]
    return [action.result() for action in running]


def _sold(sources: Sources, shipped: DataFrame, by_partners: DataFrame, config: MartConfig) -> DataFrame:
    changed = credited_to_invoice(by_partners, sources.documents, config.invoice_type)
    return changed.unionByName(credited_to_shipment(shipped))


def _shipped(stage: Stage, sources: Sources, start: Day, end: Day, **how: bool) -> DataFrame:
    shipped = shipped_documents(sources.documents, start, end).select(*SHIPPED_COLUMNS)
    return stage(shipped, "shipped", **how)


def _range_rows(
    spark: SparkSession, stage: Stage, sources: Sources, start: Day, end: Day, config: MartConfig, trees: Trees | None
) -> DataFrame:
    """Normalised rows of many days.

    The shipments are used three times and scanned once. Departments, catalogue and documents are worked out side by
    side.
    """

    def units() -> DataFrame:
        return trees.units if trees else stage(department_hierarchy(sources.departments, config, stage), "units")

    def catalogue() -> DataFrame:
        folders = trees.folders if trees else folder_tree(sources.nomenclatures, config.folder_depth, stage)
        return stage(products(sources, config, folders), "catalogue")

    def documents() -> tuple[DataFrame, DataFrame]:
        shipped = _shipped(stage, sources, start, end, rebalance=False)
        by_partners = partner_shipments(shipped, sources.department_roots, config.partner_root)
        by_partners, lines = at_once(
            spark,
            lambda: stage(by_partners, "by_partners", rebalance=False),
            lambda: lines_of(sources.document_lines, shipped, stage),
        )
        return _sold(sources, shipped, by_partners, config), lines

    units, catalogue, (sold, lines) = at_once(spark, units, catalogue, documents)
    credited = label_sales(sold, units, sources.employees, config)
    return normalize_mart(join_lines(credited, lines, catalogue))


def _day_rows(
    spark: SparkSession, stage: Stage, sources: Sources, day: Day, config: MartConfig, trees: Trees | None
) -> DataFrame:
    """Normalised rows of one day.

    The day's labelled documents are stored, and its lines; both are small beside the tables that they come
    from, and known to be, so the planner broadcasts them and neither the lines nor the catalogue are shuffled. Only
    the day's products get a path. Trees and lines are worked out side by side.
    """

    def documents() -> tuple[DataFrame, DataFrame]:
        shipped = _shipped(stage, sources, day, next_day(day))
        lines = lines_of(sources.document_lines, shipped, stage)
        return shipped, stage(lines.join(shipped.select("document_id"), "document_id", "left_semi"), "lines")

    trees, (shipped, lines) = at_once(spark, lambda: trees or stage_trees(spark, stage, sources, config), documents)
    by_partners = partner_shipments(shipped, sources.department_roots, config.partner_root)
    sold = _sold(sources, shipped, by_partners, config)
    credited = stage(label_sales(sold, trees.units, sources.employees, config), "credited")
    catalogue = products(sources, config, trees.folders, lines.select("nomenclature_code"))
    return normalize_mart(join_lines(credited, lines, catalogue))


def run_backfill(
    spark: SparkSession,
    sources: Sources,
    table: str,
    start: Day,
    end: Day,
    *,
    config: MartConfig = MartConfig(),
    mode: str = "replace",
    location: str | None = None,
    source_bytes: int | None = None,
    trees: Trees | None = None,
    sink: Callable[[DataFrame], None] | None = None,
    load: str | None = None,
) -> None:
    """Loads ``[start, end)``. ``append`` adds rows, also a second time; ``replace`` can be run again.

    With a name for the ``load``, ``append`` adds its rows once, however often it is run, and ``sink`` gets them when
    they are added.
    ``source_bytes`` is the size of the largest source table, for sources whose size the planner does not know.
    ``sink`` takes the rows after the table has them, as for a copy in a database: the rows that were loaded, read
    back from the table when replacing, and the load's own rows when appending.
    """
    if mode not in ("append", "replace"):
        raise ValueError("mode is 'append' or 'replace'")
    if load is not None and mode != "append":
        raise ValueError("only an appending load needs a name")
    size = known_bytes(source_bytes, sources.documents, sources.document_lines)
    ensure_table(spark, table, location)
    if load is not None and load in committed_loads(spark, table):
        return
    with staging(spark) as stage, sized_shuffles(spark, size):
        rows = _range_rows(spark, stage, sources, start, end, config, trees)
        if mode == "append":
            rows = rows if sink is None else stage(rows, "rows")
            if load is None:
                append_mart(rows, table)
            elif not append_once(rows, table, load):
                return
        else:
            replace_range(rows, table, start, end)
            rows = read_mart(spark, table).where(in_window(F.col("date"), start, end))
        if sink is not None:
            sink(rows)


def run_daily(
    spark: SparkSession,
    sources: Sources,
    table: str,
    day: Day,
    *,
    config: MartConfig = MartConfig(),
    location: str | None = None,
    compact: bool = False,
    source_bytes: int | None = None,
    trees: Trees | None = None,
    sink: Callable[[DataFrame], None] | None = None,
) -> None:
    """Replaces one day; running it again changes nothing, and a day without sales ends empty.

    ``trees`` saves storing them again for each of several days. ``sink`` takes the day's rows, read back from the
    table.
    """
    size = known_bytes(source_bytes, sources.documents)
    ensure_table(spark, table, location)
    with staging(spark) as stage, sized_shuffles(spark, size):
        replace_day(_day_rows(spark, stage, sources, day, config, trees), table, day)
    if compact:
        compact_day(spark, table, day)
    if sink is not None:
        sink(read_mart(spark, table).where(F.col("date") == F.lit(as_day(day))))


def differing_days(
    spark: SparkSession, sources: Sources, table: str, start: Day, end: Day, *, config: MartConfig = MartConfig()
) -> list[dt.date]:
    """Days in ``[start, end)`` of which the table does not hold what the sources now give.

    Each side is reduced to a digest per day, over all its rows: a late correction of a document, line or name
    shows in the days that it touches, and how the rows are stored does not matter. Only a row per day leaves the tasks.
    """
    start, end = as_day(start), as_day(end)
    months = F.col("yyyymm").between(start.year * 100 + start.month, end.year * 100 + end.month)
    held = spark.table(table).where(months & in_window(F.col("date"), start, end)).select(*MART_COLUMNS)
    given = normalize_mart(mart_rows(sources, start, end, config))
    sides = [day_digests(rows).withColumnsRenamed({"rows": f"rows{k}", "digest": f"digest{k}"}) for k, rows in enumerate((held, given))]
    joined = sides[0].join(sides[1], "date", "full_outer")
    same = F.col("rows0").eqNullSafe(F.col("rows1")) & F.col("digest0").eqNullSafe(F.col("digest1"))
    return sorted(row["date"] for row in joined.where(~same).select("date").collect())


def run_corrections(
    spark: SparkSession,
    sources: Sources,
    table: str,
    start: Day,
    end: Day,
    *,
    config: MartConfig = MartConfig(),
    source_bytes: int | None = None,
    trees: Trees | None = None,
) -> list[dt.date]:
    """Replaces the days in ``[start, end)`` whose sources have changed since they were loaded; returns them.

    All other days keep their files. The days are replaced at once.
    """
    size = known_bytes(source_bytes, sources.documents, sources.document_lines)
    ensure_table(spark, table)
    with staging(spark) as stage, sized_shuffles(spark, size):
        days = differing_days(spark, sources, table, start, end, config=config)
        if days:
            rows = _range_rows(spark, stage, sources, days[0], next_day(days[-1]), config, trees)
            replace_days(rows.where(F.col("date").isin(days)), table, days)
    return days
