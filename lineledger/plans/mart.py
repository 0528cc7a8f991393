"""The sales mart: one row per credited document, line, matching product and matching department."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineledger.config import UNKNOWN, UNKNOWN_SECTION, MartConfig
from lineledger.functions import (
    department_group,
    iso_day,
    label_or,
    price_or_nan,
    short_name,
    text_or_empty,
)
from lineledger.functions.dates import Day
from lineledger.operators import (
    blocks_for,
    bloom_bytes,
    bloom_filter,
    department_hierarchy,
    folder_tree,
    maybe_in,
    product_hierarchy,
    sales,
)
from lineledger.schemas import MART_COLUMNS
from lineledger.sources.tables import Sources

BLOOM_BYTES = 64 * 1024**2  # of a filter that is sent to every executor: some fifty million documents


def products(
    sources: Sources, config: MartConfig = MartConfig(), tree: DataFrame | None = None, codes: DataFrame | None = None
) -> DataFrame:
    """The product hierarchy, over a folder tree that is there already and for some codes only, if given."""
    goods = sources.nomenclatures
    tree = folder_tree(goods, config.folder_depth) if tree is None else tree
    goods = goods if codes is None else goods.join(codes, "nomenclature_code", "left_semi")
    return product_hierarchy(goods, tree, config.folder_name_length)


def label_sales(
    sold: DataFrame, units: DataFrame, employees: DataFrame, config: MartConfig = MartConfig()
) -> DataFrame:
    """Sales documents with the labels of a department hierarchy and the employee's name."""
    department = F.col("department")
    return (
        sold.join(units.drop("original_parent_id"), "department_id", "left")
        .join(employees.select("employee_id", "first_name", "last_name"), "employee_id", "left")
        .select(
            F.col("sbis_shipment_date").alias("date"),
            "document_id",
            "number",
            department_group(department, config.representatives).alias("root_department"),
            label_or(department, UNKNOWN).alias("department"),
            label_or(F.col("section"), UNKNOWN_SECTION).alias("section"),
            label_or(F.col("sector"), UNKNOWN).alias("sector"),
            short_name(F.col("first_name"), F.col("last_name")).alias("employe_name"),
            "realization",
        )
    )


def credited_sales(sources: Sources, start: Day, end: Day, config: MartConfig = MartConfig()) -> DataFrame:
    """The window's sales documents with their labels.

    Labels are joined here, before the lines, while there is one row per document and not one per line.
    """
    return label_sales(
        sales(sources.documents, sources.department_roots, start, end, config),
        department_hierarchy(sources.departments, config),
        sources.employees,
        config,
    )


def lines_of(
    document_lines: DataFrame, stored: DataFrame, stage: Callable[[DataFrame, str], DataFrame] | None = None
) -> DataFrame:
    """The lines that may belong to ``stored`` documents; the join that follows is exact.

    They lie between the lowest and the highest id. Where ids grow with time, these bounds keep most of the largest
    table out of the scan for a narrow window; they are literals that row-group statistics or a database can use.
    With ``stage``, which stores a frame under a name, a Bloom filter of the ids drops lines of other documents where
    they are read, in any order of ids, as long as the filter is no larger than :data:`BLOOM_BYTES`. Bounds and filter
    are worked out now and stay what they are, so the documents have to be a stored copy that does not change any
    more.
    """
    ids = stored.select("document_id")
    lowest, highest, count = ids.agg(F.min("document_id"), F.max("document_id"), F.count("document_id")).first()
    if lowest is None:
        return document_lines.where(F.lit(False))
    lines = document_lines.where(F.col("document_id").between(lowest, highest))
    if stage is None or bloom_bytes(count) > BLOOM_BYTES:
        return lines
    blocks = blocks_for(count)
    return maybe_in(lines, "document_id", stage(bloom_filter(ids, blocks), "bloom"), blocks)


def join_lines(credited: DataFrame, lines: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Credited documents with their lines and the matching products; documents without lines drop out."""
    return (
        credited.join(lines, "document_id")
        .join(catalogue, "nomenclature_code", "left")
        .select(*MART_COLUMNS)
    )


def mart_rows(sources: Sources, start: Day, end: Day, config: MartConfig = MartConfig()) -> DataFrame:
    """The mart with the date as a date and nulls as they are."""
    return join_lines(
        credited_sales(sources, start, end, config),
        sources.document_lines,
        products(sources, config),
    )


def sales_mart(sources: Sources, start: Day, end: Day, config: MartConfig = MartConfig()) -> DataFrame:
    """The mart as a query result: 14 columns, the date as ISO text, nulls not yet filled."""
    return mart_rows(sources, start, end, config).withColumn("date", iso_day(F.col("date")))


def normalize_mart(df: DataFrame, nan_price: bool = True) -> DataFrame:
    """Target types without nulls: a date, text with ``''`` for NULL, and a price with NaN for NULL.

    ``nan_price=False`` leaves a missing price NULL.
    """
    special = {
        "date": F.to_date("date"),
        "nomenclature_price_total": price_or_nan(F.col("nomenclature_price_total"), nan_price),
    }
    return df.select(*[special.get(c, text_or_empty(F.col(c))).alias(c) for c in MART_COLUMNS])
