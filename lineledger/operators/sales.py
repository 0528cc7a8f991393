"""Sales documents: all shipments of a window, and partner shipments credited to the invoice's author."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineledger.config import CHANGED, INVOICE_TYPE, NOT_CHANGED, PARTNER_ROOT, MartConfig
from lineledger.functions import in_window
from lineledger.functions.dates import Day

SALES_COLUMNS = (
    "sbis_shipment_date",
    "document_id",
    "number",
    "department_id",
    "employee_id",
    "realization",
)


def shipped_documents(documents: DataFrame, start: Day, end: Day) -> DataFrame:
    """Shipments in ``[start, end)`` with a positive total that are not deleted."""
    return documents.where(
        in_window(F.col("sbis_shipment_date"), start, end)
        & (F.col("shipment") == 1)
        & (F.col("invoice_total_sum_calculated") > 0)
        & (F.col("deleted") == 0)
    )


def outgoing_invoices(documents: DataFrame, invoice_type: str = INVOICE_TYPE) -> DataFrame:
    """Invoices that are not deleted, of any date."""
    return documents.where((F.col("document_type") == invoice_type) & (F.col("deleted") == 0))


def partner_shipments(shipped: DataFrame, department_roots: DataFrame, partner_root: int = PARTNER_ROOT) -> DataFrame:
    """Shipments by a department below the partner root, once per matching row of the root table."""
    partners = department_roots.where(F.col("root_id") == partner_root).select("department_id")
    return shipped.join(partners, "department_id")


def credited_to_invoice(
    by_partners: DataFrame, documents: DataFrame, invoice_type: str = INVOICE_TYPE
) -> DataFrame:
    """Partner shipments whose invoice has another author, once per invoice, credited to that author.

    Only partner shipments and invoices meet on ``number``. A number that holds a large share of the documents
    makes one large join partition; both sides of an inner sort-merge join may be split at run time, and the
    matches go on as rows, never as a collected group.
    """
    shipments = by_partners.select(
        "sbis_shipment_date", "document_id", "number", F.col("employee_id").alias("shipped_by")
    )
    invoices = outgoing_invoices(documents, invoice_type).select("number", "department_id", "employee_id")
    other_author = F.col("shipped_by") != F.col("employee_id")  # NULL on either side is no match
    return (
        shipments.join(invoices, "number")
        .where(other_author)
        .withColumn("realization", F.lit(CHANGED))
        .select(*SALES_COLUMNS)
    )


def credited_to_shipment(shipped: DataFrame) -> DataFrame:
    """Every shipment, credited to its own author."""
    return shipped.withColumn("realization", F.lit(NOT_CHANGED)).select(*SALES_COLUMNS)


def sales_changed(
    documents: DataFrame,
    department_roots: DataFrame,
    start: Day,
    end: Day,
    config: MartConfig = MartConfig(),
) -> DataFrame:
    """Re-credited partner shipments of the window."""
    shipped = shipped_documents(documents, start, end)
    by_partners = partner_shipments(shipped, department_roots, config.partner_root)
    return credited_to_invoice(by_partners, documents, config.invoice_type)


def sales_not_changed(documents: DataFrame, start: Day, end: Day) -> DataFrame:
    """All shipments of the window, those of ``sales_changed`` among them."""
    return credited_to_shipment(shipped_documents(documents, start, end))


def sales(
    documents: DataFrame,
    department_roots: DataFrame,
    start: Day,
    end: Day,
    config: MartConfig = MartConfig(),
) -> DataFrame:
    """Both attributions. Summing over ``realization`` counts a re-credited document twice, as intended."""
    return sales_changed(documents, department_roots, start, end, config).unionByName(
        sales_not_changed(documents, start, end)
    )
