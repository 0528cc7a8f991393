"""Stages of the mart; each takes DataFrames and returns one."""

from lineledger.operators.bloom import blocks_for, bloom_bytes, bloom_filter, maybe_in
from lineledger.operators.departments import department_hierarchy, department_subtree
from lineledger.operators.folders import (
    child_folders,
    folder_listing,
    folder_tree,
    live_folders,
    product_hierarchy,
    root_folders,
)
from lineledger.operators.sales import (
    credited_to_invoice,
    credited_to_shipment,
    outgoing_invoices,
    partner_shipments,
    sales,
    sales_changed,
    sales_not_changed,
    shipped_documents,
)

__all__ = [
    "blocks_for",
    "bloom_bytes",
    "bloom_filter",
    "child_folders",
    "credited_to_invoice",
    "credited_to_shipment",
    "department_hierarchy",
    "department_subtree",
    "folder_listing",
    "folder_tree",
    "live_folders",
    "maybe_in",
    "outgoing_invoices",
    "partner_shipments",
    "product_hierarchy",
    "root_folders",
    "sales",
    "sales_changed",
    "sales_not_changed",
    "shipped_documents",
]
