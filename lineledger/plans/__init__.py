"""The mart as a whole and the jobs that load it."""

from lineledger.plans.jobs import Trees, differing_days, run_backfill, run_corrections, run_daily, stage_trees
from lineledger.plans.mart import (
    credited_sales,
    join_lines,
    label_sales,
    lines_of,
    mart_rows,
    normalize_mart,
    products,
    sales_mart,
)

__all__ = [
    "Trees",
    "credited_sales",
    "differing_days",
    "join_lines",
    "label_sales",
    "lines_of",
    "mart_rows",
    "normalize_mart",
    "products",
    "run_backfill",
    "run_corrections",
    "run_daily",
    "sales_mart",
    "stage_trees",
]
