"""Line-level sales mart on Spark."""

from lineledger.config import MartConfig
from lineledger.plans import normalize_mart, run_backfill, run_corrections, run_daily, sales_mart
from lineledger.sources import Sources, load_sources

__all__ = [
    "MartConfig",
    "Sources",
    "load_sources",
    "normalize_mart",
    "run_backfill",
    "run_corrections",
    "run_daily",
    "sales_mart",
]
