"""Where the mart goes."""

from lineledger.sinks.database import append_database
from lineledger.sinks.table import (
    append_mart,
    append_once,
    clear_day,
    committed_loads,
    compact_day,
    compact_month,
    compact_range,
    day_digests,
    ensure_table,
    loaded_days,
    month_of_mart,
    read_mart,
    replace_day,
    replace_days,
    replace_range,
)
from lineledger.sinks.versions import remove_old_versions

__all__ = [
    "append_database",
    "append_mart",
    "append_once",
    "clear_day",
    "committed_loads",
    "compact_day",
    "compact_month",
    "compact_range",
    "day_digests",
    "ensure_table",
    "loaded_days",
    "month_of_mart",
    "read_mart",
    "remove_old_versions",
    "replace_day",
    "replace_days",
    "replace_range",
]
