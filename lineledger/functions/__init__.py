"""Column functions; all of them are built-in Spark expressions."""

from lineledger.functions.cleaning import price_or_nan, text_or_empty
from lineledger.functions.dates import as_day, in_window, iso_day, month_window, next_day, yyyymm
from lineledger.functions.labels import department_group, label_or, short_name
from lineledger.functions.paths import path_append, path_entry, path_start

__all__ = [
    "as_day",
    "department_group",
    "in_window",
    "iso_day",
    "label_or",
    "month_window",
    "next_day",
    "path_append",
    "path_entry",
    "path_start",
    "price_or_nan",
    "short_name",
    "text_or_empty",
    "yyyymm",
]
