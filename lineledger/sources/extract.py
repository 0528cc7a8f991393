"""The mart as a CSV extract: a directory of files with a header, read back with the declared schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from lineledger.schemas import MART_SCHEMA

# Text comes back as it was written: quotes doubled, line breaks kept, no trimming. Only '' comes back as NULL,
# which normalising turns into '' again.
_TEXT_AS_IS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "dateFormat": "yyyy-MM-dd",
    "encoding": "UTF-8",
}


def extract_name(at: dt.datetime, prefix: str = "sales_mart") -> str:
    return f"{prefix}_{at:%Y%m%d_%H%M%S}.csv"


def write_extract(df: DataFrame, folder: str, at: dt.datetime, prefix: str = "sales_mart") -> str:
    """Writes ``df`` below ``folder`` under a name with the time ``at`` and returns the path."""
    path = f"{folder.rstrip('/')}/{extract_name(at, prefix)}"
    # A file with line breaks in quoted text is read by one task: rebalancing keeps the files of even size.
    df.hint("rebalance").write.options(**_TEXT_AS_IS).csv(path)
    return path


def read_extract(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(MART_SCHEMA)
        .options(**_TEXT_AS_IS, multiLine=True, enforceSchema=False, mode="FAILFAST")
        .csv(path)
    )
