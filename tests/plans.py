"""Reading executed plans."""

from __future__ import annotations

from pyspark.sql import DataFrame


def executed(df: DataFrame) -> str:
    """The final plan after running ``df``, subplans of the recursion included only as their root."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def planned(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
