"""Null handling of the finished mart: its target columns hold no nulls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_or_empty(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def price_or_nan(value: Column, nan_price: bool = True) -> Column:
    price = value.cast("double")
    return F.coalesce(price, F.lit(float("nan"))) if nan_price else price
