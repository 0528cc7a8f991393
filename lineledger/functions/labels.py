"""Labels that readers of the mart see instead of ids and nulls."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lineledger.config import (
    GROUP_OFFICE,
    GROUP_REPRESENTATIVES,
    REPRESENTATIVES,
    UNKNOWN,
)


def department_group(department: Column, representatives: Iterable[str] = REPRESENTATIVES) -> Column:
    """Representatives, office, or unknown when there is no department."""
    return (
        F.when(department.isNull(), F.lit(UNKNOWN))
        .when(department.isin(list(representatives)), F.lit(GROUP_REPRESENTATIVES))
        .otherwise(F.lit(GROUP_OFFICE))
    )


def label_or(value: Column, default: str) -> Column:
    return F.coalesce(value, F.lit(default))


def short_name(first_name: Column, last_name: Column) -> Column:
    """``First L.``; unknown without a last name, NULL when only the first name is missing."""
    initial = F.left(last_name, F.lit(1))
    return F.when(
        last_name.isNotNull(), F.concat(first_name, F.lit(" "), initial, F.lit("."))
    ).otherwise(F.lit(UNKNOWN))
