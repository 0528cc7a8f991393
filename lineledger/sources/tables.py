"""The six source tables with their declared schemas."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineledger.schemas import KEPT_AS_STORED, SOURCE_SCHEMAS

Reader = Callable[[SparkSession, str], DataFrame]


class Sources:
    """The six tables; each is opened when it is first asked for."""

    def __init__(self, scan: Callable[[str], DataFrame]) -> None:
        self._scan = scan

    @cached_property
    def nomenclatures(self) -> DataFrame:
        return self._scan("nomenclatures")

    @cached_property
    def departments(self) -> DataFrame:
        return self._scan("departments")

    @cached_property
    def documents(self) -> DataFrame:
        return self._scan("documents")

    @cached_property
    def department_roots(self) -> DataFrame:
        return self._scan("view_departments_with_root_folders")

    @cached_property
    def document_lines(self) -> DataFrame:
        return self._scan("documents_tabular_part")

    @cached_property
    def employees(self) -> DataFrame:
        return self._scan("employees")


def conform(df: DataFrame, table: str) -> DataFrame:
    """``df`` with exactly the declared columns of ``table``, in order and type.

    A shipment time becomes its day here, in the session's time zone if it is an instant. Spark turns a filter
    on that day back into one on the stored timestamp, so it still reaches the scan.
    """
    columns = []
    for field in SOURCE_SCHEMAS[table]:
        column = F.col(field.name)
        if field.name not in KEPT_AS_STORED:
            column = column.cast(field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def load_sources(spark: SparkSession, reader: Reader) -> Sources:
    """Scans of the six tables; ``reader(spark, name)`` says where a table is read from."""
    return Sources(lambda table: conform(reader(spark, table), table))


def parquet_reader(folder: str) -> Reader:
    """Tables as ``<folder>/<table>``, each a parquet file or directory."""
    return lambda spark, table: spark.read.parquet(f"{folder.rstrip('/')}/{table}")


def catalog_reader(schema: str | None = None) -> Reader:
    """Tables of the session catalog, in ``schema`` when given."""
    return lambda spark, table: spark.table(f"{schema}.{table}" if schema else table)
