"""Declared schemas of the six sources and of the mart; nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Table and column names of the operational database.
SOURCE_SCHEMAS: dict[str, StructType] = {
    "nomenclatures": _struct(
        nomenclature_id=LongType(),
        nomenclature_code=LongType(),
        name=StringType(),
        root_folder_id=LongType(),
        folder=LongType(),
        isFolder=IntegerType(),
        deleted=IntegerType(),
    ),
    "departments": _struct(
        department_id=LongType(),
        department_name=StringType(),
        parent_department_id=LongType(),
    ),
    "documents": _struct(
        document_id=LongType(),
        number=StringType(),
        sbis_shipment_date=DateType(),
        shipment=IntegerType(),
        invoice_total_sum_calculated=DoubleType(),
        deleted=IntegerType(),
        document_type=StringType(),
        department_id=LongType(),
        employee_id=LongType(),
    ),
    "view_departments_with_root_folders": _struct(
        department_id=LongType(),
        root_id=LongType(),
    ),
    "documents_tabular_part": _struct(
        document_id=LongType(),
        nomenclature_code=LongType(),
        nomenclature_price_total=DoubleType(),
    ),
    "employees": _struct(
        employee_id=LongType(),
        first_name=StringType(),
        last_name=StringType(),
    ),
}

# Columns that keep the type they are stored with: product codes may be numbers or text, and casting a
# decimal amount would keep the filter on it from reaching the scan.
KEPT_AS_STORED = frozenset({"nomenclature_code", "invoice_total_sum_calculated", "nomenclature_price_total"})

# The mart's columns, in load order.
MART_SCHEMA = _struct(
    date=DateType(),
    number=StringType(),
    root_department=StringType(),
    department=StringType(),
    section=StringType(),
    sector=StringType(),
    employe_name=StringType(),
    root_folder=StringType(),
    folder_1=StringType(),
    folder_2=StringType(),
    folder_3=StringType(),
    name=StringType(),
    nomenclature_price_total=DoubleType(),
    realization=StringType(),
)
MART_COLUMNS = tuple(MART_SCHEMA.fieldNames())
