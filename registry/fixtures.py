"""The mart's six sources, derived from the test tables.

The text of each table runs in Spark and in DuckDB alike; ``{orders}`` and the like stand for a test table.
The test table ``documents`` holds prose and has nothing to do with the mart's documents, hence the ``src_``
names. Every row of a test table feeds each source that the table is mapped to; conditions on ids only deal out
roles. Every customer is an employee, and every customer is a row of the catalogue: a folder of the fourth or
fifth level or a good that nobody buys. Every order is a shipment. That an order has one invoice, two or none is
a role as well, since shipments without an invoice are a case of their own.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from lineledger.config import MartConfig
from lineledger.sources import Sources, load_sources

CONFIG = MartConfig(
    section_parent_ids=(100, 101, 102),
    section_ids=(201, 203, 208, 213),
    flat_ids=(100, 101, 102, 104),
    partner_root=100,
    representatives=("AFRICA",),
)
START = dt.date(1997, 1, 1)
END = dt.date(1997, 8, 1)
DAY = dt.date(1997, 3, 15)
MONTH = 199703

TEST_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}

_NOMENCLATURES = """
SELECT CAST(900000 + r_regionkey AS BIGINT) AS nomenclature_id, CAST(NULL AS BIGINT) AS nomenclature_code,
       r_name AS name, CAST(0 AS BIGINT) AS root_folder_id, CAST(NULL AS BIGINT) AS folder,
       CAST(1 AS INT) AS isFolder, CAST(0 AS INT) AS deleted
FROM {region}
UNION ALL
SELECT CAST(910000 + n_nationkey AS BIGINT), CAST(n_nationkey AS BIGINT), n_name,
       CAST(900000 + n_regionkey AS BIGINT), CAST(900000 + n_regionkey AS BIGINT),
       CAST(1 AS INT), CAST(CASE WHEN n_nationkey = 24 THEN 1 ELSE 0 END AS INT)
FROM {nation}
UNION ALL
SELECT CAST(920000 + s_suppkey AS BIGINT), CAST(NULL AS BIGINT), s_name, CAST(900000 AS BIGINT),
       CAST(910000 + s_nationkey AS BIGINT), CAST(1 AS INT), CAST(0 AS INT)
FROM {supplier}
UNION ALL
SELECT CAST(1000000 + c_custkey AS BIGINT), CAST(NULL AS BIGINT),
       c_name || ' / a folder name longer than fifty characters', CAST(900000 AS BIGINT),
       CAST(920000 + c_custkey % 7 AS BIGINT), CAST(1 AS INT), CAST(0 AS INT)
FROM {customer} WHERE c_custkey % 10 = 0
UNION ALL
SELECT CAST(1000000 + c_custkey AS BIGINT), CAST(NULL AS BIGINT), c_name, CAST(900000 AS BIGINT),
       CAST(1000000 + c_custkey - 1 AS BIGINT), CAST(1 AS INT), CAST(0 AS INT)
FROM {customer} WHERE c_custkey % 10 = 1
UNION ALL
SELECT CAST(1000000 + c_custkey AS BIGINT), CAST(100000000 + c_custkey AS BIGINT), c_name, CAST(900000 AS BIGINT),
       CAST(1000000 + 10 * (c_custkey % 15) AS BIGINT), CAST(NULL AS INT),
       CAST(CASE WHEN c_custkey % 10 = 2 THEN 1 ELSE 0 END AS INT)
FROM {customer} WHERE c_custkey % 10 > 1
UNION ALL
SELECT CAST(5000000 + p_partkey AS BIGINT), CAST(p_partkey AS BIGINT), p_name, CAST(900000 AS BIGINT),
       CAST(CASE p_size % 6 WHEN 0 THEN 900000 + p_partkey % 5
                            WHEN 1 THEN 910000 + p_partkey % 25
                            WHEN 2 THEN 920000 + p_partkey % 10
                            WHEN 3 THEN 1000000 + 10 * (p_partkey % 15)
                            WHEN 4 THEN 1000001 + 10 * (p_partkey % 15) END AS BIGINT),
       CAST(NULL AS INT), CAST(CASE WHEN p_partkey % 50 = 0 THEN 1 ELSE 0 END AS INT)
FROM {part}
"""

_DEPARTMENTS = """
SELECT CAST(100 + r_regionkey AS BIGINT) AS department_id, r_name AS department_name,
       CAST(NULL AS BIGINT) AS parent_department_id
FROM {region}
UNION ALL
SELECT CAST(200 + n_nationkey AS BIGINT), n_name, CAST(100 + n_regionkey AS BIGINT) FROM {nation}
UNION ALL
SELECT CAST(1000 + s_suppkey AS BIGINT), s_name, CAST(200 + s_nationkey AS BIGINT) FROM {supplier}
"""

_DEPARTMENT_ROOTS = """
SELECT CAST(100 + r_regionkey AS BIGINT) AS department_id, CAST(100 + r_regionkey AS BIGINT) AS root_id
FROM {region}
UNION ALL
SELECT CAST(200 + n_nationkey AS BIGINT), CAST(100 + n_regionkey AS BIGINT) FROM {nation}
UNION ALL
SELECT CAST(1000 + s_suppkey AS BIGINT), CAST(100 + n_regionkey AS BIGINT)
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
"""

_EMPLOYEES = """
SELECT CAST(c_custkey AS BIGINT) AS employee_id,
       CASE WHEN c_custkey % 33 = 0 THEN NULL ELSE c_mktsegment END AS first_name,
       CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE c_name END AS last_name
FROM {customer}
"""

_DOCUMENTS = """
SELECT CAST(o_orderkey AS BIGINT) AS document_id, lpad(CAST(o_orderkey AS STRING), 8, '0') AS number,
       CAST(o_orderdate AS DATE) AS sbis_shipment_date,
       CAST(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS INT) AS shipment,
       CAST(CASE WHEN o_orderkey % 40 = 0 THEN 0 ELSE o_totalprice END AS DOUBLE) AS invoice_total_sum_calculated,
       CAST(CASE WHEN o_orderkey % 30 = 0 THEN 1 ELSE 0 END AS INT) AS deleted,
       'shipment' AS document_type,
       CAST(CASE o_orderkey % 4 WHEN 0 THEN 100 + o_orderkey % 5
                                WHEN 1 THEN 200 + o_orderkey % 25
                                WHEN 2 THEN 1000 + o_custkey % 10
                                ELSE 200 + 5 * (o_custkey % 5) END AS BIGINT) AS department_id,
       CAST(CASE WHEN o_orderkey % 10 = 9 THEN 900000000 + o_custkey ELSE o_custkey END AS BIGINT) AS employee_id
FROM {orders}
UNION ALL
SELECT CAST(10000000 + o_orderkey AS BIGINT), lpad(CAST(o_orderkey AS STRING), 8, '0'),
       CAST(o_orderdate AS DATE), CAST(0 AS INT), CAST(o_totalprice AS DOUBLE),
       CAST(CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS INT),
       CASE WHEN o_orderkey % 7 = 0 THEN 'other' ELSE 'outbill' END,
       CAST(200 + (o_orderkey + 7) % 25 AS BIGINT),
       CAST(CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE o_custkey + 1 END AS BIGINT)
FROM {orders} WHERE o_orderkey % 3 <> 0
UNION ALL
SELECT CAST(20000000 + o_orderkey AS BIGINT), lpad(CAST(o_orderkey AS STRING), 8, '0'),
       CAST(o_orderdate AS DATE), CAST(0 AS INT), CAST(o_totalprice AS DOUBLE), CAST(0 AS INT), 'outbill',
       CAST(200 + (o_orderkey + 9) % 25 AS BIGINT), CAST(o_custkey + 2 AS BIGINT)
FROM {orders} WHERE o_orderkey % 17 = 0
"""

_DOCUMENT_LINES = """
SELECT CAST(l_orderkey AS BIGINT) AS document_id, CAST(l_partkey AS BIGINT) AS nomenclature_code,
       CAST(CASE WHEN l_linenumber = 7 AND l_orderkey % 13 = 0 THEN NULL ELSE l_extendedprice END AS DOUBLE)
           AS nomenclature_price_total
FROM {lineitem}
"""

SOURCE_SQL = {
    "nomenclatures": _NOMENCLATURES,
    "departments": _DEPARTMENTS,
    "documents": _DOCUMENTS,
    "view_departments_with_root_folders": _DEPARTMENT_ROOTS,
    "documents_tabular_part": _DOCUMENT_LINES,
    "employees": _EMPLOYEES,
}


def source_ctes() -> str:
    """The sources as common table expressions for DuckDB, named ``src_<table>``."""
    as_is = {name: name for name in TEST_TABLES}
    return ",\n".join(f"src_{name} AS ({text.format(**as_is).strip()})" for name, text in SOURCE_SQL.items())


def test_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """The sources as DataFrames over the parquet files in ``sf_dir``."""

    def reader(spark: SparkSession, table: str) -> DataFrame:
        text = SOURCE_SQL[table]
        used = [name for name in TEST_TABLES if f"{{{name}}}" in text]
        scans = {name: spark.read.schema(TEST_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet") for name in used}
        return spark.sql(text, **scans)

    return load_sources(spark, reader)


test_sources.__test__ = False  # not a pytest test
