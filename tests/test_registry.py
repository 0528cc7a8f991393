"""Every registered query against DuckDB on the test tables, and known figures of the test data."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from registry.oracles import ORACLES
from registry.queries import QUERIES
from registry.fixtures import END, START, TEST_TABLES, test_sources
from lineledger.operators import sales

TESTDATA = Path("/root/testdata")
pytestmark = pytest.mark.skipif(not TESTDATA.exists(), reason="no test data")
SF = str(TESTDATA / "sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TEST_TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def in_order(rows):
    plain = [tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in row) for row in rows]
    return sorted(plain, key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    result = QUERIES[name](spark, SF)
    columns = sorted(result.columns)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = [tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall()]
    assert in_order(result.select(*columns).collect()) == in_order(expected)


def test_entry(spark):
    assert entry(spark).count() == 430


def test_known_figures(spark):
    src = test_sources(spark, SF)
    counts = {
        "nomenclatures": 390,
        "departments": 40,
        "documents": 2589,
        "employees": 150,
        "document_lines": 6000,
    }
    assert {name: getattr(src, name).count() for name in counts} == counts
    from registry.fixtures import CONFIG

    tags = sales(src.documents, src.department_roots, START, END, CONFIG).groupBy("realization").count()
    assert dict(tags.collect()) == {"changed": 10, "not changed": 77}
    levels = queries()["folder_tree"](spark, SF).groupBy("level").count()
    assert dict(levels.collect()) == {1: 5, 2: 24, 3: 9, 4: 15}
    products = queries()["product_hierarchy"](spark, SF)
    filled = products.select(*[F.count(c) for c in ("root_folder", "folder_1", "folder_2", "folder_3")]).first()
    assert tuple(filled) == (233, 204, 165, 135)


def test_groups_of_the_mart(spark):
    groups = queries()["sales_mart"](spark, SF).groupBy("realization", "root_department").count()
    assert {(r[0], r[1]): r[2] for r in groups.collect()} == {
        ("changed", "Не известен"): 14,
        ("changed", "Офис"): 28,
        ("changed", "Представители"): 11,
        ("not changed", "Не известен"): 65,
        ("not changed", "Офис"): 186,
        ("not changed", "Представители"): 126,
    }
