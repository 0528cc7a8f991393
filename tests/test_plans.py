"""What the plans of the mart have to look like for large inputs."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from lineledger.functions import month_window
from lineledger.operators import blocks_for, bloom_filter, folder_tree, maybe_in, sales_not_changed, shipped_documents
from lineledger.plans import lines_of, mart_rows, sales_mart
from lineledger.scratch import new_folder, staging
from lineledger.session import input_bytes, known_bytes, partitions_for, settings, sized_shuffles
from lineledger.sources import load_sources, parquet_reader
from registry.queries import QUERIES
from tests.data import END, START, bag, edge_sources
from tests.plans import executed, planned


@pytest.fixture(scope="module")
def stored(spark):
    """The edge cases as parquet tables, with shipment times as timestamps."""
    folder, src = new_folder(spark, "sources"), edge_sources(spark)
    frames = {
        "nomenclatures": src.nomenclatures,
        "departments": src.departments,
        "documents": src.documents.withColumn("sbis_shipment_date", F.col("sbis_shipment_date").cast("timestamp")),
        "view_departments_with_root_folders": src.department_roots,
        "documents_tabular_part": src.document_lines.withColumn("comment", F.lit("not needed")),
        "employees": src.employees,
    }
    for name, df in frames.items():
        df.write.parquet(f"{folder}/{name}")
    return load_sources(spark, parquet_reader(folder))


def scan(plan, column):
    """The scan of the table that has ``column``."""
    return next(line for line in plan.splitlines() if "FileScan parquet" in line and column in line)


def test_stored_sources_give_the_same_mart(spark, stored):
    assert bag(sales_mart(stored, START, END)) == bag(sales_mart(edge_sources(spark), START, END))


def test_no_python_and_no_nested_loops(stored):
    plan = executed(sales_mart(stored, START, END))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "CollectLimit"):
        assert operator not in plan


def test_no_loops_without_broadcasts_either(spark, stored):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        mart = sales_mart(stored, START, END)
        plan = executed(mart)
        assert bag(mart) == bag(sales_mart(stored, START, END))
    assert "BroadcastHashJoin" not in plan
    assert "CartesianProduct" not in plan
    # partner roots, invoices, departments, employees, lines, catalogue and, inside it, paths and levels
    assert plan.count("SortMergeJoin") >= 6


def test_filters_reach_the_documents(stored):
    plan = planned(sales_not_changed(stored.documents, START, END))
    pushed = re.search(r"PushedFilters: \[.*?\], ReadSchema", plan).group()
    for condition in (
        "GreaterThanOrEqual(sbis_shipment_date,2025-01-01",
        "LessThan(sbis_shipment_date,2025-08-01",
        "EqualTo(shipment,1)",
        "EqualTo(deleted,0)",
        "GreaterThan(invoice_total_sum_calculated,0.0)",
    ):
        assert condition in pushed
    assert "document_type" not in plan.split("ReadSchema")[1]


def test_only_needed_columns_of_the_lines(stored):
    assert "comment" not in scan(planned(mart_rows(stored, "2025-03-15", "2025-03-16")), "nomenclature_price_total")


def test_ids_of_stored_documents_bound_the_lines(stored):
    shipped = shipped_documents(stored.documents, "2025-03-15", "2025-03-16")
    lines = scan(planned(lines_of(stored.document_lines, shipped)), "nomenclature_price_total")
    assert "GreaterThanOrEqual(document_id,1)" in lines and "LessThanOrEqual(document_id,1)" in lines


def shuffled_bytes(df):
    """What the exchanges of an executed plan wrote."""
    df.write.format("noop").mode("overwrite").save()
    plan, waiting, total = df._jdf.queryExecution().executedPlan(), [], 0
    df.collect()
    waiting.append(plan)
    while waiting:
        node = waiting.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            waiting.append(node.plan())
        else:
            if name == "ShuffleExchangeExec":
                total += node.metrics().apply("shuffleBytesWritten").value()
            children = node.children()
            waiting += [children.apply(k) for k in range(children.size())]
    return total


def test_a_bloom_filter_drops_lines_where_they_are_read(spark):
    """Documents with ids in no order of time: bounds drop nothing, the filter nearly all that does not match."""
    folder = new_folder(spark, "lines")
    lines = spark.range(200_000).select(
        (F.xxhash64("id") % 5000).alias("document_id"), F.col("id").alias("nomenclature_code"), F.lit(1.0).alias("nomenclature_price_total")
    )
    lines.write.parquet(f"{folder}/lines")
    few = spark.range(5000).select((F.xxhash64("id") % 5000).alias("document_id")).distinct().where("abs(document_id) % 25 = 3")
    few.write.parquet(f"{folder}/documents")
    lines, documents = (spark.read.parquet(f"{folder}/{name}") for name in ("lines", "documents"))
    with staging(spark) as stage, settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plain, reduced = lines_of(lines, documents), lines_of(lines, documents, stage)
        plan = planned(reduced)
        assert "BroadcastHashJoin" in plan and "LeftSemi" in plan and "Exchange hashpartitioning" not in plan
        joined = [of.join(documents, "document_id") for of in (plain, reduced)]
        assert bag(joined[0]) == bag(joined[1]) != {}
        assert plain.count() > 190_000 and reduced.count() < 1.1 * joined[0].count()
        assert shuffled_bytes(joined[1]) < shuffled_bytes(joined[0]) / 8


def test_a_large_bloom_filter_is_not_sent(spark, stored, monkeypatch):
    monkeypatch.setattr("lineledger.plans.mart.BLOOM_BYTES", 10)
    with staging(spark) as stage:
        lines = lines_of(stored.document_lines, shipped_documents(stored.documents, START, END), stage)
        assert "Join" not in planned(lines)


@pytest.mark.parametrize("ids", [0, 1, 7, 3000])
def test_a_bloom_filter_forgets_no_id(spark, ids):
    values = spark.range(ids).select(F.xxhash64("id").alias("id"))
    blocks = blocks_for(ids)
    bloom = bloom_filter(values.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS id")), blocks)
    assert bag(maybe_in(values, "id", bloom, blocks)) == bag(values)
    others = spark.range(10**6, 10**6 + 20_000).select(F.xxhash64("id").alias("id"))
    assert maybe_in(others, "id", bloom, blocks).count() < 20_000 / 40
    assert maybe_in(spark.sql("SELECT CAST(NULL AS BIGINT) AS id"), "id", bloom, blocks).count() == 0


def test_a_load_joins_each_folder_level_once(spark, stored):
    with staging(spark) as stage:
        joins = []
        counted = lambda df, name: joins.append(planned(df).count("Join")) or stage(df, name)
        tree = folder_tree(stored.nomenclatures, 4, counted)
        assert joins == [0, 1, 1] and planned(tree).count("Join") == 1
        assert bag(tree.select("nomenclature_id", "level")) == bag(folder_tree(stored.nomenclatures, 4).select("nomenclature_id", "level"))


def test_month_is_a_window(spark):
    assert month_window(202512) == (dt.date(2025, 12, 1), dt.date(2026, 1, 1))
    plan = planned(QUERIES["sales_mart_month"](spark, "/root/testdata/sf0.001"))
    assert "1997-03-01" in plan and "1997-04-01" in plan and "1997-08-01" not in plan


def test_folder_path_is_not_sorted_in_the_mart(stored):
    assert "rangepartitioning" not in planned(sales_mart(stored, START, END))


def test_small_dimensions_are_broadcast_by_their_real_size(stored):
    # the planner cannot know the sizes of the hierarchies; the running plan does
    mart = sales_mart(stored, START, END)
    assert "SortMergeJoin" in planned(mart)
    assert "SortMergeJoin" not in executed(mart)


def test_shuffles_grow_with_the_input(spark, stored):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert input_bytes(shipped_documents(stored.documents, START, END)) > 0
    assert partitions_for(100 * 1024**3) == 400
    assert partitions_for(100 * 1024**4) == 400 * 1024  # no cap
    before = spark.conf.get(key, None)
    with sized_shuffles(spark, 1000):
        assert spark.conf.get(key) == "8"  # never below the session's own number
    with sized_shuffles(spark, 100 * 1024**4):
        assert spark.conf.get(key) == str(400 * 1024)
    assert spark.conf.get(key, None) == before


def test_size_has_to_be_known_or_given(spark, stored):
    unknown = spark.sql("SELECT document_id FROM {d}", d=stored.documents).rdd.toDF()
    assert input_bytes(unknown) is None
    with pytest.raises(ValueError, match="size in bytes"):
        known_bytes(None, stored.documents, unknown)
    assert known_bytes(10**15, unknown) == 10**15
    assert known_bytes(None, stored.documents, stored.employees) == max(map(input_bytes, (stored.documents, stored.employees)))


def test_overlapping_settings_end_at_the_callers(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    first, second, third = (settings(spark, {key: value, "spark.sql.cbo.enabled": "true"}) for value in ("11", "12", "11"))
    unset = spark.conf.get("spark.sql.cbo.enabled")
    first.__enter__(), second.__enter__(), third.__enter__()
    assert spark.conf.get(key) == "11"
    first.__exit__(None, None, None)  # the one that began first ends first
    assert spark.conf.get(key) == "11"
    third.__exit__(None, None, None)
    assert spark.conf.get(key) == "12"
    second.__exit__(None, None, None)
    assert spark.conf.get(key) == before and spark.conf.get("spark.sql.cbo.enabled") == unset
