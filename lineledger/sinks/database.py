"""Appending the mart to a table of an external database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lineledger.schemas import MART_COLUMNS


def _count(spark: SparkSession, table: str, url: str, properties: Mapping[str, str]) -> int:
    counted = spark.read.jdbc(url, f"(SELECT COUNT(*) AS n FROM {table}) counted", properties=dict(properties))
    return int(counted.first()[0])


def append_database(
    df: DataFrame,
    table: str,
    *,
    url: str,
    properties: Mapping[str, str] | None = None,
    connections: int = 8,
    batch_size: int = 10_000,
    verify: bool = True,
) -> None:
    """Inserts the mart's 14 columns over ``connections`` parallel connections.

    Each task commits on its own. A task that is repeated after the loss of its executor may insert its rows
    again, and a database table has no commit for the whole job. ``verify`` therefore compares the growth of
    the table with the rows sent and raises if they differ; use it when nobody else writes to the table.
    """
    properties = dict(properties or {})
    spark = df.sparkSession
    before = _count(spark, table, url, properties) if verify else 0
    sent = Observation()
    # Repartition, not coalesce: the work above the write keeps its own parallelism.
    rows = df.select(*MART_COLUMNS).repartition(connections).observe(sent, F.count(F.lit(1)).alias("rows"))
    rows.write.jdbc(url, table, mode="append", properties={"batchsize": str(batch_size), **properties})
    if verify:
        grown = _count(spark, table, url, properties) - before
        if grown != sent.get["rows"]:
            raise RuntimeError(f"{table} grew by {grown} rows, {sent.get['rows']} were sent")
