"""What several operators need: staged frames, documents as Arrow batches, connected components."""

from __future__ import annotations

import math
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineledger.scratch import delete_folder, new_folder
from lineledger.session import settings


ROWS_AT_ONCE = 2048  # of an Arrow batch that a function gets, so that what it makes of them stays small
TASK_BYTES = 128 * 1024**2  # of stored input for each partition of a shuffle, as many as a scan's task has
_NO_STATISTICS = 2**60  # tables without statistics report a size of this order
_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

_folders: ContextVar[list[str] | None] = ContextVar("folders", default=None)


@contextmanager
def stored_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that operators stored inside it, at its end.

    Results read from these tables, so they have to be written or collected inside, too.
    """
    folders: list[str] = []
    before = _folders.set(folders)
    try:
        yield
    finally:
        _folders.reset(before)
        for folder in folders:
            delete_folder(spark, folder)


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of the tables that ``df`` reads, each as often as it is read; those of unknown size count nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))
    return sum(size for size in sizes if size < _NO_STATISTICS)


class Staged:
    """Writes frames to the folder that all executors share and reads them back.

    A staged frame is computed once, survives lost executors, and gives the planner its true size. The folder is
    kept, since lazy results read from it; it lies in the session's checkpoint folder and goes with that, or with
    :func:`stored_tables`. Shuffles start with a partition for every :data:`TASK_BYTES` that the frame reads, and never
    with fewer than the session's own; small ones are merged at run time.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.folder = new_folder(spark, purpose)
        if (folders := _folders.get()) is not None:
            folders.append(self.folder)

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
        least = int(self.spark.conf.get(_INITIAL_PARTITIONS, None) or self.spark.conf.get("spark.sql.shuffle.partitions"))
        own = {
            batch: str(min(ROWS_AT_ONCE, int(self.spark.conf.get(batch)))),
            _INITIAL_PARTITIONS: str(max(least, math.ceil(scanned_bytes(df) / TASK_BYTES))),
        }
        with settings(self.spark, own):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        delete_folder(self.spark, f"{self.folder}/{name}")


_archives: dict[str, tempfile.TemporaryDirectory] = {}  # by application; each goes when the process ends


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, so that they need not have it installed."""
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if context.applicationId in _archives or not package.is_dir():
        return
    folder = _archives[context.applicationId] = tempfile.TemporaryDirectory(ignore_cleanup_errors=True)
    archive = f"{folder.name}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted(package.rglob("*.py")):
            packed.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)


def map_batches(
    df: DataFrame, columns: dict[str, str], function: Callable[..., Iterator[dict]], schema: str
) -> DataFrame:
    """Applies ``function(arrays of the columns)`` to slices of Arrow batches; it yields dicts of column name to values.

    ``columns`` maps a column of ``df`` to the type it is cast to, so extra columns never reach Python.
    """
    fields = spark_to_arrow(df.sparkSession, schema)
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                for out in function(*part.columns):
                    arrays = [_as_array(out[f.name], f.type) for f in fields]
                    yield pa.RecordBatch.from_arrays(arrays, schema=fields)

    return df.select(*(F.col(c).cast(t).alias(c) for c, t in columns.items())).mapInArrow(run, schema)


def _as_array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, (pa.Array, pa.ChunkedArray)):
        return values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return pa.array(values, type=kind)


def spark_to_arrow(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def sorted_pair(a: Column, b: Column) -> list[Column]:
    return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]


def connected_components(links: DataFrame, a: str, b: str, staged: Staged) -> DataFrame:
    """``(node, component)`` for each node of ``links``; the component is its smallest node.

    Alternates large-star and small-star steps until every node points at its component's smallest node. All
    steps are joins of staged tables by node, so that adaptive execution can split a node with very many links;
    nothing is gathered on the driver but a count and a checksum. Links of a node with itself keep the node.
    """
    spark = links.sparkSession
    both = links.select(F.col(a).alias("x"), F.col(b).alias("y")).dropna()
    nodes = staged(both.select(F.explode(F.array("x", "y")).alias("node")).distinct(), "nodes")
    pairs = staged(both.where("x <> y").select(*sorted_pair(F.col("x"), F.col("y"))).distinct(), "pairs-0")
    seen, names = None, ["pairs-0"]
    for step in range(1, 1000):
        around = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(around.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), f"least-{step}")
        wide = around.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        wide = staged(wide.distinct(), f"wide-{step}")
        least2 = staged(wide.groupBy("u").agg(F.min("v").alias("m")), f"least2-{step}")
        moved = wide.join(least2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = staged(moved.unionByName(least2.select("u", F.col("m").alias("v"))).distinct(), f"pairs-{step}")
        names += [f"least-{step}", f"wide-{step}", f"least2-{step}"]
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        for name in names:
            staged.drop(name)
        names = [f"pairs-{step}"]
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    root = pairs.select(F.col("u").alias("node"), "v")
    return nodes.join(root, "node", "left").select("node", F.coalesce("v", "node").alias("component"))
