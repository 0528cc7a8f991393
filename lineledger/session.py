"""Session settings that a load needs while it runs."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from contextlib import AbstractContextManager, contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

PARTITION_BYTES = 256 * 1024**2
SKEW_FACTOR = "2"  # times the median partition from which a join partition is split
_NO_STATISTICS = 2**60  # sources without statistics report a size of this order, whatever they hold
_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

_lock = Lock()
_held: dict[tuple[int, str], list] = {}  # by session and key: the caller's value, then those of running loads


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Sets ``values`` and puts back what was there before.

    Several of these may overlap in any order: the last one that still runs decides, and when none runs any more,
    the caller's values are back.
    """
    own = {key: [value] for key, value in values.items()}  # lists, so that equal values are told apart
    session = spark._jsparkSession.hashCode()  # two Python objects may stand for one session
    with _lock:
        for key, value in own.items():
            _held.setdefault((session, key), [spark.conf.get(key, None)]).append(value)
            spark.conf.set(key, value[0])
    try:
        yield
    finally:
        with _lock:
            for key, value in own.items():
                held = _held[session, key]
                held[1:] = [other for other in held[1:] if other is not value]
                now = held[0] if len(held) == 1 else held[-1][0]
                if len(held) == 1:
                    del _held[session, key]
                if now is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, now)


def input_bytes(df: DataFrame) -> int | None:
    """The planner's estimate of the size of ``df``, from file sizes; None where there is none."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < _NO_STATISTICS else None


def known_bytes(given: int | None, *inputs: DataFrame) -> int:
    """``given``, or the size of the largest input; an input of unknown size has to be given."""
    if given is not None:
        return given
    sizes = [input_bytes(df) for df in inputs]
    if None in sizes:
        raise ValueError("an input has no size that the planner knows, as with a database: pass its size in bytes")
    return max(sizes)


def partitions_for(size: int) -> int:
    return math.ceil(size / PARTITION_BYTES)


def sized_shuffles(spark: SparkSession, size: int) -> AbstractContextManager[None]:
    """Shuffles start with enough partitions for an input of ``size`` bytes; joins adapt to what they find in them.

    The session's own number of partitions is the least that is used; small ones are merged at run time. A join
    partition is split if it is larger than :data:`PARTITION_BYTES` and than twice the median, so that one document
    or product with a large share of the lines does not keep a single task busy. Rows that are rebalanced for a
    write make files from as many bytes. Where every partition of one side of a join stays below the session's own
    advisory size, the other side is not sorted but looked up in a hash table; else the join is a sort-merge join,
    which can spill.
    """
    least = int(spark.conf.get(_INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    return settings(
        spark,
        {
            "spark.sql.adaptive.enabled": "true",
            "spark.sql.adaptive.skewJoin.enabled": "true",
            _INITIAL_PARTITIONS: str(max(least, partitions_for(size))),
            "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": spark.conf.get(_ADVISORY),
            _ADVISORY: str(PARTITION_BYTES),
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(PARTITION_BYTES),
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": SKEW_FACTOR,
        },
    )
