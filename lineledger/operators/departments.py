"""Departments: unbounded subtrees and the department / section / sector table."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineledger.config import MartConfig

_NO_LIMIT = 2**31 - 1  # a cycle is found by the way down, not by the depth


def _descend(seeds: DataFrame, departments: DataFrame) -> DataFrame:
    """``seeds`` and all departments below them; columns beside the department's own go down unchanged.

    Each row carries the ids of its way down, and a department that is met on its own way ends the query with an
    error, so a cycle does not run on and no depth is too deep. ``LIMIT ALL`` lifts the session's row limit for
    recursion.
    """
    own = ["department_id", "department_name", "parent_department_id"]
    inherited = [c for c in seeds.columns if c not in own]
    here = ", ".join(own + inherited)
    below = ", ".join([f"d.{c}" for c in own] + [f"above.{c}" for c in inherited])
    return seeds.sparkSession.sql(
        f"""
        WITH RECURSIVE subtree MAX RECURSION LEVEL {_NO_LIMIT} AS (
            SELECT {here}, array(department_id) AS way FROM {{seeds}}
            UNION ALL
            SELECT {below}, concat(above.way, array(d.department_id))
            FROM subtree above JOIN {{departments}} d ON d.parent_department_id = above.department_id
            WHERE IF(array_contains(above.way, d.department_id),
                     CAST(raise_error('cycle of departments at ' || d.department_id) AS BOOLEAN), true)
        )
        SELECT {here} FROM subtree LIMIT ALL
        """,
        seeds=seeds,
        departments=departments,
    )


def _descend_by_doubling(seeds: DataFrame, departments: DataFrame, stage: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """As :func:`_descend`, in rounds that double the distance, each of them two joins of stored tables.

    ``steps`` tells in how many ways an id is so many levels below another one, and ``reached`` how often an id is below
    a seed. A round adds what lies one such step below all that is reached so far, and then doubles the step. A
    round that adds nothing is the last: what is farther below would have passed through it. Ids that
    repeat multiply rows just as in the recursion. A way that is longer than there are ids has a cycle.
    """
    own = ["department_id", "department_name", "parent_department_id"]
    inherited = [c for c in seeds.columns if c not in own]
    edge = [F.col("department_id").alias("below"), F.col("parent_department_id").alias("above")]
    steps = departments.where("parent_department_id IS NOT NULL").groupBy(*edge).agg(F.count("*").alias("ways"))
    steps = stage(steps, "steps_1")
    reached = [stage(seeds.groupBy("department_id", *inherited).agg(F.count("*").alias("times")), "reached_0")]
    ids, distance = steps.select("below").distinct().count(), 1
    while True:
        so_far = reduce(DataFrame.unionByName, reached)
        new = so_far.join(steps, F.col("department_id") == F.col("above")).groupBy(F.col("below").alias("department_id"), *inherited)
        new = stage(new.agg(F.sum(F.col("ways") * F.col("times")).alias("times")), f"reached_{distance}")
        farther = new.first()
        if farther is None:
            break
        if distance > ids:
            raise ValueError(f"cycle of departments at {farther['department_id']}")
        reached.append(new)
        second = steps.select(F.col("below").alias("between"), F.col("above").alias("top"), F.col("ways").alias("more"))
        twice = steps.join(second, F.col("above") == F.col("between")).groupBy("below", F.col("top").alias("above"))
        distance *= 2
        steps = stage(twice.agg(F.sum(F.col("ways") * F.col("more")).alias("ways")), f"steps_{distance}")
    total = reduce(DataFrame.unionByName, reached).withColumnRenamed("department_id", "above")
    below = departments.join(total, F.col("parent_department_id") == F.col("above"))
    below = below.withColumn("once", F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int"))))
    return seeds.unionByName(below.select(*seeds.columns))


def _below(
    seeds: DataFrame, departments: DataFrame, stage: Callable[[DataFrame, str], DataFrame] | None = None
) -> DataFrame:
    return _descend(seeds, departments) if stage is None else _descend_by_doubling(seeds, departments, stage)


def _roots(departments: DataFrame, parent_ids: Iterable[int] | None, ids: Iterable[int] | None) -> DataFrame:
    if (parent_ids is None) == (ids is None):
        raise ValueError("give either parent_ids or ids")
    if ids is not None:
        chosen = F.col("department_id").isin(list(ids))
    else:
        chosen = F.col("parent_department_id").isin(list(parent_ids))
    return departments.where(chosen).select(
        "department_id",
        "department_name",
        "parent_department_id",
        F.col("department_id").alias("root_id"),
    )


def department_subtree(
    departments: DataFrame,
    *,
    parent_ids: Iterable[int] | None = None,
    ids: Iterable[int] | None = None,
    stage: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Departments at and below the roots, with the id of the root they were reached from.

    Roots are the children of ``parent_ids`` or the departments ``ids`` themselves. Without ``stage`` this is one lazy
    recursive query, a job per level. With ``stage``, which stores a frame under a name, it takes a few jobs for each
    doubling of the depth.
    """
    return _below(_roots(departments, parent_ids, ids), departments, stage)


def department_hierarchy(
    departments: DataFrame, config: MartConfig = MartConfig(), stage: Callable[[DataFrame, str], DataFrame] | None = None
) -> DataFrame:
    """Sector, section and department of every department that one of the three id lists reaches.

    The names of section and department are fixed by the root, so they are joined to the few roots and handed
    down. That leaves one recursion for both sets of roots and one distinct at the end. A department that is
    reached from several roots has several rows. ``stage`` is as in :func:`department_subtree`.
    """
    names = departments.select(
        F.col("department_id").alias("root_id"),
        F.col("department_name").alias("section"),
        F.col("parent_department_id").alias("top_id"),
    )
    tops = departments.select(
        F.col("department_id").alias("top_id"), F.col("department_name").alias("department")
    )
    two_level = (
        _roots(departments, config.section_parent_ids, None)
        .join(names, "root_id")
        .join(tops, "top_id")
        .withColumn("branch", F.lit("below a department"))
    )
    one_level = (
        _roots(departments, None, config.section_ids)
        .join(names, "root_id")
        .withColumn("department", F.col("section"))
        .withColumn("branch", F.lit("own section"))
    )
    wanted = [
        F.col("department_id"),
        F.col("department_name").alias("sector"),
        F.col("root_id").alias("original_parent_id"),
        F.col("section"),
        F.col("department"),
    ]
    reached = (
        _below(two_level.drop("top_id").unionByName(one_level.drop("top_id")), departments, stage)
        .select("branch", *wanted)
        .distinct()  # within each set of roots; the same row from both sets stays twice
        .drop("branch")
    )
    name = F.col("department_name")
    flat = departments.where(F.col("department_id").isin(list(config.flat_ids))).select(
        "department_id",
        name.alias("sector"),
        F.col("department_id").alias("original_parent_id"),
        name.alias("section"),
        name.alias("department"),
    )
    return reached.unionByName(flat)
