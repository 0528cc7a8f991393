"""Product folders: the bounded folder tree and the path of every product."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineledger.config import FOLDER_DEPTH, FOLDER_NAME_LENGTH
from lineledger.functions import path_append, path_entry, path_start


def live_folders(nomenclatures: DataFrame) -> DataFrame:
    """Folders that are not deleted."""
    return nomenclatures.where((F.col("isFolder") == 1) & (F.col("deleted") == 0))


def root_folders(nomenclatures: DataFrame) -> DataFrame:
    """First level of the folder tree: live folders marked with root folder 0."""
    return live_folders(nomenclatures).where(F.col("root_folder_id") == 0).select(
        "nomenclature_id",
        F.col("name").alias("folder_name"),
        F.lit(None).cast("bigint").alias("parent_id"),
        F.lit(1).alias("level"),
        path_start(F.col("name")).alias("full_path"),
    )


def child_folders(nomenclatures: DataFrame, parents: DataFrame) -> DataFrame:
    """Live folders directly below ``parents`` (rows of a folder tree), one level deeper."""
    above = parents.select(
        F.col("nomenclature_id").alias("parent_id"),
        F.col("level").alias("parent_level"),
        F.col("full_path").alias("parent_path"),
    )
    below = live_folders(nomenclatures).select("nomenclature_id", "name", "folder")
    return below.join(above, F.col("folder") == F.col("parent_id")).select(
        "nomenclature_id",
        F.col("name").alias("folder_name"),
        "parent_id",
        (F.col("parent_level") + 1).alias("level"),
        path_append(F.col("parent_path"), F.col("name")).alias("full_path"),
    )


def folder_tree(
    nomenclatures: DataFrame, max_depth: int = FOLDER_DEPTH, stage: Callable[[DataFrame, str], DataFrame] | None = None
) -> DataFrame:
    """Folders down to ``max_depth`` with the names on the way from their root.

    The depth is bounded, so the tree is one plan of ``max_depth - 1`` equi-joins instead of a recursion that
    runs level by level. In one plan a level is worked out for the result and again for the level below it, unless
    the joins can share their exchanges. A load gives ``stage``, which stores a frame under a name: then the live
    folders are read once and each level is joined once. Only levels with a level below are stored; the first is a
    filter and the last is used once.
    """
    if max_depth < 1:
        raise ValueError("max_depth must be at least 1")
    store = stage or (lambda df, name: df)
    folders = live_folders(nomenclatures)
    folders = store(folders, "folders") if stage else folders
    levels = [root_folders(folders)]
    while len(levels) < max_depth:
        level = child_folders(folders, levels[-1])
        levels.append(store(level, f"level_{len(levels) + 1}") if len(levels) + 1 < max_depth else level)
    return reduce(DataFrame.unionByName, levels)


def folder_listing(nomenclatures: DataFrame, max_depth: int = FOLDER_DEPTH) -> DataFrame:
    """The folder tree in path order."""
    return folder_tree(nomenclatures, max_depth).orderBy("full_path", "nomenclature_id")


def product_hierarchy(
    nomenclatures: DataFrame,
    tree: DataFrame,
    name_length: int = FOLDER_NAME_LENGTH,
) -> DataFrame:
    """Code, name and up to four folder names of every row of the catalogue.

    Only live goods get a path, yet folders and deleted goods stay in the result with an empty one: the two
    conditions belong to the outer join, a filter would drop rows whose code appears in a document.
    """
    paths = tree.select(F.col("nomenclature_id").alias("path_id"), "full_path")
    path_of_live_good = (
        (F.col("folder") == F.col("path_id")) & F.col("isFolder").isNull() & (F.col("deleted") == 0)
    )
    path = F.col("full_path")
    return nomenclatures.join(paths, path_of_live_good, "left").select(
        "nomenclature_code",
        "name",
        path_entry(path, 3, name_length).alias("folder_3"),
        path_entry(path, 2, name_length).alias("folder_2"),
        path_entry(path, 1, name_length).alias("folder_1"),
        path_entry(path, 0, name_length).alias("root_folder"),
    )
