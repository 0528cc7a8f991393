from __future__ import annotations

import random
from collections import Counter

import pytest

from lineledger.operators import child_folders, folder_listing, folder_tree, product_hierarchy, root_folders
from tests.data import LONG_NAME, NOMENCLATURES, bag, frame


@pytest.fixture(scope="module")
def nomenclatures(spark):
    return frame(spark, "nomenclatures", NOMENCLATURES)


def test_levels_and_paths(nomenclatures):
    rows = {r.nomenclature_id: r for r in folder_tree(nomenclatures).collect()}
    assert set(rows) == {1, 2, 3, 4, 7}  # not 5 (level 5), not 6 (deleted)
    assert (rows[1].level, rows[1].parent_id, rows[1].full_path) == (1, None, ["Корень"])
    assert (rows[4].level, rows[4].parent_id) == (4, 3)
    assert rows[4].full_path == ["Корень", LONG_NAME, "Третья", "Четвёртая"]


def test_depth_is_a_parameter(nomenclatures):
    assert {r.nomenclature_id for r in folder_tree(nomenclatures, 1).collect()} == {1}
    assert {r.nomenclature_id for r in folder_tree(nomenclatures, 5).collect()} == {1, 2, 3, 4, 5, 7}
    with pytest.raises(ValueError):
        folder_tree(nomenclatures, 0)


def test_one_step(nomenclatures):
    step = child_folders(nomenclatures, root_folders(nomenclatures))
    assert {(r.nomenclature_id, r.parent_id, r.level) for r in step.collect()} == {(2, 1, 2), (7, 1, 2)}


def test_listing_is_in_path_order(nomenclatures):
    paths = [r.full_path for r in folder_listing(nomenclatures).collect()]
    assert paths == sorted(paths)
    assert len(paths) == 5


def test_product_paths(nomenclatures):
    products = product_hierarchy(nomenclatures, folder_tree(nomenclatures))
    rows = {r.name: r for r in products.collect()}
    assert len(rows) == len(NOMENCLATURES)
    folders = ("root_folder", "folder_1", "folder_2", "folder_3")

    def path(name):
        return [rows[name][f] for f in folders]

    cut = LONG_NAME[:50]
    assert len(LONG_NAME) > 50
    assert path("Товар 1") == ["Корень", None, None, None]
    assert path("Товар 2") == ["Корень", cut, None, None]
    assert path("Товар 3") == ["Корень", cut, "Третья", None]
    assert path("Товар 4") == ["Корень", cut, "Третья", "Четвёртая"]
    # level 5, deleted goods, folders and goods in a deleted folder stay, without a path
    for name in ("Товар 5", "Удалённый товар", "Папка с кодом", "Третья", "В удалённой папке", None):
        assert path(name) == [None] * 4


RECURSIVE = """
WITH RECURSIVE tree (id, name, parent, depth, path) AS (
    SELECT nomenclature_id, name, CAST(NULL AS BIGINT), 1, array(name)
    FROM {n} WHERE isFolder = 1 AND deleted = 0 AND root_folder_id = 0
    UNION ALL
    SELECT n.nomenclature_id, n.name, tree.id, tree.depth + 1, array_append(tree.path, n.name)
    FROM tree JOIN {n} n ON n.folder = tree.id
    WHERE n.isFolder = 1 AND n.deleted = 0 AND tree.depth < 4
)
SELECT * FROM tree
"""


def brute_force(rows, depth):
    """All chains from a root folder down, as a bag; ids may repeat and a root may lie in a folder."""
    live = [r for r in rows if r[5] == 1 and r[6] == 0]
    level = [(r[0], r[2], None, 1, (r[2],)) for r in live if r[3] == 0]
    out = Counter(level)
    for _ in range(depth - 1):
        level = [(c[0], c[2], p[0], p[3] + 1, p[4] + (c[2],)) for p in level for c in live if c[4] == p[0]]
        out.update(level)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_tree_on_random_graphs(spark, seed):
    rng = random.Random(seed)
    rows = [
        (
            rng.randrange(25),
            None,
            rng.choice([None, f"папка {i}"]),
            rng.choice([0, 1, 1, None]),
            rng.choice([None, *range(25)]),
            rng.choice([1, 1, 1, None, 0]),
            rng.choice([0, 0, 0, 1]),
        )
        for i in range(60)
    ]
    nomenclatures = frame(spark, "nomenclatures", rows)
    tree = folder_tree(nomenclatures)
    assert bag(tree) == brute_force(rows, 4)
    assert bag(tree) == bag(spark.sql(RECURSIVE, n=nomenclatures))
