from __future__ import annotations

import hashlib
import random
import re

import duckdb
import pytest

from lineledger.llm.decontaminate import contamination, fingerprints
from lineledger.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, window=13):
    keys = {}
    for item, text in items:
        w = words_of(text)
        n = min(window, len(w))
        for p in range(len(w) - n + 1 if w else 0):
            keys.setdefault(tuple(w[p : p + n]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words_of(text), set(), set()
        for n in {len(k) for k in keys}:
            for p in range(len(w) - n + 1):
                if (k := tuple(w[p : p + n])) in keys:
                    hit.update(range(p, p + n))
                    found |= keys[k]
        out.append((doc, len(w), len(hit), len(found), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def found_in(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item", "2 AS mark", "3 AS words")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS print")
    return sorted((tuple(r) for r in contamination(d, i, **more).collect()), key=str)


@pytest.mark.parametrize("window, gram", [(13, 8), (5, 3), (4, 4)])
def test_equals_brute_force(spark, window, gram):
    rng = random.Random(window)
    draw = lambda n, k: " ".join(rng.choice(["A", "b", "É", "d-", "e1", "ß"][:k]) for _ in range(n))
    items = [(i, draw(rng.randint(0, 30), rng.choice([1, 2, 6]))) for i in range(25)] + [(None, draw(20, 6)), (3, draw(14, 6)), (4, None)]
    docs = [(100 + i, draw(rng.randint(0, 60), rng.choice([1, 2, 6]))) for i in range(40)]
    for i in range(80):
        w = (rng.choice(items)[1] or "").split()
        a = rng.randint(0, 5)
        docs.append((i, f"{draw(rng.randint(0, 90), 6)} {' '.join(w[a : a + rng.randint(3, 40)])} {draw(rng.randint(0, 30), 6)}"))
    expected = plain(docs, items, window)
    assert found_in(spark, docs, items, window=window, gram=gram) == expected
    assert {r[-1] for r in expected} == {True, False}


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    cursor = con.execute(ORACLES["op4_decontaminate"])
    found = QUERIES["op4_decontaminate"](spark, SF)
    assert found.columns == [d[0] for d in cursor.description] == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    expected = sorted(cursor.fetchall())
    assert sorted(map(tuple, found.collect())) == expected
    docs, items = (con.execute(f"SELECT * FROM {n}").fetchall() for n in ("documents", "benchmark"))
    rows = plain([r[:2] for r in docs], items)
    assert expected == sorted((*r[:4], hashlib.sha256(",".join(r[4]).encode()).hexdigest(), r[5]) for r in rows)
    assert any(r[5] for r in rows)


def test_odd_tables(spark):
    long = " ".join(f"w{i}" for i in range(40))
    docs = [(1, None), (2, ""), (None, long), (None, "short one"), (4, long), (4, long), (4, "other " * 30), (5, "..."), (6, "x short ONE y")]
    items = [(7, long), (7, long), (8, "Short, one"), (9, None), (10, "!!")]
    assert found_in(spark, docs, items) == plain(docs, items)
    assert found_in(spark, [], items) == []
    assert found_in(spark, docs, []) == plain(docs, [])


def test_long_text_and_one_passage_in_a_third_of_all_documents(spark):
    rng = random.Random(4)
    item = " ".join(f"i{k}" for k in range(30))
    filler = lambda n: " ".join(str(rng.randrange(10**6)) for _ in range(n))
    docs = [(1, f"{filler(40000)} {item}"), (2, item + " " + filler(599)), (3, " ".join(["i3"] * 20000))]
    docs += [(10 + k, f"{filler(20)} {item if k % 3 == 0 else filler(30)} {filler(20)}") for k in range(300)]
    items = [(5, item), (6, "i3 " * 40), (7, filler(50))]
    assert found_in(spark, docs, items) == plain(docs, items)


def test_no_python_and_no_loop_in_a_loop(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id", "split(text, ' ') AS words")
    prints = fingerprints(rows, [3]).selectExpr("doc_id", "explode(prints)")
    plan = prints._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and plan.count("xxhash64(8") == 1 and "Python" not in plan and "Arrow" not in plan
