from __future__ import annotations

import random
from itertools import combinations

import duckdb
import xxhash

from lineledger.llm.queries import QUERIES
from lineledger.llm.shared import Staged, connected_components
from lineledger.llm.simhash import ball_chains, ball_pairs, near_duplicates, simhash

SF = "/root/testdata/sf0.001"


def plain_simhash(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {n: root(n) for n in nodes}


def test_fingerprint_equals_plain_one(monkeypatch):
    rng = random.Random(1)
    texts = [None, "", " \t\n", "one", "Two words", "ÄÖ a b", "x" * 5000]
    texts += [" ".join(rng.choice("abcdeÉ") * rng.randint(1, 4) for _ in range(rng.randint(0, 300))) for _ in range(50)]
    for piece in (1 << 20, 7):
        monkeypatch.setattr("lineledger.llm.simhash._PIECE", piece)
        assert [simhash(t) for t in texts] == [plain_simhash(t) for t in texts]


def test_pairs_and_chains(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) - (1 << 63) for _ in range(10)]
    fps = set(base)
    for b in base:
        for _ in range(12):
            flips = rng.sample(range(63), rng.randint(1, 3))
            for f in flips:
                b ^= 1 << f
            fps.add(b)
    frame = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    mask = (1 << 64) - 1
    for radius in (1, 2, 3):
        expected = {(a, b) for a, b in combinations(sorted(fps), 2) if ((a ^ b) & mask).bit_count() <= radius}
        assert {tuple(r) for r in ball_pairs(frame, radius).collect()} == expected
        chains = {tuple(r) for r in ball_chains(frame, radius).collect()}
        assert chains <= expected
        assert plain_components(fps, chains) == plain_components(fps, expected)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 40)] + [(70, 70), (5, 7), (60, 61), (62, 61)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r.node: r.component for r in connected_components(frame, "a", "b", Staged(spark, "t")).collect()}
    assert found == plain_components({n for e in edges for n in e}, edges)


def test_query_equals_brute_force(spark):
    rows = duckdb.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    prints = {i: plain_simhash(t) for i, t in rows}
    linked = [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    parts = plain_components(prints, linked)
    found = QUERIES["op10_simhash"](spark, SF)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, found.collect())) == sorted((i, f"{prints[i]:016x}", parts[i]) for i in prints)


def test_odd_tables(spark):
    rows = [(3, None, "x"), (2, "", "y"), (None, "a b c d", "x"), (7, "a b c d", None), (7, "a b c d", None)]
    odd = spark.createDataFrame(rows, "doc_id int, text string, fingerprint string").selectExpr("*", "1 AS fp", "2 AS component")
    found = sorted(((r.doc_id, r.component_id) for r in near_duplicates(odd).collect()), key=str)
    assert found == [(2, 2), (3, 2), (7, 7), (7, 7), (None, 7)]
    assert near_duplicates(odd.where("false")).collect() == []
