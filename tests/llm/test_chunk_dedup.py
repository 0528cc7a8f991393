from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lineledger.llm import chunk_dedup, copies
from lineledger.llm.chunk_dedup import GEAR, cuts, dedup_substrings, gear_hash
from lineledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(n))


def plain_hash(data):
    h, out = 0, []
    for byte in data:
        h = ((h << 2) + int(GEAR[byte])) & 0xFFFFFFFF
        out.append(h)
    return out


def plain_dedup(docs):
    """Chunk pairs with the smallest id that has them; bytes of pairs with a smaller id go."""
    pairs = {}
    for i, text in docs:
        border = cuts(text.encode()).tolist()
        step = min(2, len(border) - 1)
        if step:
            pairs[i] = [(a, b, text.encode()[a:b]) for a, b in zip(border, border[step:])]
    first = {}
    for i, found in pairs.items():
        for _, _, key in found:
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, text in docs:
        gone = np.zeros(len(text.encode()), bool)
        for a, b, key in pairs.get(i, []):
            if first[key] < i:
                gone[a:b] = True
        edges = np.flatnonzero(np.diff(np.r_[0, gone.astype(int), 0]))
        for a, b in zip(edges[::2], edges[1::2]):
            run = text.encode()[a:b]
            if b - a < len(gone) and len(run.split()) < 20 and len(run.decode()) < 160:
                gone[a:b] = False
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out[i] = (bytes(np.frombuffer(text.encode(), np.uint8)[~gone]).decode(), int(gone.sum()), runs)
    return out


def test_hash_and_blocks(monkeypatch):
    text = (words(random.Random(1), 400) + " " + "x" * 300 + "日本語の文章" * 80).encode()
    assert gear_hash(np.frombuffer(text, np.uint8)).tolist() == plain_hash(text)
    whole = cuts(text)
    assert whole[0] == 0 and whole[-1] == len(text) and (np.diff(whole) > 0).all()
    assert all(text[:c].decode() is not None for c in whole)
    monkeypatch.setattr(chunk_dedup, "_BLOCK", 97)
    assert cuts(text).tolist() == whole.tolist()


def test_insertions_move_near_borders_only():
    text = words(random.Random(2), 500)
    moved = "some more words " + text
    old, new = set(cuts(text.encode())), {c - 16 for c in cuts(moved.encode())}
    assert len(old - new) <= 3


def test_pack_round_trip():
    rng = np.random.default_rng(3)
    n = 1000
    e = copies.entries(
        rng.integers(-5, 5, 20), rng.integers(-(2**62), 2**62, 20), rng.integers(0, 20, n).astype(np.uint32),
        np.sort(rng.integers(0, 2**63, n).astype(np.uint64)), rng.integers(0, 2**32, n).astype(np.uint32),
        rng.integers(0, 2**31, n).astype(np.uint32), rng.integers(0, 99, n).astype(np.uint32),
    )
    back = copies.unpack(copies.pack(e))
    for name in ("k1", "k2", "start", "size", "kind"):
        assert (getattr(back, name) == getattr(e, name)).all()
    assert (back.ids[back.doc] == e.ids[e.doc]).all() and (back.hashes[back.doc] == e.hashes[e.doc]).all()


def test_long_passages_go_and_clean_documents_stay(spark):
    rng = random.Random(4)
    passages = [words(rng, 55) for _ in range(40)]
    docs = [(i, f"{words(rng, rng.randint(20, 200))} {passages[i % 40]} {words(rng, rng.randint(0, 200))}") for i in range(160)]
    docs += [(1000 + i, words(rng, 300)) for i in range(50)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: r for r in dedup_substrings(frame, F.col("doc_id")).collect()}
    assert all(found[i].n_removed == 0 for i in [*range(40), *range(1000, 1050)])
    assert all(found[i].n_removed > 100 for i in range(40, 160))
    assert all(passages[i % 40] not in found[i].kept for i in range(40, 160))


def test_repeated_words_and_phrases(spark):
    rng = random.Random(6)
    drone, phrase = "and " * 60, words(rng, 14)
    docs = [(i, f"{words(rng, 30)} {phrase} {words(rng, 30)} {drone}{words(rng, 30)}") for i in range(4)]
    docs += [(9, "日本語の長い文章をここに書きます" * 20), (10, "前置き" + "日本語の長い文章をここに書きます" * 20)]
    found = {r.doc_id: r for r in dedup_substrings(spark.createDataFrame(docs, "doc_id long, text string"), F.col("doc_id")).collect()}
    assert found[0].n_removed == found[9].n_removed == 0 and found[10].n_removed > 400
    assert all(phrase in found[i].kept and found[i].n_removed > 100 and found[i].n_spans == 1 for i in (1, 2, 3))


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = {r.doc_id: (r.n_removed, r.n_spans) for r in QUERIES["op3_substring_dedup"](spark, SF).collect()}
    expected = plain_dedup(docs)
    assert found == {i: v[1:] for i, v in expected.items()}
    assert sum(v[1] for v in expected.values()) > 0


def test_odd_tables(spark):
    rng = random.Random(5)
    a, b = words(rng, 60), words(rng, 60)
    rows = [(5, a, "k"), (5, a, "l"), (5, b, "m"), (3, b, None), (None, a, "n"), (None, b, "o"), (1, None, "p"), (2, "", "q"), (8, "x y", "r"), (9, "x y", "r")]
    odd = spark.createDataFrame(rows, "doc_id int, text string, kept string").selectExpr("*", "1 AS id", "2 AS starts", "3 AS text_hash")
    found = dedup_substrings(odd, F.col("doc_id"), F.col("kept").alias("mark")).collect()
    kept = sorted((str(r.doc_id), str(r.mark), r.kept) for r in found)
    expected = [("5", "k", a), ("5", "l", a), ("5", "m", ""), ("3", "None", b), ("None", "n", ""), ("None", "o", "")]
    expected += [("1", "p", ""), ("2", "q", ""), ("8", "r", "x y"), ("9", "r", "")]
    assert kept == sorted(expected)
    assert dedup_substrings(odd.where("false"), F.col("doc_id")).collect() == []


@pytest.mark.parametrize("spans, expected", [([(5, 9), (0, 3), (3, 4), (6, 7), (20, 30)], [(0, 4), (5, 9), (20, 30)])])
def test_union(spans, expected):
    starts, stops = copies.union_of(*(np.array(x) for x in zip(*spans, strict=True)))
    assert list(zip(starts.tolist(), stops.tolist(), strict=True)) == expected
