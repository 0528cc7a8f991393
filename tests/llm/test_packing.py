from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lineledger.llm.packing import Slots, best_fit, bins, cut, nnls, pack, place, plan, sequences
from lineledger.llm.queries import QUERIES
from lineledger.llm.shared import Staged
from lineledger.llm.tokens import Encoder

SF = "/root/testdata/sf0.001"
FILE = public_tokenizers.path("byte_bpe_50k.json")
SPEC = Path(FILE).read_text(encoding="utf-8")
TOKENIZER = Tokenizer.from_file(FILE)


def test_ids_are_those_of_the_tokenizers_library():
    encode = Encoder(SPEC)
    assert encode.fast
    rng = random.Random(1)
    signs = [chr(c) for c in range(0x260) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b {c}{c} c{c}1 {c} '{c}s\n{c}" for c in signs]
    texts += ["".join(rng.choice(signs) for _ in range(200)) for _ in range(300)]
    texts += ["", "<|endoftext|> x", "日本語 ꙮ 🙂 ", "x" * 30000, " " * 5000, "It's we'LL  \t\n end "]
    texts += ["".join(chr(rng.choice([rng.randrange(0x20, 0xD7FF), rng.randrange(0xE000, 0x1FFFF)])) for _ in range(50)) for _ in range(200)]
    for text in texts:
        assert encode(text).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids, repr(text[:50])


def test_cut():
    assert cut(1, 4) == [(0, 1)]
    assert cut(4, 4) == [(0, 4)]
    assert cut(9, 4) == [(0, 1), (1, 4), (5, 4)]
    assert cut(8, 4) == [(0, 4), (4, 4)]


def test_least_squares():
    patterns = [(1, 3), (2, 2), (1, 1, 2)]
    histogram = np.array([0, 9, 7, 5.0])
    x = nnls(patterns, histogram)
    assert np.allclose(x, [5, 2.5, 2], atol=1e-3)


def plain_best_fit(lengths, size):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        room = min(fits, default=size)
        if fits:
            rooms.remove(room)
        rooms.append(room - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(12))
def test_plans_use_every_piece_and_few_sequences(seed):
    rng = random.Random(seed)
    size = rng.choice([10, 64, 1024])
    kind = seed % 4
    draw = {0: lambda: rng.randint(1, size), 1: lambda: min(size, 1 + int(rng.expovariate(8 / size))),
            2: lambda: rng.choice([size // 3 + 1, size // 2, size]), 3: lambda: rng.randint(size // 2, size)}[kind]
    lengths = [draw() for _ in range(rng.choice([3, 300, 20000]))]
    histogram = np.bincount(lengths, minlength=size + 1)
    for blocks in (plan(histogram, size), best_fit(histogram, size)):
        used = Counter()
        for pattern, repeats in blocks:
            assert 0 < sum(pattern) <= size and repeats > 0
            for length in pattern:
                used[length] += repeats
        assert used == Counter(lengths)
    best = plain_best_fit(lengths, size) if len(lengths) < 1000 else sum(n for _, n in best_fit(histogram, size))
    assert sum(n for _, n in plan(histogram, size)) <= 1.01 * best + 1


def test_best_fit_equals_piece_by_piece():
    rng = random.Random(3)
    for _ in range(50):
        lengths = [rng.randint(1, 30) for _ in range(rng.randint(0, 200))]
        blocks = best_fit(np.bincount(lengths, minlength=31), 30)
        assert sum(n for _, n in blocks) == plain_best_fit(lengths, 30)


def test_slots_are_gapless(spark):
    blocks = [((3, 5, 3), 4), ((5,), 2), ((3, 7), 1)]
    slots = {r.length: r for r in Slots.of(blocks).table(spark).collect()}
    counts = {3: 9, 5: 6, 7: 1}
    found = defaultdict(list)
    for length, n in counts.items():
        own = slots[length]
        for rank in range(n):
            k = sum(s <= rank for s in own.starts) - 1
            found[own.sequences[k] + rank - own.starts[k]].append((own.offsets[k], length))
    assert sorted(tuple(n for _, n in sorted(v)) for v in found.values()) == sorted([(3, 5, 3)] * 4 + [(5,)] * 2 + [(3, 7)])
    for v in found.values():
        assert [o for o, _ in sorted(v)] == np.cumsum([0, *(n for _, n in sorted(v))])[:-1].tolist()


def check(rows, docs, size):
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for v in by_sequence.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= size
    for doc_id, text in docs.items():
        ids = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]
        own = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [(r.start, r.length) for r in own] == cut(len(ids), size) and [r.piece for r in own] == list(range(len(own)))
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    lengths = [r.length for r in rows]
    assert len(by_sequence) <= 1.01 * plain_best_fit(lengths, size) + 1


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = QUERIES["op6_packing"](spark, SF)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check(found.collect(), docs, 1024)


def test_odd_tables_and_round_trip(spark):
    rows = [(1, None, "a"), (2, "", "b"), (None, "one two", "c"), (4, "w " * 5000, "d"), (5, "x y z", "e"), (5, "x y z", "f")]
    odd = spark.createDataFrame(rows, "doc_id int, text string, ids string").selectExpr("*", "1 AS length", "2 AS offset", "3 AS rank")
    packed = pack(odd, SPEC, size=64)
    found = sorted(len(r.ids) for r in sequences(packed).collect())
    lengths = [n for _, t, _ in rows for _, n in cut(len(TOKENIZER.encode(t or "", add_special_tokens=False).ids) + 1, 64)]
    assert sum(found) == sum(lengths) and max(found) <= 64 and len(found) == plain_best_fit(lengths, 64)
    pieces = sorted(packed.where("doc_id = 4").collect(), key=lambda r: r.piece)
    assert [i for r in pieces for i in r.ids] == [*TOKENIZER.encode("w " * 5000, add_special_tokens=False).ids, 2]
    assert pack(odd.where("false"), SPEC).collect() == []


def test_bins_follow_the_histogram():
    assert bins(np.array([0, 5, 0, 10**9 + 1]), 1000) == [(1, 1), (3, 10**6 + 1)]
    assert bins(np.zeros(3, np.int64)) == []


@pytest.mark.parametrize("per_bin", [1, 7, 10**6])
def test_places_in_any_number_of_bins(spark, per_bin):
    """Rows that are equal in all columns and a length that most rows have; full pieces are not shuffled."""
    staged = Staged(spark, "places")
    lengths = [3] * 400 + [7] * 90 + [10] * 60 + [1, 2, 9]
    rows = spark.createDataFrame([(None, 0, n) for n in lengths], "doc_id long, piece int, length long").repartition(6)
    rows = staged(rows.selectExpr("*", "monotonically_increasing_id() AS n"), "pieces")
    found = place(rows, 10, staged, "n", per_bin)
    assert found.columns == ["doc_id", "piece", "length", "sequence_id", "offset"]
    by_sequence = defaultdict(list)
    for r in found.collect():
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert sorted(n for v in by_sequence.values() for _, n in v) == sorted(lengths)
    for v in by_sequence.values():
        assert [o for o, _ in sorted(v)] == np.cumsum([0, *(n for _, n in sorted(v))])[:-1].tolist()
        assert sum(n for _, n in v) <= 10
    assert len(by_sequence) <= 1.01 * plain_best_fit(lengths, 10) + 1
    assert sum(v == [(0, 10)] for v in by_sequence.values()) == 60
