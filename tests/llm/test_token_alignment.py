from __future__ import annotations

import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lineledger.llm import token_alignment
from lineledger.llm.bpe import byte_signs
from lineledger.llm.queries import QUERIES, tokenizer_file
from lineledger.llm.token_alignment import MinimalPerfectHash, Tokenizers, align, align_corpus, count_pairs, tokenize

SF = "/root/testdata/sf0.001"
SPEC = tokenizer_file("byte_bpe_50k.json")
PIECES = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
FILES = Tokenizers(SPEC, PIECES)
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain(rows):
    """Alignment text by text and token by token."""
    first, second = Tokenizer.from_str(SPEC), sentencepiece.SentencePieceProcessor(model_proto=PIECES)
    first.encode_special_tokens = True
    signs = byte_signs()

    def piece(i):
        text = second.id_to_piece(i)
        return bytes([int(text[3:5], 16)]) if text[:3] == "<0x" else text.replace("▁", " ").encode()

    aligned = []
    for _, text in rows:
        groups, whole = [], f" {text or ''}".encode()
        a = [(i, bytes(signs[s] for s in first.id_to_token(i))) for i in first.encode(f" {text or ''}", add_special_tokens=False).ids]
        b = [(i, piece(i)) for i in second.encode(text or "")]
        if text and b"".join(t for _, t in a) == whole == b"".join(t for _, t in b):
            ends_a, ends_b = (np.cumsum([len(t) for _, t in side]).tolist() for side in (a, b))
            start_a = start_b = 0
            for end in sorted({*ends_a} & {*ends_b}):
                at_a, at_b = ends_a.index(end, start_a) + 1, ends_b.index(end, start_b) + 1
                groups.append(([i for i, _ in a[start_a:at_a]], [i for i, _ in b[start_b:at_b]]))
                start_a, start_b = at_a, at_b
        aligned.append(groups)
    counts = Counter((a[-1], b[-1]) for groups in aligned for a, b in groups)
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for (i, _), groups in zip(rows, aligned):
        links = [counts[a[-1], b[-1]] for a, b in groups]
        best = sum(n == highest[b[-1]] for n, (_, b) in zip(links, groups))
        shown = ";".join("|".join(",".join(map(str, side)) for side in group) for group in groups)
        digest = hashlib.sha256(shown.encode()).hexdigest() if groups else ""
        n_a, n_b = (sum(len(group[side]) for group in groups) for side in (0, 1))
        out.append((i, n_a, n_b, len(groups), len(groups), best, sum(links), digest))
    return sorted(out, key=str)


def found(spark, docs):
    out = align_corpus(docs, FILES, *COLUMNS[:-1], "groups")
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return sorted((tuple(r) for r in out.withColumn("groups", digest).collect()), key=str)


@pytest.mark.parametrize("size", [0, 1, 2, 50, 20_000])
def test_hash_is_minimal_and_perfect(size):
    rng = np.random.default_rng(size)
    keys = np.unique(rng.integers(0, 2**33, size))
    place = MinimalPerfectHash(keys)
    assert sorted(place(keys).tolist()) == list(range(len(keys)))
    assert (place.keys[place(keys)] == keys).all()
    with pytest.raises(RuntimeError, match="not counted"):
        place(np.array([2**40 + 1]))


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = QUERIES["op13_token_alignment"](spark, SF)
    assert out.columns == COLUMNS
    assert [t for _, t in out.dtypes] == ["bigint"] * 7 + ["string"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == plain(rows)


@pytest.mark.parametrize("parts", [1, 3, 80])
def test_any_number_of_tasks(spark, monkeypatch, parts):
    monkeypatch.setattr(token_alignment, "_SLICE", 50)
    monkeypatch.setattr(token_alignment, "_IDS_AT_ONCE", 60)
    rng = random.Random(parts)
    words = ["the", "token", "tokens", "naïve", "日本語", "🙂", "  ", "x1", "12345", "<|endoftext|>", "</s>", "<0x41>", "\n"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    assert found(spark, docs) == plain(rows)


def test_odd_tables(spark):
    texts = [None, "", " ", "a", "a", "a▁b", "<unk>", "a" * 20_000, "\x00", "tab\tand\nline", " lead", "trail ", "  ", "é" * 500]
    rows = [*enumerate(texts), (None, "same words"), (None, None), (3, "same words"), (3, "same words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.selectExpr("*", "1 AS n_a", "'q' AS __row", "'g' AS groups", "2 AS keys", "3 AS counts")
    assert found(spark, docs) == plain(rows)
    assert found(spark, docs.where("false")) == []
    nothing = [(i, None) for i in range(3)]
    assert found(spark, docs.where("text IS NULL").select("doc_id", "text").limit(0).union(spark.createDataFrame(nothing, "doc_id long, text string"))) == plain(nothing)


def test_counts_of_other_documents_are_refused(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    counted = count_pairs(tokenize(docs, FILES, F.col("doc_id")), FILES)
    other = tokenize(docs.withColumn("text", F.lit("entirely different")), FILES, F.col("doc_id"))
    with pytest.raises(Exception, match="not counted"):
        align(other, FILES, counted).collect()
