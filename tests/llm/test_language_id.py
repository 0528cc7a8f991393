from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lineledger.llm import language_id
from lineledger.llm.language_id import features, held_out, languages
from lineledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_features_do_not_depend_on_pieces(monkeypatch):
    texts = ["Größe und Maß, 12!", None, "", "a", "ab", "the quick brown fox " * 30]

    def counted():
        found = Counter()
        for owner, bucket in features(texts):
            found.update(zip(owner.tolist(), bucket.tolist(), strict=True))
        return found

    whole = counted()
    monkeypatch.setattr(language_id, "_PIECE", 7)
    assert counted() == whole
    assert sum(n for (i, _), n in whole.items() if i == 3) == 1
    assert sum(n for (i, _), n in whole.items() if i == 4) == 3


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op1_language_id"](spark, SF)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = found.join(docs, "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert len(rows) > 250
    assert np.mean([r.lang == r.lang_pred for r in rows]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def plain_bayes(rows, smoothing=0.5):
    """Predictions text by text and n-gram by n-gram, in doubles."""

    def grams(text):
        return [bucket for _, part in features([text]) for bucket in part.tolist()]

    known = [(text, lang) for _, text, lang, held in rows if lang is not None and text is not None and not held]
    counts, sizes = {}, Counter(lang for _, lang in known)
    for text, lang in known:
        counts.setdefault(lang, Counter()).update(grams(text))
    out = []
    for i, text, _, held in rows:
        if not text or not any(c.isalpha() for c in text):
            out.append((i, held, "und", 0.0))
            continue
        joint = {}
        for lang in sorted(counts):
            total = sum(counts[lang].values()) + smoothing * language_id.BUCKETS
            joint[lang] = math.log(sizes[lang] / len(known))
            joint[lang] += sum(math.log((counts[lang][b] + smoothing) / total) for b in grams(text))
        best = max(joint, key=joint.get)
        out.append((i, held, best, 1 / sum(math.exp(v - joint[best]) for v in joint.values())))
    return sorted(out)


def test_equals_plain_bayes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 250")
    # short texts, whose scores are not all near one, and labels of four languages and of none
    short = F.udf(lambda t: t and t.strip()[:2], "string")
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise(short("text")))
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", held_out()).collect()]
    expected, found = plain_bayes(rows), sorted(tuple(r) for r in languages(docs).collect())
    assert [r[:3] for r in found] == [r[:3] for r in expected]
    assert np.allclose([r[3] for r in found], [r[3] for r in expected], atol=2e-3)
    assert sum(r[3] < 0.99 for r in expected) >= 10


def test_any_number_of_languages(spark):
    words = ["".join(chr(97 + (n * k) % 26) for k in (1, 3, 7, 11)) + f" {chr(0x4E00 + n)}" for n in range(600)]
    rows = [(n, words[n], f"l{n:03}") for n in range(600) if zlib.crc32(str(n).encode()) % 3 != 1]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id: r.lang_pred for r in languages(docs).collect()} == {n: lang for n, _, lang in rows}
    assert len(rows) > 300


def test_labels_and_ids_do_not_matter_for_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    changed = docs.withColumn("lang", F.when(held_out(), "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    assert sorted(languages(docs).collect()) == sorted(languages(changed).collect())


def test_odd_tables(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "", None)]
    rows += [(5, "12 ² ½ _ --", None), (None, "und der hund", None), (5, "the the", None), (5, "the the", None)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "0.5 AS score", "'q' AS lang_pred")
    found = languages(odd).collect()
    assert len(found) == len(rows)
    by_id = {(r.doc_id, r.lang_pred): r for r in found}
    assert {r.lang_pred for r in found if r.doc_id in (3, 4)} == {"und"}
    assert [r.lang_pred for r in found if r.doc_id == 5].count("und") == 1
    assert by_id[3, "und"].score == 0
    assert languages(odd.where("false")).collect() == []
    assert {r.lang_pred for r in languages(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
