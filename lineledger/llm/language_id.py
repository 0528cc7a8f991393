"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineledger.llm.shared import map_batches

UNDETERMINED = "und"
ORDERS = (1, 2, 3)  # lengths of the n-grams
BUCKETS = 1 << 16
_PIECE = 1 << 20  # code points that are hashed at once
_SPACE, _BREAK = 32, 0xFFFFFFFF
_WORDLIKE = re.compile(r"[^\W\d_]")
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
_FOLD = np.array([c if chr(c).isalpha() else _SPACE for c in range(128)], np.uint32)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(m.group().isalpha() for m in _WORDLIKE.finditer(text))


def _pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Code points of the texts in bounded blocks, with the index of the text that n-grams there belong to.

    A long text is cut into pieces that overlap by the longest n-gram less one, so that each n-gram is in one
    piece; positions of the overlap and of the breaks between texts belong to no text (-1).
    """
    over = max(ORDERS) - 1
    codes, owners, size = [], [], 0
    for i, text in enumerate(texts):
        text = (text or "").lower()
        for start in range(0, len(text), _PIECE):
            piece = text[start : start + _PIECE + over]
            code = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
            owner = np.full(len(code) + 1, i, np.int64)
            owner[min(_PIECE, len(code)) :] = -1
            codes += [code, np.array([_BREAK], np.uint32)]
            owners.append(owner)
            size += len(owner)
            if size >= _PIECE:
                yield np.concatenate(codes), np.concatenate(owners)
                codes, owners, size = [], [], 0
    if codes:
        yield np.concatenate(codes), np.concatenate(owners)


def features(texts: list[str | None], buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of ``(index of the text, bucket)``, one entry per n-gram; entries of a text follow each other.

    Texts are lower-cased and ASCII signs that are not letters become spaces; n-grams of spaces alone are left out.
    """
    shift = np.uint64(64 - buckets.bit_length() + 1)
    for code, owner in _pieces(texts):
        small = code < 128
        code = np.where(small, _FOLD[np.where(small, code, 0)], code)
        word, ends = code != _SPACE, code == _BREAK
        wide = code.astype(np.uint64)
        for n in ORDERS:
            m = len(code) - n + 1
            if m <= 0:
                continue
            keep, some = owner[:m] >= 0, np.zeros(m, bool)
            mixed = np.full(m, n, np.uint64)
            for k in range(n):
                mixed = (mixed ^ wide[k : k + m]) * _FACTORS[k]
                keep = keep & ~ends[k : k + m]
                some |= word[k : k + m]
            keep &= some
            yield owner[:m][keep], ((mixed * _FACTORS[-1])[keep] >> shift).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Languages in order, and the log probability of each bucket for each of them."""

    languages: list[str]
    log_probs: np.ndarray
    log_priors: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and its posterior probability for each text; ``und`` and 0 where there is no letter."""
        found = [i for i, t in enumerate(texts) if has_letter(t)]
        names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if not found or not self.languages:
            return names, scores
        joint = np.repeat(self.log_priors[:, None], len(found), axis=1)
        for owner, bucket in features([texts[i] for i in found], self.log_probs.shape[1]):
            if len(owner):
                first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                for k, row in enumerate(self.log_probs):
                    joint[k, owner[first]] += np.add.reduceat(row[bucket], first)
        best = joint.argmax(axis=0)
        scores[found] = 1 / np.exp(joint - joint.max(axis=0)).sum(axis=0)
        for i, k in zip(found, best, strict=True):
            names[i] = self.languages[k]
        return names, scores


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.5) -> Model:
    """Fits the model on every row with a language and a text.

    N-grams are counted per batch in numpy, per task and in total by Spark; what reaches the driver is a row of
    :data:`BUCKETS` numbers of 32 bits per language, whatever the number of rows: 256 KB for each label.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())

    def count(texts, langs):
        texts, langs = texts.to_pylist(), langs.to_pylist()
        for lang in dict.fromkeys(langs):
            total = np.zeros(BUCKETS, np.int64)
            own = [t for t, k in zip(texts, langs, strict=True) if k == lang]
            for _, bucket in features(own):
                total += np.bincount(bucket, minlength=BUCKETS)
            some = np.flatnonzero(total)
            yield {
                "lang": [lang] * (len(some) + 1),
                "bucket": np.r_[-1, some].astype(np.int32),
                "n": np.r_[len(own), total[some]],
            }

    counted = map_batches(known, {text_col: "string", lang_col: "string"}, count, "lang string, bucket int, n bigint")
    per_bucket = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    by_language = per_bucket.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("cells"))
    names, log_probs, sizes = [], [], []
    rows = by_language.orderBy("lang").toArrow().combine_chunks()
    for lang, cells in zip(rows["lang"].to_pylist(), rows["cells"], strict=True):
        bucket, n = (np.asarray(part) for part in cells.values.flatten())
        counts = np.full(BUCKETS, smoothing)
        counts[bucket[bucket >= 0]] += n[bucket >= 0]
        names.append(lang)
        log_probs.append(np.log(counts / counts.sum()).astype(np.float32))
        sizes.append(int(n[bucket < 0].sum()))
    sizes = np.array(sizes, float)
    return Model(names, np.array(log_probs, np.float32).reshape(-1, BUCKETS), np.log(sizes / max(1, sizes.sum())))


def identify(docs: DataFrame, model: Model, *carried: Column, text_col: str = "text") -> DataFrame:
    """``carried`` columns of each row with ``lang_pred`` and ``score`` of its whole text; nothing else is read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(text_col).cast("string").alias("__text"), F.struct(*carried).alias("__row"))
    fields = rows.schema["__row"].dataType.simpleString()

    def batch(texts, row):
        names, scores = shared.value.predict(texts.to_pylist())
        yield {"__row": row, "lang_pred": names, "score": scores}

    kinds = {"__text": "string", "__row": fields}
    found = map_batches(rows, kinds, batch, f"__row {fields}, lang_pred string, score double")
    return found.select("__row.*", "lang_pred", "score")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that the registered query and the pipeline never learn from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(id, held_out, lang_pred, score)`` for each row, learned from the rows that are not held out.

    Null texts, empty ones and texts without a letter are ``und`` with score 0, and so is everything if no row has
    a language. A null id is not held out. Repeated rows are predicted and learned from one by one; equal scores
    go to the language first in order.
    """
    model = train(docs.where(~held_out(id_col)), text_col, lang_col)
    return identify(docs, model, F.col(id_col), held_out(id_col).alias("held_out"), text_col=text_col)
