"""Substring deduplication by content-defined chunks with a gear rolling hash."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineledger.llm.copies import (
    documents,
    earlier_copies,
    parts_for,
    spans_by_document,
    text_bytes,
    union_of,
    with_spans,
)
from lineledger.llm.shared import Staged, map_batches

REACH = 3  # a cut's hash is the least among that many possible cuts on both sides
LONGEST = 12  # possible cuts after which there is one in any case
LEAST_WORDS = 20  # of a run that is removed
_WINDOW = 16  # bytes that the gear hash remembers: 32 bits, two of them shifted out per byte
_LONG_WORD = 64  # bytes without white space after which a character may be cut from the next
_BLOCK = 1 << 22  # bytes that are hashed at once
_MIX = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
GEAR = ((_MIX ^ (_MIX >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.uint32)
_IS_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def gear_hash(data: np.ndarray) -> np.ndarray:
    """``h[i] = (h[i-1] << 2) + GEAR[data[i]]`` in 32 bits, for all positions at once by doubling the reach."""
    h = GEAR[data]
    reach = 1
    while reach < _WINDOW:
        longer = h.copy()
        longer[reach:] += h[:-reach] << np.uint32(2 * reach)
        h, reach = longer, 2 * reach
    return h


def _possible(data: np.ndarray, first: int) -> np.ndarray:
    """Offsets from ``first`` on where a chunk may start: words, and characters of very long words."""
    space = _IS_SPACE[data]
    at = np.arange(len(data))
    since = at - np.maximum.accumulate(np.where(space, at, -1))
    word = np.r_[False, space[:-1] & ~space[1:]]
    inside = (since > _LONG_WORD) & ((data & 0xC0) != 0x80) & ~space
    found = np.flatnonzero(word | inside)
    return found[found >= max(1, first)]


def cuts(text: bytes) -> np.ndarray:
    """Offsets of the chunk borders, the text's ends included.

    A border is a possible cut whose gear hash, over the bytes before it, is the least among :data:`REACH`
    possible cuts on either side. It depends on nothing further away, so an insertion moves only the borders
    beside it, and a passage is cut alike wherever it stands. Where there is none for :data:`LONGEST` possible cuts,
    as in a word that is repeated over and over, further borders are counted from the last one.
    """
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return np.zeros(1, np.int64)
    offsets, hashes = [], []
    for start in range(0, len(data), _BLOCK):
        before = max(0, start - _WINDOW - _LONG_WORD - 1)
        block = data[before : start + _BLOCK]
        own = _possible(block, start - before)
        hashes.append(gear_hash(block)[own - 1])
        offsets.append(own + before)
    offset, h = np.concatenate(offsets), np.concatenate(hashes).astype(np.int64)
    least = np.ones(len(h), bool)
    for k in range(1, min(REACH, len(h) - 1) + 1):
        least[k:] &= h[k:] < h[:-k]  # of equal ones the first is a border
        least[:-k] &= h[:-k] <= h[k:]
    borders = np.r_[-1, np.flatnonzero(least), len(h)]
    more = (np.diff(borders) - 1) // LONGEST
    nth = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
    counted = np.repeat(borders[:-1], more) + LONGEST * nth
    return np.r_[0, offset[np.sort(np.r_[np.flatnonzero(least), counted])], len(data)]


def _keys(texts: list[bytes]):
    """A key for each two chunks in a row (or a text's only chunk), so that a short chunk alone is never a copy."""
    doc, start, size, digests = [], [], [], []
    for i, text in enumerate(texts):
        border = cuts(text)
        if len(border) == 1:
            continue
        step = min(2, len(border) - 1)
        a, b = border[:-step], border[step:]
        doc.append(np.full(len(a), i, np.uint32))
        start.append(a)
        size.append(b - a)
        digests += [xxhash.xxh3_128_digest(text[x:y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    digest = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    every = [np.concatenate(c).astype(np.uint32) if c else np.zeros(0, np.uint32) for c in (doc, start, size)]
    return every[0], digest[:, 0], (digest[:, 1] >> np.uint64(32)).astype(np.uint32), every[1], every[2]


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Spans of the rows of :func:`~lineledger.llm.copies.documents` that an earlier document has, per document.

    They are stored: keys are shuffled into partitions by the size of the input, and the planner of the join with the
    texts knows how few or many spans there are.
    """
    parts = parts_for(text_bytes(docs) // 30)
    return Staged(docs.sparkSession, "chunks")(spans_by_document(earlier_copies(docs, _keys, parts)), "spans")


def _is_passage(run: bytes, least_words: int) -> bool:
    """Whether a run has that many words, or as many characters as such words have, for scripts without spaces."""
    return len(run.split()) >= least_words or len(run.decode("utf-8", "surrogatepass")) >= 8 * least_words


def _without(texts, starts, sizes, least_words):
    kept, removed, spans = [], [], []
    for text, a, n in zip(texts, starts, sizes, strict=True):
        text = text.as_py()
        if not a.is_valid:
            kept.append(text)
            removed.append(0)
            spans.append(0)
            continue
        a = np.array(a.as_py(), np.int64)
        first, last = union_of(a, a + np.array(n.as_py(), np.int64))
        data, at, rest = text.encode("utf-8", "surrogatepass"), 0, []
        runs = list(zip(first.tolist(), last.tolist(), strict=True))
        runs = [(x, y) for x, y in runs if y - x == len(data) or _is_passage(data[x:y], least_words)]
        for x, y in runs:
            rest.append(data[at:x])
            at = y
        rest.append(data[at:])
        kept.append(b"".join(rest).decode("utf-8", "surrogatepass"))
        removed.append(sum(y - x for x, y in runs))
        spans.append(len(runs))
    return kept, removed, spans


def dedup_substrings(
    docs: DataFrame, *carried: Column, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS
) -> DataFrame:
    """``carried`` columns of each row with ``kept`` text, ``n_removed`` bytes and ``n_spans`` removed runs.

    Chunks that stand side by side in a document with a smaller id, too, are removed, if a run of them has
    ``least_words`` words or is all of the text; shorter ones are phrases and lines that many texts share. What
    repeats inside a document stays. Null texts are empty. Rows with the same id are no copies of each other; null ids come after
    all others. A document all of whose chunks are copies keeps an empty text.
    """
    rows = documents(docs, id_col, text_col)
    spans = repeated_spans(rows)
    wide = docs.select(F.struct(*carried).alias("__row"), F.col(id_col).alias(id_col), F.col(text_col).alias(text_col))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    wide = wide.select("__row", F.col(id_col).cast("bigint").alias("id"), text.alias("text"))
    found = with_spans(wide.withColumn("text_hash", F.xxhash64("text")), spans, "left")
    fields = found.schema["__row"].dataType.simpleString()

    def batch(row, texts, starts, sizes):
        kept, removed, runs = _without(texts, starts, sizes, least_words)
        yield {"__row": row, "kept": kept, "n_removed": removed, "n_spans": runs}

    kinds = {"__row": fields, "text": "string", "starts": "array<int>", "sizes": "array<int>"}
    done = map_batches(found, kinds, batch, f"__row {fields}, kept string, n_removed bigint, n_spans bigint")
    return done.select("__row.*", "kept", "n_removed", "n_spans")
