"""Packing documents into sequences by patterns of lengths, fitted by non-negative least squares."""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lineledger.llm.shared import Staged, map_batches
from lineledger.llm.tokens import encoder

Pattern = tuple[int, ...]
PIECES_PER_BIN = 1 << 10  # that are numbered together: at most 4 MB with their ids, whatever the number of pieces
PARTNERS = 6  # second documents that are tried for each length when patterns are enumerated
_STEPS = 1500  # of the least-squares fit


# --- planning on the histogram of lengths ----------------------------------------------------------------------


def candidate_patterns(lengths: list[int], size: int) -> list[Pattern]:
    """Patterns of few lengths that fill a sequence to within a hundredth, each length of the histogram in some."""
    have = np.array(sorted(lengths))
    known, found = set(lengths), {(n,) for n in lengths if n == size}
    for a in have[have < size].tolist():
        if size - a in known:
            found.add(tuple(sorted((a, size - a))))
        fits = have[have <= size - a]
        picks = fits[np.unique(np.linspace(0, len(fits) - 1, PARTNERS).astype(int))] if len(fits) else []
        for b in np.unique(picks).tolist():
            pattern, left = [a, b], size - a - b
            while left > 0:
                k = np.searchsorted(have, left, side="right") - 1
                if k < 0:
                    break
                pattern.append(int(have[k]))
                left -= int(have[k])
            if left <= size // 100:
                found.add(tuple(sorted(pattern)))
    return sorted(found, key=lambda p: (len(p), p))


def nnls(patterns: list[Pattern], histogram: np.ndarray) -> np.ndarray:
    """Repeats x >= 0 of the patterns that minimise ``|A x - histogram|``, by accelerated projected gradients."""
    cells = [(length, k, n) for k, p in enumerate(patterns) for length, n in Counter(p).items()]
    row, column, weight = (np.array(c) for c in zip(*cells, strict=True))
    weight = weight.astype(float)

    def times(x):
        return np.bincount(row, weight * x[column], minlength=len(histogram))

    def back(r):
        return np.bincount(column, weight * r[row], minlength=len(patterns))

    x = probe = np.zeros(len(patterns))
    v = np.ones(len(patterns))
    for _ in range(20):  # the largest eigenvalue of A'A bounds the step
        v = back(times(v))
        norm = np.linalg.norm(v)
        v /= norm
    step, t = 1 / (1.05 * norm), 1.0
    for _ in range(_STEPS):
        moved = np.maximum(0, probe - step * back(times(probe) - histogram))
        ahead = (1 + np.sqrt(1 + 4 * t * t)) / 2
        probe, x, t = moved + (t - 1) / ahead * (moved - x), moved, ahead
    return x


def best_fit(histogram: np.ndarray, size: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing on counts: equal sequences are filled at once, so the work does not grow with the counts."""
    open_: dict[int, list[tuple[Pattern, int]]] = {}
    for length in np.flatnonzero(histogram)[::-1].tolist():
        count = int(histogram[length])
        while count:
            room = min((r for r in open_ if r >= length), default=None)
            pattern, repeats = ((), None) if room is None else open_[room].pop()
            room = size if room is None else room
            if repeats is not None and not open_[room]:
                del open_[room]
            each = min(room // length, count)
            filled = count // each if repeats is None else min(repeats, count // each)
            count -= filled * each
            open_.setdefault(room - each * length, []).append((pattern + (length,) * each, filled))
            if repeats is not None and repeats > filled:
                open_.setdefault(room, []).append((pattern, repeats - filled))
    return [block for blocks in open_.values() for block in blocks]


def plan(histogram: np.ndarray, size: int) -> list[tuple[Pattern, int]]:
    """Patterns and how often each is used; together they use up the histogram exactly.

    The fitted repeats are rounded down, and never use more pieces than there are; what is left over is packed by
    best fit.
    """
    left = histogram.astype(np.int64).copy()
    lengths = np.flatnonzero(left).tolist()
    patterns = candidate_patterns(lengths, size) if lengths else []
    out = []
    if patterns:
        repeats = np.floor(nnls(patterns, left / left.max()) * left.max() + 1e-6).astype(np.int64)
        for k in np.argsort(-repeats, kind="stable").tolist():
            need = Counter(patterns[k])
            n = min(int(repeats[k]), *(int(left[length]) // m for length, m in need.items()))
            if n > 0:
                out.append((patterns[k], n))
                for length, m in need.items():
                    left[length] -= n * m
    return out + best_fit(left, size)


@dataclass(frozen=True)
class Slots:
    """Where the pieces of each length go: the r-th one belongs to the last slot of its length that starts at or before r."""

    length: np.ndarray
    start: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    @staticmethod
    def of(blocks: list[tuple[Pattern, int]]) -> Slots:
        used, rows, sequence = Counter(), [], 0
        for pattern, repeats in blocks:
            offset = 0
            for length in pattern:
                rows.append((length, used[length], sequence, offset))
                used[length] += repeats
                offset += length
            sequence += repeats
        return Slots(*np.array(sorted(rows), np.int64).reshape(-1, 4).T)

    def table(self, spark: SparkSession) -> DataFrame:
        """A row per length, with its slots in order."""
        rows = []
        for length in np.unique(self.length).tolist():
            own = self.length == length
            rows.append((length, *(column[own].tolist() for column in (self.start, self.sequence, self.offset))))
        return spark.createDataFrame(
            rows, "length bigint, starts array<bigint>, sequences array<bigint>, offsets array<bigint>"
        )


# --- pieces and places in Spark --------------------------------------------------------------------------------


def cut(length: int, size: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document; all but the first are full."""
    first = length % size or min(length, size)
    starts = [0, *range(first, length, size)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], length], strict=True)]


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int, size: int, id_col: str, text_col: str, keep_ids: bool
) -> DataFrame:
    """``(id, piece, start, length, ids_crc32[, ids])`` for each row's ids followed by ``end_id``; null texts are empty.

    ``tokenizer`` is the content of a tokenizer file.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def batch(ids, texts):
        encode = encoder(shared.value)
        out = {"doc": [], "piece": [], "start": [], "length": [], "ids_crc32": [], "ids": []}
        for i, text in enumerate(texts):
            text = text.as_py()
            own = np.append(encode(text), np.uint32(end_id)) if text else np.array([end_id], np.uint32)
            for k, (start, n) in enumerate(cut(len(own), size)):
                part = own[start : start + n].astype("<u4")
                values = (i, k, start, n, zlib.crc32(part), part if keep_ids else None)
                for column, value in zip(out.values(), values, strict=True):
                    column.append(value)
        out[id_col] = ids.take(pa.array(out.pop("doc"), pa.int64()))
        yield out

    schema = f"{id_col} bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    schema += ", ids array<int>" if keep_ids else ""
    return map_batches(docs, {id_col: "bigint", text_col: "string"}, batch, schema)


def bins(histogram: np.ndarray, per_bin: int = PIECES_PER_BIN) -> list[tuple[int, int]]:
    """In how many bins the pieces of each length are numbered; a frequent length has as many as its pieces need."""
    return [(int(n), -(-int(histogram[n]) // per_bin)) for n in np.flatnonzero(histogram)]


def place(pieces: DataFrame, size: int, staged: Staged, number: str, per_bin: int = PIECES_PER_BIN) -> DataFrame:
    """``pieces``, a stored table with a ``length`` of 1 to ``size``, with ``sequence_id`` and ``offset``.

    ``number`` is a column of different numbers, none negative, which the result lacks; they have to be stored, so that a
    task that runs again finds the same ones. Only the histogram reaches the driver: at most ``size`` numbers. The plan that comes back is broadcast: it has a
    row per length with some ten thousand slots in all, whatever the number of pieces.

    Pieces of ``size`` are sequences by themselves, with negative numbers, and go nowhere. The others are numbered in
    bins of about ``per_bin`` pieces of a length, and the bins' totals give the first number of each, so neither a
    frequent length nor repeated rows are a large group.
    """
    spark, counts = pieces.sparkSession, pieces.groupBy("length").count().collect()
    histogram = np.zeros(size + 1, np.int64)
    for row in counts:
        histogram[row["length"]] = row["count"]
    own = [c for c in pieces.columns if c != number]
    alone = [(-1 - F.col(number)).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")]
    full = pieces.where(F.col("length") == size).select(*own, *alone)
    histogram[size] = 0
    slots = Slots.of(plan(histogram, size)).table(spark)
    per_length = F.broadcast(spark.createDataFrame(bins(histogram, per_bin), "length bigint, bins bigint"))
    rest = pieces.where(F.col("length") < size)
    binned = rest.select(F.struct(*own).alias("__row"), "length", F.col(number).alias("__number"))
    mark = F.pmod(F.xxhash64("__number"), F.col("bins")).alias("__bin")
    binned = binned.join(per_length, "length").select("*", mark).drop("bins")
    totals = binned.groupBy("length", "__bin").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    totals = staged(totals.select("length", "__bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "totals")
    within = Window.partitionBy("length", "__bin").orderBy("__number")
    ranked = binned.withColumn("rank", F.row_number().over(within) - 1).join(totals, ["length", "__bin"])
    ranked = ranked.select("__row", "length", (F.col("rank") + F.col("before")).alias("rank"))
    slot = F.size(F.filter("starts", lambda s: s <= F.col("rank")))
    placed = ranked.join(F.broadcast(slots), "length").withColumn("slot", slot)
    placed = placed.select(
        "__row",
        (F.element_at("sequences", F.col("slot")) + F.col("rank") - F.element_at("starts", F.col("slot"))).alias("sequence_id"),
        F.element_at("offsets", F.col("slot")).alias("offset"),
    )
    return placed.select("__row.*", "sequence_id", "offset").unionByName(full)


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    size: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """One row per piece with its place: ``(id, piece, start, length, ids_crc32[, ids], sequence_id, offset)``.

    Only documents of more than ``size`` ids are cut. Null and empty texts are one id long and packed like others;
    repeated rows are packed each for itself.
    """
    staged = Staged(docs.sparkSession, "packing")
    cut_up = pieces(docs, tokenizer, end_id, size, id_col, text_col, keep_ids)
    cut_up = staged(cut_up.withColumn("__piece", F.monotonically_increasing_id()), "pieces")
    return place(cut_up, size, staged, "__piece")


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)`` of the pieces of :func:`pack` with their ids, put together in order of their offsets."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
