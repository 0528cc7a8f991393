"""Tokens of two tokenizers side by side: where their ends meet, and how often each pair of ids meets in a corpus.

Two ids can only meet if the bytes of one are the end of the other's, so there are never more pairs than the two
vocabularies have bytes. That bounds the minimal perfect hash of the pairs and the dense vectors of counts, whatever the
number of documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineledger.llm.bpe import byte_signs, id_lists
from lineledger.llm.shared import Staged, map_batches, ship_package
from lineledger.llm.tokens import Encoder
from lineledger.session import settings

_ROWS_AT_ONCE = 512
_SPACE = "▁"  # stands for a space in piece models
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
_IDS_AT_ONCE = 500_000  # of texts that are aligned together; a longer text is on its own
_SLOTS_PER_KEY = 2  # of a level of the hash
_BRANCHES = 8  # vectors that a node of the tree adds up
_SLICE = 65_536  # counts in a row


class MinimalPerfectHash:
    """A different place below ``len(keys)`` for each of some distinct numbers.

    Every level has a few times as many slots as keys are left; a key that is alone in its slot stays there, and
    the others go on to the next level. Places count the kept keys in order of levels and slots. ``keys`` are kept by
    place, so that a number without a place is known as such.
    """

    def __init__(self, keys: np.ndarray):
        left, self.levels, placed = np.asarray(keys, np.int64), [], []
        while len(left):
            slot = self._slots(left, len(self.levels), _SLOTS_PER_KEY * len(left))
            alone = np.bincount(slot, minlength=_SLOTS_PER_KEY * len(left)) == 1
            places = np.where(alone, np.cumsum(alone) - 1 + sum(map(len, placed)), -1)
            stays = alone[slot]
            placed.append(left[stays][np.argsort(slot[stays])])
            self.levels.append(places.astype(np.int32))
            left = left[~stays]
        self.keys = np.concatenate(placed) if placed else np.zeros(0, np.int64)

    @staticmethod
    def _slots(keys: np.ndarray, level: int, slots: int) -> np.ndarray:
        """Any hash that differs from level to level."""
        mixed = (keys.astype(np.uint64) + np.uint64(level * 0x632BE59BD9B4E019 % 2**64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        return ((mixed >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; a key that was not there when the hash was made is an error."""
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, places in enumerate(self.levels):
            out[open_] = places[self._slots(keys[open_], level, len(places))]
            open_ = open_[out[open_] < 0]
            if not len(open_):
                break
        if len(open_) or (len(keys) and (self.keys[out] != keys).any()):
            raise RuntimeError("a pair of ids that was not counted: the documents are not the ones that were counted")
        return out


@dataclass(frozen=True)
class Tokenizers:
    """The content of a byte-level BPE file and of a piece model."""

    spec: str
    pieces: bytes


class _Pair:
    """Both tokenizers with the bytes of their entries."""

    def __init__(self, files: Tokenizers):
        self.a = Encoder(files.spec)
        self.a.special, self.a.exact.encode_special_tokens = [], True  # special strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.pieces)
        signs, vocab = byte_signs(), self.a.exact.get_vocab()
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(signs[s] for s in token) if all(s in signs for s in token) else token.encode()
        self.bytes_b = [self._piece(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        if not all(self.bytes_b) or not all(self.bytes_a[i] for i in vocab.values()):
            raise ValueError("an entry of a vocabulary has no bytes")
        self.sizes_a, self.sizes_b = (np.array([len(t) for t in side]) for side in (self.bytes_a, self.bytes_b))
        # what stands for an id inside its side of a group and at that side's end
        self.shown = [f"{i}{mark}" for i in range(len(self.bytes_a)) for mark in ",|"]
        self.shown += [f"{i}{mark}" for i in range(len(self.bytes_b)) for mark in ",;"]

    @staticmethod
    def _piece(piece: str) -> bytes:
        byte = _BYTE.fullmatch(piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace(_SPACE, " ").encode()

    def ids(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a space and the text; none where the entries' bytes are not those of the text."""
        if text:
            a, b, whole = self.a(f" {text}"), self.b.encode(text), f" {text}".encode()
            if b"".join(map(self.bytes_a.__getitem__, a.tolist())) == whole == b"".join(map(self.bytes_b.__getitem__, b)):
                return a.astype(np.int32), np.array(b, np.int32)
        return np.zeros(0, np.int32), np.zeros(0, np.int32)


@lru_cache(maxsize=2)
def _pair(files: Tokenizers) -> _Pair:
    """Loaded once per worker."""
    return _Pair(files)


@dataclass(frozen=True)
class _Aligned:
    """Some texts' ids one after the other, which ones end where one of the other side ends, and each text's share."""

    a: np.ndarray
    b: np.ndarray
    met_a: np.ndarray
    met_b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    width: int  # ids of the second side

    @cached_property
    def links(self) -> np.ndarray:
        """A number for the pair of ids at each common end."""
        return self.a[self.met_a] * self.width + self.b[self.met_b]

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums over the links of each text."""
        ends = np.concatenate([[0], np.cumsum(self.met_a)])[np.cumsum(self.n_a)]
        return np.diff(np.concatenate([[0], values], dtype=np.int64).cumsum()[np.concatenate([[0], ends])])

    def groups(self, pair: _Pair) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text: a group's ids of both sides, and the groups in order."""
        group_a, group_b = np.cumsum(self.met_a) - self.met_a, np.cumsum(self.met_b) - self.met_b
        before_b = np.concatenate([[0], np.flatnonzero(self.met_b) + 1])  # ids of B before each group
        up_to_a = np.flatnonzero(self.met_a) + 1  # ids of A up to the end of each group
        shown = np.empty(len(self.a) + len(self.b), np.int64)
        shown[np.arange(len(self.a)) + before_b[group_a]] = 2 * self.a + self.met_a
        shown[np.arange(len(self.b)) + up_to_a[group_b]] = 2 * (len(pair.bytes_a) + self.b) + self.met_b
        ends, out, begin = np.cumsum(self.n_a + self.n_b).tolist(), [], 0
        signs = pair.shown.__getitem__
        for end in ends:
            out.append("".join(map(signs, shown[begin:end].tolist()))[:-1])
            begin = end
        return out


def _ends(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes[ids], dtype=np.int64)


def _align(pair: _Pair, a: pa.Array, b: pa.Array) -> _Aligned:
    """Lists of ids of some texts: a text has as many bytes on both sides, so that ends meet within texts only."""
    n_a, n_b = (np.diff(side.offsets.to_numpy()).astype(np.int64) for side in (a, b))
    a, b = (side.flatten().to_numpy().astype(np.int64) for side in (a, b))
    ends_a, ends_b = _ends(a, pair.sizes_a), _ends(b, pair.sizes_b)
    at_a, at_b = (np.zeros(int(ends_a[-1]) + 1 if len(a) else 1, bool) for _ in range(2))
    at_a[ends_a], at_b[ends_b] = True, True
    return _Aligned(a, b, at_b[ends_a], at_a[ends_b], n_a, n_b, len(pair.bytes_b))


def _batches(*columns: pa.Array) -> Iterator[list[pa.Array]]:
    """Neighbouring rows with a bounded number of ids together; the last column is a list of ids."""
    sizes = np.diff(columns[-1].offsets.to_numpy())
    first = size = 0
    for at, own in enumerate(sizes.tolist()):
        if at > first and size + own > _IDS_AT_ONCE:
            yield [c.slice(first, at - first) for c in columns]
            first, size = at, 0
        size += own
    if first < len(sizes):
        yield [c.slice(first) for c in columns]


def _sum_by_key(parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(side) for side in zip(*parts))
    keys, place = np.unique(keys, return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, place, counts)
    return keys, total


def _slices(node: int, vector: np.ndarray) -> pa.RecordBatch:
    """A vector as rows of a bounded length."""
    parts = [vector[at : at + _SLICE] for at in range(0, len(vector), _SLICE)]
    offsets = np.cumsum([0, *map(len, parts)])
    counts = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(vector, pa.int64()))
    places = pa.array(np.arange(len(parts), dtype=np.int32))
    return pa.RecordBatch.from_arrays([pa.array([node] * len(parts), pa.int32()), places, counts], names=["node", "slice", "counts"])


@dataclass(frozen=True)
class PairCounts:
    """How often each pair of ids is linked in a corpus, by the place that the hash gives the pair."""

    place: MinimalPerfectHash
    counts: np.ndarray
    width: int

    @cached_property
    def highest(self) -> np.ndarray:
        """The highest count of a pair with each id of the second side."""
        out = np.zeros(self.width, np.int64)
        np.maximum.at(out, self.place.keys % self.width, self.counts)
        return out


def tokenize(docs: DataFrame, files: Tokenizers, *carried: Column, text_col: str = "text") -> DataFrame:
    """``row``, a struct of the ``carried`` columns, and the ids ``a`` and ``b`` of each whole text.

    The first tokenizer reads a space and the text, the second, which adds the space, the text. A text that is null,
    empty or not what the entries' bytes spell has no ids.
    """
    shared = docs.sparkSession.sparkContext.broadcast(files)
    rows = docs.select(F.struct(*carried).alias("row"), F.col(text_col).cast("string").alias("text"))
    fields = rows.schema["row"].dataType.simpleString()

    def batch(row, texts) -> Iterator[dict]:
        pair = _pair(shared.value)
        a, b = zip(*(pair.ids(text.as_py()) for text in texts))
        yield {"row": row, "a": id_lists(a), "b": id_lists(b)}

    schema = f"row {fields}, a array<int>, b array<int>"
    return map_batches(rows, {"row": fields, "text": "string"}, batch, schema)


def count_pairs(tokens: DataFrame, files: Tokenizers) -> PairCounts:
    """Links by pair of ids in all of :func:`tokenize`'s rows.

    Each task sends its distinct pairs once. Their hash is made of the distinct pairs of all tasks; then a tree of
    groups of tasks adds up dense vectors of counts that the hash indexes, a few vectors per node. What reaches the
    driver, the pairs and the last vector, has an entry per pair of ids that meet, at most as many as both
    vocabularies have bytes.
    """
    spark = tokens.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(files)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for a, b in _batches(*batch.columns):
                pairs = np.unique(_align(_pair(shared.value), a, b).links, return_counts=True)
                total = _sum_by_key([pairs] if total is None else [total, pairs])
        keys, counts = total or (np.zeros(0, np.int64),) * 2
        for at in range(0, len(keys), _SLICE):
            columns = [pa.array([side[at : at + _SLICE]], pa.list_(pa.int64())) for side in (keys, counts)]
            yield pa.RecordBatch.from_arrays(columns, names=["keys", "counts"])

    sparse = tokens.select("a", "b").mapInArrow(count, "keys array<bigint>, counts array<bigint>")
    sparse = Staged(spark, "pairs")(sparse.select(F.spark_partition_id().alias("task"), "keys", "counts"), "pairs")
    distinct = sparse.select(F.explode("keys").alias("key")).distinct().toArrow()["key"].to_numpy()
    place = MinimalPerfectHash(np.sort(distinct))
    return PairCounts(place, _tree_sum(sparse, place), len(_pair(files).bytes_b))


def _tree_sum(sparse: DataFrame, place: MinimalPerfectHash) -> np.ndarray:
    """The counts of all tasks by place; a node of the tree adds up the vectors of a few tasks or nodes."""
    hashed = sparse.sparkSession.sparkContext.broadcast(place)

    def dense(table: pa.Table) -> pa.Table:
        vector = np.zeros(len(hashed.value.keys), np.int64)
        for keys, counts in zip(table["keys"], table["counts"]):
            vector[hashed.value(keys.values.to_numpy())] += counts.values.to_numpy()  # a row has each key once
        return pa.Table.from_batches([_slices(table["node"][0].as_py(), vector)])

    def added(table: pa.Table) -> pa.Table:
        total = sum(counts.values.to_numpy() for counts in table["counts"])
        row = {"node": table["node"][:1], "slice": table["slice"][:1]}
        return pa.table({**row, "counts": pa.array([total], pa.list_(pa.int64()))})

    def above(name: str) -> Column:
        return F.floor(F.col(name) / _BRANCHES).cast("int").alias("node")

    schema = "node int, slice int, counts array<bigint>"
    vectors = sparse.select(above("task"), "keys", "counts").groupBy("node").applyInArrow(dense, schema)
    nodes = (sparse.agg(F.max("task")).first()[0] or 0) // _BRANCHES
    while nodes:
        vectors = vectors.select(above("node"), "slice", "counts").groupBy("node", "slice").applyInArrow(added, schema)
        nodes //= _BRANCHES
    rows = {row["slice"]: row["counts"] for row in vectors.toArrow().to_pylist()}
    return np.concatenate([np.zeros(0, np.int64), *(np.array(rows[k], np.int64) for k in sorted(rows))])


def align(tokens: DataFrame, files: Tokenizers, counted: PairCounts) -> DataFrame:
    """The columns in ``row`` of each of :func:`tokenize`'s rows with its alignment and what its links count.

    ``n_a`` and ``n_b`` are the ids; where one of each side ends at the same byte a group ends (``n_groups``,
    ``groups`` as text), and these two are linked (``n_links``). ``count_sum`` adds up how often each link's pair is
    linked in the rows that ``counted`` is of, and ``n_best`` are the links whose pair is the most frequent of its
    second id, ties included. Without ids there are no groups and links.
    """
    shared = tokens.sparkSession.sparkContext.broadcast((files, counted))
    fields = tokens.schema["row"].dataType.simpleString()

    def batch(*columns) -> Iterator[dict]:
        files, own = shared.value
        pair = _pair(files)
        for row, a, b in _batches(*columns):
            found = _align(pair, a, b)
            count = own.counts[own.place(found.links)]
            n_links = found.per_text(np.ones(len(count), np.int64))
            yield {
                "row": row,
                "n_a": found.n_a,
                "n_b": found.n_b,
                "n_groups": n_links,  # an entry has bytes, so that only one of each side ends at a byte
                "n_links": n_links,
                "n_best": found.per_text(count == own.highest[found.b[found.met_b]]),
                "count_sum": found.per_text(count),
                "groups": found.groups(pair),
            }

    numbers = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint"
    kinds = {"row": fields, "a": "array<int>", "b": "array<int>"}
    out = map_batches(tokens, kinds, batch, f"row {fields}, {numbers}, groups string")
    return out.select("row.*", *out.columns[1:])


def align_corpus(docs: DataFrame, files: Tokenizers, *columns: Column, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``columns``, made of :func:`align`'s and ``id_col``, for each row, counted over all rows and stored.

    The ids are stored first, so that both passes, one that counts the pairs and one that looks them up, align the same
    ids and texts are split into tokens once. A batch of rows takes several times the texts' bytes on its way to a task
    and back, so fewer rows than usual go at once.
    """
    spark, rows = docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    staged = Staged(spark, "alignment")
    with settings(spark, {rows: str(min(_ROWS_AT_ONCE, int(spark.conf.get(rows))))}):
        tokens = staged(tokenize(docs, files, F.col(id_col), text_col=text_col), "tokens")
        found = staged(align(tokens, files, count_pairs(tokens, files)).select(*columns), "found")
    staged.drop("tokens")
    return found
