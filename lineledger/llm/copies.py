"""Which keyed spans of a document also occur in a document with a smaller id.

Substring operators cut documents into spans with a content key and ask which of them an earlier document has too.
There are many small spans, so a batch of documents is sorted by key in numpy, settles what it can by itself, and
ships the rest as compressed columns: one block for each range of keys. Spark groups the blocks by range and every
range is sorted and settled in one task. For each key a batch ships the spans of its first document only, so a
passage that very many documents share arrives once per batch, however many documents have it.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineledger.llm.shared import map_batches, spark_to_arrow

KEYED, COVERED, EDGE, MARK, CROWDED = range(5)
MANY = 4096  # different spans of one first key in all, beyond which they count as crowded
_AT_ONCE = 8 << 20  # bytes of texts that are cut and sorted at once
_LAST = np.iinfo(np.int64).max  # stands for a null id, which comes after all others
CODEC = pa.Codec("zstd", 1)
_KINDS = {"k1": "<u8", "k2": "<u4", "doc": "<u4", "start": "<u4", "size": "<u4", "kind": "u1"}
SPANS = "id bigint, text_hash bigint, kind tinyint, starts array<int>, sizes array<int>"


@dataclass
class Entries:
    """Spans ``[start, start + size)`` of documents; ``doc`` points into ids and hashes.

    The key is ``k1`` and ``k2``; spans with the same key are copies. Where many different spans share ``k1``, as in a
    bucket, ``k2`` alone tells them apart and has 64 bits, else 32.
    """

    ids: np.ndarray
    hashes: np.ndarray
    k1: np.ndarray
    k2: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    size: np.ndarray
    kind: np.ndarray

    def take(self, chosen: np.ndarray, **changed) -> Entries:
        rest = {n: getattr(self, n)[chosen] for n in _KINDS if n not in changed}
        return Entries(self.ids, self.hashes, **rest, **changed)


def entries(ids, hashes, doc, k1, k2, start, size) -> Entries:
    return Entries(ids, hashes, k1, k2, doc, start, size, np.zeros(len(k1), np.uint8))


def joined(blocks: list[Entries]) -> Entries:
    before = np.cumsum([0, *(len(b.ids) for b in blocks)])
    columns = {n: np.concatenate([getattr(b, n) for b in blocks]) for n in _KINDS if n != "doc"}
    doc = np.concatenate([b.doc.astype(np.int64) + n for b, n in zip(blocks, before, strict=False)])
    return Entries(np.concatenate([b.ids for b in blocks]), np.concatenate([b.hashes for b in blocks]), doc=doc, **columns)


def pack(e: Entries) -> bytes:
    """Compressed columns, byte plane by byte plane; keys as differences, so they should be in order."""
    used, doc = np.unique(e.doc, return_inverse=True)
    columns = [e.ids[used], e.hashes[used], np.diff(e.k1, prepend=np.uint64(0)), e.k2, doc, e.start, e.size, e.kind]
    raw, kinds = b"", _KINDS | {"k2": f"<u{e.k2.itemsize}"}
    for values, kind in zip(columns, ["<i8", "<i8", *kinds.values()], strict=True):
        flat = np.ascontiguousarray(values, dtype=kind)
        raw += flat.view(np.uint8).reshape(len(flat), flat.itemsize).T.tobytes()
    packed = CODEC.compress(raw, asbytes=True)
    return struct.pack("<IIIB", len(used), len(doc), len(raw), e.k2.itemsize) + packed


def unpack(block: bytes) -> Entries:
    docs, n, size, wide = struct.unpack_from("<IIIB", block)
    raw = np.frombuffer(CODEC.decompress(block[13:], decompressed_size=size, asbytes=True), np.uint8)
    out, at, kinds = [], 0, _KINDS | {"k2": f"<u{wide}"}
    for kind, length in zip(["<i8", "<i8", *kinds.values()], [docs, docs] + [n] * len(_KINDS), strict=True):
        width = np.dtype(kind).itemsize
        planes = raw[at : at + width * length].reshape(width, length)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(length))
        at += width * length
    out[2] = np.cumsum(out[2], dtype=np.uint64)
    return Entries(*out[:2], **dict(zip(_KINDS, out[2:], strict=True)))


def settled(e: Entries) -> tuple[Entries, np.ndarray]:
    """The entries by key and id, and which of them an entry of a smaller id with the same key precedes."""
    ids = e.ids[e.doc]
    e = e.take(np.lexsort((ids, e.k2, e.k1)))
    ids = e.ids[e.doc]
    if not len(ids):
        return e, np.zeros(0, bool)
    new = np.r_[True, (e.k1[1:] != e.k1[:-1]) | (e.k2[1:] != e.k2[:-1])]
    first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    return e, ids > ids[first]


def _per_group(group: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """For each row, how many marked rows its group has; rows of a group follow each other."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    return np.repeat(np.add.reduceat(marked.astype(np.int64), starts), np.diff(np.r_[starts, len(group)]))


def _spread_over(hashes: np.ndarray) -> np.ndarray:
    return hashes.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def ship(e: Entries, crowd: int | None) -> Iterator[Entries]:
    """What a batch sends on: settled spans go by document, the others by key.

    With ``crowd``, a first key that more than that many different spans of the batch share is not sent span by
    span: its spans are crowded edges at once, and one mark tells the spans of other batches to become that too.
    """
    e, covered = settled(e)
    by_doc = [e.take(covered, kind=np.full(covered.sum(), COVERED, np.uint8))]
    e = e.take(~covered)
    if crowd is not None and len(e.k1):
        new = np.r_[True, (e.k1[1:] != e.k1[:-1]) | (e.k2[1:] != e.k2[:-1])]
        many = _per_group(e.k1, new) > crowd
        by_doc.append(e.take(many, kind=np.full(many.sum(), CROWDED, np.uint8)))
        first = many & np.r_[True, e.k1[1:] != e.k1[:-1]]
        marks = e.take(first, kind=np.full(first.sum(), MARK, np.uint8), k2=np.zeros(first.sum(), e.k2.dtype))
        yield e.take(~many)
        yield marks
    else:
        yield e
    for out in by_doc:
        yield out.take(slice(None), k1=_spread_over(out.hashes[out.doc]), k2=np.zeros(len(out.k1), np.uint32))


def range_slices(parts: int, k1: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The range of keys of each stretch of ``k1``, which is in order."""
    if not len(k1):
        return
    part = (((k1 >> np.uint64(40)) * np.uint64(parts)) >> np.uint64(24)).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    for a, b in zip(starts, [*starts[1:], len(part)], strict=True):
        yield int(part[a]), slice(int(a), int(b))


def blocks_by_range(parts: int, shipped: Iterator[Entries]) -> Iterator[tuple[int, bytes]]:
    for e in shipped:
        e = e.take(np.argsort(e.k1, kind="stable"))
        for part, chosen in range_slices(parts, e.k1):
            yield part, pack(e.take(chosen))


def outcome(e: Entries, refine: bool) -> Entries:
    """Covered spans of a range of keys and, with ``refine``, the edges.

    An edge is the first span of its key, where the first half of the key also occurs with another second half:
    the span as a whole is nobody's copy, but a part of it may be. Edges of a first key with very many of them are
    crowded.
    """
    passed = e.take((e.kind == COVERED) | (e.kind == CROWDED))
    marked = np.unique(e.k1[e.kind == MARK])
    e, covered = settled(e.take(e.kind == KEYED))
    out = [passed, e.take(covered, kind=np.full(covered.sum(), COVERED, np.uint8))]
    if refine and len(e.k1):
        new = np.r_[True, (e.k1[1:] != e.k1[:-1]) | (e.k2[1:] != e.k2[:-1])]
        spans = _per_group(e.k1, new)
        crowded = np.isin(e.k1, marked) | (spans > MANY)
        edge = ((spans > 1) | crowded) & ~covered
        out.append(e.take(edge, kind=np.where(crowded[edge], CROWDED, EDGE).astype(np.uint8)))
    return joined(out)


def _runs(e: Entries) -> Entries:
    """Covered spans of a document that overlap or touch, put together; other kinds as they are."""
    covered = e.take(e.kind == COVERED)
    far = covered.doc.astype(np.int64) << 33
    first, last = union_of(far + covered.start, far + covered.start + covered.size)
    doc = (first >> 33).astype(np.int64)
    start, size = (first - (doc << 33)).astype(np.uint32), (last - first).astype(np.uint32)
    none = np.zeros(len(doc), np.uint64)
    runs = Entries(e.ids, e.hashes, none, none.astype(np.uint32), doc, start, size, np.full(len(doc), COVERED, np.uint8))
    rest = e.take(e.kind != COVERED)
    return Entries(e.ids, e.hashes, **{n: np.concatenate([getattr(runs, n), getattr(rest, n)]) for n in _KINDS})


def as_rows(e: Entries) -> list[pa.Array]:
    """Columns of one row per document and kind, with the lists of its spans."""
    e = _runs(e)
    order = np.lexsort((e.start, e.doc, e.kind))
    kind, doc = e.kind[order], e.doc[order].astype(np.int64)
    new = np.r_[True, (kind[1:] != kind[:-1]) | (doc[1:] != doc[:-1])] if len(doc) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    offsets = pa.array(np.r_[starts, len(doc)].astype(np.int32))
    ids = e.ids[doc[starts]]
    spans = [pa.ListArray.from_arrays(offsets, pa.array(v[order].astype(np.int32))) for v in (e.start, e.size)]
    columns = [pa.array(ids, mask=ids == _LAST), pa.array(e.hashes[doc[starts]]), pa.array(kind[starts].astype(np.int8))]
    return columns + spans


def documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, text, text_hash)``; id and hash tell apart rows that share an id. A null text is an empty one."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("id"), text.alias("text")).select(
        "id", "text", F.xxhash64("text").alias("text_hash")
    )


def parts_for(rows: int, spans_per_part: int = 1 << 20, least: int = 64) -> int:
    """Ranges of keys, so that a task sorts about a million spans whatever the input's size."""
    return max(least, -(-rows // spans_per_part))


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).cast("bigint")).first()[0]


def in_pieces(ids, texts, hashes) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]]:
    """``(ids, hashes, texts, rows)`` of a batch, a bounded number of bytes at a time; equal rows come once."""
    ids, hashes = np.asarray(ids.fill_null(_LAST), np.int64), np.asarray(hashes, np.int64)
    keep = np.unique(np.c_[ids, hashes], axis=0, return_index=True)[1] if len(ids) else np.zeros(0, np.int64)
    data, first, size = [], 0, 0
    for k, row in enumerate(keep.tolist()):
        data.append(texts[row].as_py().encode("utf-8", "surrogatepass"))
        size += len(data[-1])
        if k + 1 == len(keep) or size >= _AT_ONCE:
            own = keep[first : k + 1]
            yield ids[own], hashes[own], data, own
            data, first, size = [], k + 1, 0


def earlier_copies(
    docs: DataFrame, cut: Callable[[list[bytes]], tuple], parts: int, crowd: int | None = None
) -> DataFrame:
    """Rows of :data:`SPANS`: covered spans per document and, where ``crowd`` is given, edges.

    ``cut(texts as bytes)`` gives ``(doc, k1, k2, start, size)`` arrays. Rows with equal id and text count once. A
    span is covered if a document with a smaller id has its key; null ids are last.
    """

    def blocks(ids, texts, hashes):
        for own_ids, own_hashes, data, _ in in_pieces(ids, texts, hashes):
            yield from blocks_by_range(parts, ship(entries(own_ids, own_hashes, *cut(data)), crowd))

    def settle(blocks: list[bytes]) -> Entries:
        return outcome(joined([unpack(b) for b in blocks]), crowd is not None)

    return settle_by_range(docs, {"id": "bigint", "text": "string", "text_hash": "bigint"}, blocks, settle)


def settle_by_range(
    docs: DataFrame,
    columns: dict[str, str],
    blocks: Callable[..., Iterator[tuple[int, bytes]]],
    settle: Callable[[list[bytes]], Entries],
) -> DataFrame:
    """Ships the blocks of each batch to the task of their range, which gives its entries' rows of :data:`SPANS`."""

    def batch(*values):
        pairs = list(blocks(*values))
        yield {"part": [p for p, _ in pairs], "block": [b for _, b in pairs]}

    def of_range(table: pa.Table) -> pa.Table:
        return pa.Table.from_arrays(as_rows(settle(table.column("block").to_pylist())), schema=fields)

    fields = spark_to_arrow(docs.sparkSession, SPANS)
    shipped = map_batches(docs, columns, batch, "part int, block binary")
    return shipped.groupBy("part").applyInArrow(of_range, SPANS)


def union_of(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping and touching spans joined into maximal ones, in order."""
    if not len(starts):
        return starts, stops
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    new = np.r_[True, starts[1:] > reach[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(starts) - 1]
    return starts[new], reach[last]


def spans_by_document(spans: DataFrame) -> DataFrame:
    """``(id, text_hash, starts, sizes)``: the lists of all ranges of keys put together."""
    together = (F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "sizes"))
    return spans.groupBy("id", "text_hash").agg(*together)


def with_spans(docs: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    own = spans.withColumnsRenamed({"id": "__id", "text_hash": "__hash"})
    same = docs["id"].eqNullSafe(own["__id"]) & (docs["text_hash"] == own["__hash"])
    return docs.join(own, same, how).drop("__id", "__hash")
