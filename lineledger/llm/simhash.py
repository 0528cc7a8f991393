"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineledger.llm.shared import Staged, connected_components, map_batches

_PIECE = 1 << 20  # bytes of a text that are split into words at once
_SPACES = b" \t\n\x0b\x0c\r"


def _pieces(data: bytes):
    """Words of ``data``, a bounded number at a time, so that a very long text needs little memory."""
    start = 0
    while start < len(data):
        end = start + _PIECE
        while end < len(data) and data[end] not in _SPACES:
            end += 1
        yield data[start:end].split()
        start = end


def simhash(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles of ``text``; a bit is set where over half the shingle hashes have it.

    A-Z is lower-cased, words are runs without ASCII white space, shingles count as often as they occur and are
    hashed by XXH64 with seed 42. Fewer words than a shingle make one shingle; no word makes zero.
    """
    if not text:
        return 0
    digest = xxhash.xxh64_intdigest
    total, sums, carried, hashed = 0, np.zeros(64, np.int64), [], False
    for words in _pieces(text.encode("utf-8", "surrogatepass").lower()):
        words = carried + words
        carried = words[max(0, len(words) - shingle + 1) :] if shingle > 1 else []
        n = len(words) - shingle + 1
        if n <= 0:
            continue
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = (ends - [len(w) + 1 for w in words])[:n].tolist()
        stops = (ends[shingle - 1 :] - 1).tolist()
        for at in range(0, n, 65536):
            h = [digest(joined[s:e], 42) for s, e in zip(starts[at : at + 65536], stops[at : at + 65536], strict=True)]
            bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            sums += bits.sum(axis=0, dtype=np.int64)
        total, hashed = total + n, True
    if not hashed:
        return digest(b" ".join(carried), 42) if carried else 0
    return int(np.packbits(2 * sums > total, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, beside: tuple[str, ...] = ()
) -> DataFrame:
    """``(id, beside, fp)``: the SimHash of each row's whole text as a signed 64-bit number; null texts give zero.

    ``beside`` are further columns of 64-bit numbers.
    """
    numbers = (id_col, *beside)

    def batch(texts, *own):
        values = [simhash(t.as_py(), shingle) for t in texts]
        yield dict(zip(numbers, own, strict=True)) | {"fp": np.array(values, np.uint64).view(np.int64)}

    kinds = {text_col: "string"} | {c: "bigint" for c in numbers}
    return map_batches(docs, kinds, batch, ", ".join(f"{c} bigint" for c in (*numbers, "fp")))


def ball(radius: int) -> list[int]:
    """All 64-bit masks with at most ``radius`` bits, as signed numbers."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(64), r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def variants(distinct: DataFrame, radius: int) -> DataFrame:
    """``(variant, fp)``: each fingerprint with everything within half the radius, rounded up."""
    masks = F.array(*(F.lit(m) for m in ball((radius + 1) // 2)))
    return distinct.select("fp", F.explode(F.transform(masks, lambda m: m.bitwiseXOR(F.col("fp")))).alias("variant"))


def _near(radius: int):
    return F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius


def ball_pairs(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Every pair ``(a, b)``, a < b, of distinct fingerprints at most ``radius`` bits apart, once.

    Two such fingerprints have a variant in common. A variant holds no more fingerprints than a ball of half the
    radius has points (65 for radius 2), however many rows there are, so no group grows with the data.
    """
    own = variants(distinct, radius)
    pairs = own.withColumnRenamed("fp", "a").join(own.withColumnRenamed("fp", "b"), "variant").where("a < b")
    return pairs.where(_near(radius)).select("a", "b").distinct()


def ball_chains(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Verified pairs that connect the same fingerprints as :func:`ball_pairs`, for an even radius.

    All fingerprints of a variant are within the radius of each other, so linking each with the next connects
    them all.
    """
    if radius % 2:
        return ball_pairs(distinct, radius)
    by_variant = Window.partitionBy("variant").orderBy("fp")
    chained = variants(distinct, radius).select(F.lag("fp").over(by_variant).alias("a"), F.col("fp").alias("b"))
    return chained.where(F.col("a").isNotNull() & _near(radius)).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """``(id, fingerprint, component_id)`` for each row: its SimHash in hex, and the smallest id reachable by links.

    Fingerprints at most ``radius`` bits apart are linked. Copies share a fingerprint and meet before the
    variants are made, so only distinct fingerprints are expanded, shuffled and linked. Null and empty texts and
    texts of spaces have fingerprint zero and are linked like any other. Rows with the same id stay separate rows;
    a null id is never a component id unless all of its component's ids are null.
    """
    staged = Staged(docs.sparkSession, "simhash")
    prints = staged(fingerprints(docs, id_col, text_col, shingle), "prints")
    labels = labelled(prints, id_col, radius, staged).drop("component")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(labels, "fp").select(id_col, hexed, "component_id")


def survivors(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row of each component: the one with the smallest id, then with the least text and other columns.

    Rows are told apart by their text as well as their id, so different texts that share an id or have none stay
    apart. A row without an id is kept only where its component has no id at all.
    """
    staged = Staged(docs.sparkSession, "survivors")
    hashes = {"__h1": F.xxhash64(text_col), "__h2": F.xxhash64(F.lit(1), F.col(text_col))}  # of two seeds
    hashed = docs.withColumns(hashes)
    prints = staged(fingerprints(hashed, id_col, text_col, shingle, tuple(hashes)), "prints")
    least = prints.join(labelled(prints, id_col, radius, staged), "fp").where(F.col(id_col).eqNullSafe(F.col("component_id")))
    least = staged(least.select(F.col(id_col).alias("__id"), *hashes, "component").distinct(), "least")
    same = hashed[id_col].eqNullSafe(least["__id"])
    for name in hashes:
        same = same & (hashed[name] == least[name])
    rest = F.struct(text_col, *(c for c in docs.columns if c not in (id_col, text_col))).alias("row")
    kept = hashed.join(least, same).groupBy("component", id_col).agg(F.min(rest).alias("row"))
    return kept.select(id_col, "row.*").select(*docs.columns)


def labelled(prints: DataFrame, id_col: str, radius: int, staged: Staged) -> DataFrame:
    """``(fp, component, component_id)`` for each distinct fingerprint: its component's and that one's smallest id."""
    classes = staged(prints.groupBy("fp").agg(F.min(id_col).alias("least_id")), "classes")
    links = staged(ball_chains(classes.select("fp"), radius), "links")
    found = staged(connected_components(links, "a", "b", staged), "components")
    member = classes.join(found, classes.fp == found.node, "left")
    member = member.select("fp", "least_id", F.coalesce("component", "fp").alias("component"))
    member = staged(member, "members")
    least = member.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return staged(member.join(least, "component").select("fp", "component", "component_id"), "labels")
