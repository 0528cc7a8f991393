"""A Bloom filter as a table: which rows of a large table can't match, told before they are shuffled."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_ID = 10  # with four bits set by each id, about one in eighty others passes
_BLOCK_BITS = 4096
_WORDS = _BLOCK_BITS // 64
_HASHES = 4
_BLOCK_BYTES = 8 * (_WORDS + 6)  # of a stored block with its key


def blocks_for(ids: int) -> int:
    return max(1, math.ceil(ids * BITS_PER_ID / _BLOCK_BITS))


def bloom_bytes(ids: int) -> int:
    """What the filter of so many ids takes."""
    return blocks_for(ids) * _BLOCK_BYTES


def _block(value: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(blocks)).cast("int")


def _bits(value: Column) -> list[Column]:
    """The places that an id has in its block; independent of which block that is."""
    spread = F.xxhash64(value, F.lit("place"))
    return [F.shiftright(spread, 12 * k).bitwiseAND(F.lit(_BLOCK_BITS - 1)).cast("int") for k in range(_HASHES)]


def bloom_filter(values: DataFrame, blocks: int) -> DataFrame:
    """``(block, words)`` of the first column of ``values``; a block is an array of 64-bit numbers.

    An id sets bits of a single block, so a block is all that a test needs. Bits are merged before the shuffle, and a
    block never has more than its fixed number of words. Nulls set nothing.
    """
    value = F.col(values.columns[0])
    bits = values.dropna().select(_block(value, blocks).alias("block"), F.explode(F.array(*_bits(value))).alias("bit"))
    word = F.floor(F.col("bit") / 64).cast("int")
    mask = F.expr("shiftleft(1L, bit % 64)")
    words = bits.groupBy("block", word.alias("word")).agg(F.bit_or(mask).alias("bits"))
    by_word = F.map_from_entries(F.collect_list(F.struct("word", "bits")))
    filled = F.transform(F.sequence(F.lit(0), F.lit(_WORDS - 1)), lambda k: F.coalesce(by_word[k], F.lit(0).cast("bigint")))
    return words.groupBy("block").agg(filled.alias("words"))


def maybe_in(rows: DataFrame, column: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """``rows`` without most of those whose ``column`` is not in the filter, and with all whose is.

    A semi-join with the broadcast filter, so that rows are dropped where they are read; the caller checks its size.
    """
    value = F.col(column)
    same = _block(value, blocks) == F.col("block")
    for bit in _bits(value):
        same &= _bit_of(F.col("words"), bit)
    return rows.join(F.broadcast(bloom), same, "left_semi")


def _bit_of(words: Column, bit: Column) -> Column:
    word = F.get(words, F.shiftright(bit, 6))
    one = F.lit(1).cast("bigint")
    return F.call_function("shiftrightunsigned", word, bit.bitwiseAND(F.lit(63))).bitwiseAND(one) == one
