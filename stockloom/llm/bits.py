"""A bit table of hashes: of fixed size, and it never denies a hash that is in it.

It spares a shuffle of what can't find a partner in a join. The join behind it stays exact. If the
table fills up, with more than some millions of hashes, it lets more through and spares less.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 22  #: 2**22 bits, half a megabyte


def bit_table(hashes: DataFrame, bits: int = BITS) -> np.ndarray:
    """Table of the longs in the only column of ``hashes``; nulls are ignored.

    Words of 32 bits are put together by Spark; at most ``2**(bits - 5)`` of them reach the driver.
    """
    words = _words(hashes, bits, 5).toArrow()
    table = np.zeros(1 << (bits - 5), np.uint32)
    table[words.column(0).to_numpy()] = words.column(1).to_numpy().astype(np.uint32)
    return table


def _words(hashes: DataFrame, bits: int, size: int) -> DataFrame:
    """word, bits: the words of 2**size bits that aren't empty."""
    slot = F.shiftrightunsigned(F.col(hashes.columns[0]), 64 - bits).alias("slot")
    return (
        hashes.where(F.col(hashes.columns[0]).isNotNull())
        .select(slot)
        .groupBy(F.shiftright("slot", size).alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(slot & {(1 << size) - 1} as int))")).alias("bits"))
    )


def among(value: Column, hashes: DataFrame, bits: int = BITS) -> Column:
    """Whether the long ``value`` may be one of ``hashes``, by built-in functions; null: no.

    ``2**(bits - 6)`` numbers pass the driver.
    """
    words = [0] * (1 << (bits - 6))
    for word, held in _words(hashes, bits, 6).collect():
        words[word] = held
    table = hashes.sparkSession.createDataFrame([(words,)], "bits array<bigint>").scalar()
    slot = F.shiftrightunsigned(value, 64 - bits)
    word = F.element_at(table, F.shiftright(slot, 6).cast("int") + 1)
    bit = F.call_function("shiftrightunsigned", word, slot.bitwiseAND(F.lit(63)).cast("int"))
    return F.coalesce(bit.bitwiseAND(F.lit(1).cast("bigint")) == 1, F.lit(False))


def holds(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = len(table).bit_length() - 1 + 5
    slot = hashes.view(np.uint64) >> np.uint64(64 - bits)
    return (table[slot >> np.uint64(5)] >> (slot & np.uint64(31)).astype(np.uint32)) & np.uint32(1) == 1
