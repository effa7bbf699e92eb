"""A filter of fixed size for large keys: rows that a join surely drops are dropped before its shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the bits: 2^14 integers of 64 bits, 128 kB, whatever the filter stands for. A full one costs time, not results.
BITS = 20


def bitmap_of(hashes: DataFrame, col: str, bits: int = BITS) -> Column:
    """Literal array of the low ``bits`` bits of 64-bit hashes, for :func:`in_bitmap`.

    Runs a job. Only integers with a bit set come to the driver, at most 2^bits / 64 of them.
    """
    slot = F.col(col).bitwiseAND(F.lit((1 << bits) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    rows = hashes.select(F.shiftright(slot, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()
    table = ["0"] * (1 << bits >> 6)
    for r in rows:
        table[r.word] = str(r.bits)
    return F.split(F.lit(",".join(table)), ",").cast("array<bigint>")


def in_bitmap(hash_: Column, bitmap: Column, bits: int = BITS) -> Column:
    """False only for hashes that the bitmap surely lacks."""
    slot = hash_.bitwiseAND(F.lit((1 << bits) - 1))
    word = F.get(bitmap, F.shiftright(slot, 6).cast("int"))
    return F.call_function("shiftright", word, slot.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1
