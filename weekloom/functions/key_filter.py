"""A filter of keys that grows with their number: rows that a join surely drops go before its shuffle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each key, and log2 of the bits of a piece and of the largest filter: 2^28 bits are 8,192 pieces of 4 kB, 32 MB in all.
PER_KEY, PIECE_BITS, MOST_BITS = 16, 15, 28


def filter_bits(n: int, most: int = MOST_BITS) -> int:
    """log2 of the bits for ``n`` keys; a filter at its bound lets more rows pass, never fewer."""
    return min(most, max(PIECE_BITS, (PER_KEY * n - 1).bit_length() if n > 0 else 0))


@dataclass(frozen=True)
class KeyFilter:
    """Pieces (piece, words) of a bitmap over hashed keys; at most 2^(bits - 15) rows of 4 kB."""

    pieces: DataFrame
    bits: int

    def passes(self, df: DataFrame, *cols: str | Column) -> DataFrame:
        """``df`` without rows whose key is surely not among the filter's; about one foreign row in 16 passes.

        The pieces are broadcast: their size is bounded by ``bits`` whatever the keys are.
        """
        slot = _slot(cols, self.bits)
        names = [F.col(f"`{c}`") for c in df.columns]
        rows = df.withColumn("__slot", slot).withColumn("__piece", F.shiftright("__slot", PIECE_BITS))
        word = F.get("__words", F.shiftright(F.col("__slot").bitwiseAND(F.lit((1 << PIECE_BITS) - 1)), 6).cast("int"))
        bit = F.call_function("shiftright", word, F.col("__slot").bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1).cast("long"))
        return rows.join(F.broadcast(self.pieces), "__piece").filter(bit == 1).select(names)


def _slot(cols: tuple, bits: int) -> Column:
    return F.xxhash64(*cols).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def key_filter(keys: DataFrame, *cols: str | Column, most_bits: int = MOST_BITS, n: int | None = None) -> KeyFilter:
    """The filter of the keys in ``cols``; it counts them unless ``n`` is given.

    Null keys hash like any other value. No key gives a filter that nothing passes.
    """
    bits = filter_bits(keys.count() if n is None else n, most_bits)
    slot = _slot(cols, bits)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__slot").bitwiseAND(F.lit(63)).cast("int"))
    within = F.shiftright(F.col("__slot").bitwiseAND(F.lit((1 << PIECE_BITS) - 1)), 6)
    words = (keys.select(slot.alias("__slot")).groupBy(F.shiftright("__slot", PIECE_BITS).alias("__piece"), within.cast("int").alias("__word"))
             .agg(F.bit_or(bit).alias("__bits")))
    set_words = words.groupBy("__piece").agg(F.map_from_entries(F.collect_list(F.struct("__word", "__bits"))).alias("__set"))
    every = F.sequence(F.lit(0), F.lit((1 << PIECE_BITS - 6) - 1))
    return KeyFilter(set_words.select("__piece", F.transform(every, lambda i: F.coalesce(F.try_element_at("__set", i), F.lit(0).cast("long"))).alias("__words")), bits)
