"""Mixing sources to target weights.

Method: aggregate sizes per source, share the wanted total by weight, derive each source's repetition
rate, and emit every document floor(rate) times plus one Bernoulli copy whose coin is a hash of the
document id, with the rate's fraction as probability. Only DataFrame functions.

The corpus is read by one aggregate and one map-side join with the per-source table; documents are
not shuffled unless that table is too large to broadcast, in which case adaptive execution splits a hot
source's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.llm.common import stored, unused, word_count

WEIGHTS = (5, 2, 1)


def source_sizes(docs: DataFrame, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(source, source_size): words of each source, null being a source of its own; one row for each source."""
    return (docs.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
            .groupBy("source").agg(F.sum("size").alias("source_size")))


def cycled_weights(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Weights dealt in turn to the sources in code point order, null last.

    The window runs over one row for each source, never over documents.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int")))


def targets(weighted: DataFrame, share: float = 1.5, max_rate: float = 2.0) -> DataFrame:
    """Adds ``target``: ``share`` times all words dealt by weight, no source above ``max_rate`` times its size.

    What a source cannot take is dealt again among the rest by weight until none is above its bound.
    Each round caps at least one source; a round is one aggregate over the per-source table.
    """
    table = weighted.withColumn("bound", F.col("source_size") * F.lit(float(max_rate)))
    total = (table.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) >= F.col("bound")
        row = table.agg(F.count(F.when(over, 1)).alias("n"), F.coalesce(F.sum(F.when(over, F.col("bound"))), F.lit(0.0)).alias("full"),
                        F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)).alias("open")).first() if level else None
        n, full, open_weight = (row.n, row.full, row.open) if row else (0, 0.0, table.agg(F.sum("weight")).first()[0] or 0.0)
        if n == capped or not open_weight:
            break
        capped, level = n, (total - full) / open_weight
        if not level:
            break
    return table.withColumn("target", F.least(F.col("weight") * F.lit(float(level)), F.col("bound"))).drop("bound")


def coin(id_col: Column, text_col: Column, seed: int = 0) -> Column:
    """A number in [0, 1) from the first 52 bits of the MD5 of ``seed:id``, or of the text's MD5 where the id is null; the same in every run."""
    name = F.coalesce(id_col.cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(text_col, F.lit("")).cast("binary"))))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), name))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mixed(docs: DataFrame, weighted: DataFrame | None = None, share: float = 1.5, max_rate: float = 2.0, seed: int = 0, id_col: str = "doc_id",
          text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with mix_size, mix_source_size, mix_target, mix_copies.

    ``weighted``(source, source_size, weight) defaults to the cycled weights over the sizes of ``docs``.

    Defined results: a null text has size 0; null is a source of its own; a source without words has
    target 0 and its documents 0 copies; documents without an id toss by their text, repeated ids the same coin; no document gets more than
    ceil(max_rate) copies; an empty table gives no rows. Existing columns of the new names are replaced.
    """
    if weighted is None:
        weighted = cycled_weights(stored(source_sizes(docs, source_col, text_col), "sizes"))
    source_name = unused("__source", docs)
    plan = stored(targets(stored(weighted, "weights"), share, max_rate), "targets").select(
        F.col("source").alias(source_name), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"))
    rate = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(0.0)
    copies = F.floor(rate) + (coin(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), seed) < rate - F.floor(rate)).cast("long")
    base = docs.drop("mix_source_size", "mix_target", "mix_copies").withColumn("mix_size", word_count(F.col(f"`{text_col}`")))
    return (base.join(plan, F.col(f"`{source_col}`").eqNullSafe(F.col(source_name))).drop(source_name)
            .withColumn("mix_copies", F.least(copies, F.ceil(F.lit(float(max_rate)))).cast("long")))


def emitted(mix: DataFrame) -> DataFrame:
    """Every document as often as the mix takes it, without the mixing columns."""
    copy = unused("__copy", mix)
    return (mix.filter("mix_copies > 0").withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))))
            .drop(copy, "mix_size", "mix_source_size", "mix_target", "mix_copies"))
