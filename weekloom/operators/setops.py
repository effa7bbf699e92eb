"""Unions, differences and set-like merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.schema import BASE_COLUMNS


def append_sources(*dfs: DataFrame) -> DataFrame:
    """All rows of all sources, matched by column name, absent columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


#: log2 of the leaves of a fingerprint tree, and of the children of a node.
LEAF_BITS, FAN_BITS = 16, 8


def _row_hashes(columns: list[str]) -> list[Column]:
    """Two independent 64-bit hashes of a row; a null differs from every value and from its absence."""
    parts = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(F.lit(seed), *parts).cast("decimal(20,0)") for seed in (1, 2)]


def _sums(sign: Column | None = None) -> list[Column]:
    one = F.lit(1).cast("decimal(20,0)") if sign is None else sign
    return [F.sum(one.cast("bigint")).alias("rows"), F.sum(F.col("_h1") * one).cast("decimal(38,0)").alias("h1"), F.sum(F.col("_h2") * one).cast("decimal(38,0)").alias("h2")]


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row (rows, fingerprint): the same for the same multiset of rows, whatever their order; one map-side aggregate.

    Sums of two 64-bit hashes, as exact decimals, so fingerprints of parts can be added up.
    """
    h1, h2 = _row_hashes(columns or df.columns)
    sums = df.select(h1.alias("_h1"), h2.alias("_h2")).agg(*_sums())
    text = F.concat_ws(":", F.coalesce("rows", F.lit(0)).cast("string"), F.coalesce("h1", F.lit(0)).cast("string"), F.coalesce("h2", F.lit(0)).cast("string"))
    return sums.select(F.coalesce("rows", F.lit(0)).alias("rows"), text.alias("fingerprint"))


def _leaf(by: list[str], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*[x for c in by for x in (F.col(c).isNull(), F.col(c))]), 64 - bits).cast("int")


def fingerprint_tree(df: DataFrame, columns: list[str], by: list[str] | None = None, bits: int = LEAF_BITS) -> DataFrame:
    """(level, node, rows, h1, h2): fingerprints of ranges of the hashed ``by`` columns (default: the whole row).

    Level 0 is the root, each level below has 2^8 times the nodes; the last one has 2^``bits`` leaves. A stored tree
    stands for its table in later comparisons. ``df`` is read once and shrinks to the leaves in the map task.
    """
    h1, h2 = _row_hashes(columns)
    leaves = df.select(_leaf(by or columns, bits).alias("leaf"), h1.alias("_h1"), h2.alias("_h2")).groupBy("leaf").agg(*_sums())
    levels = F.explode(F.array(*[F.struct(F.lit(i).alias("level"), F.shiftright("leaf", max(0, bits - FAN_BITS * i)).alias("node")) for i in range(-(-bits // FAN_BITS) + 1)]))
    rows = leaves.select(levels.alias("l"), F.col("rows").alias("_n"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"))
    return rows.groupBy("l.level", "l.node").agg(F.sum("_n").alias("rows"), F.sum("_h1").cast("decimal(38,0)").alias("h1"), F.sum("_h2").cast("decimal(38,0)").alias("h2"))


def changed_ranges(a: DataFrame, b: DataFrame) -> DataFrame:
    """(level, node) of the nodes in which two trees of the same form differ; the leaves are those of the highest level."""
    def signed(tree: DataFrame, sign: int) -> DataFrame:
        return tree.select("level", "node", *[(F.col(c) * F.lit(sign)).alias(c) for c in ("rows", "h1", "h2")])
    both = signed(a, 1).unionByName(signed(b, -1)).groupBy("level", "node").agg(*[F.sum(c).alias(c) for c in ("rows", "h1", "h2")])
    return both.filter((F.col("rows") != 0) | (F.col("h1") != 0) | (F.col("h2") != 0)).select("level", "node")


def preservation_check(before: DataFrame, after: DataFrame, columns: list[str] = BASE_COLUMNS, by: list[str] | None = None,
                       changed: DataFrame | None = None, bits: int = LEAF_BITS) -> DataFrame:
    """Rows that were lost or appeared between two versions of the base columns, with the number of copies.

    Both inputs are first summed up by ranges of the hashed ``by`` columns (default: the whole row) in the map task;
    only rows of ranges that differ are then compared, so equal inputs are read once and shuffle nothing but sums.
    ``changed`` (node) gives those ranges if trees of the inputs were compared already.
    """
    by = by or columns
    sides = [(before, 1), (after, -1)]

    def tagged(hashed: bool) -> DataFrame:
        h1, h2 = _row_hashes(columns)
        parts = [df.select(*columns).select(*columns, _leaf(by, bits).alias("_leaf"), *([h1.alias("_h1"), h2.alias("_h2")] if hashed else []), F.lit(sign).alias("_side")) for df, sign in sides]
        return parts[0].unionByName(parts[1])
    if changed is None:
        sums = tagged(True).groupBy("_leaf").agg(*_sums(F.col("_side").cast("decimal(20,0)")))
        leaves = sums.filter((F.col("rows") != 0) | (F.col("h1") != 0) | (F.col("h2") != 0)).select("_leaf")
    else:
        leaves = changed.select(F.col("node").alias("_leaf")).distinct()
    # at most 2^bits leaves
    rows = tagged(False).join(F.broadcast(leaves), "_leaf")
    diff = rows.groupBy(*columns).agg(F.sum("_side").alias("_d")).filter(F.col("_d") != 0)
    return (diff.withColumns({"change": F.when(F.col("_d") > 0, F.lit("lost")).otherwise(F.lit("added")),
                              "copies": F.abs(F.col("_d"))}).drop("_d"))


def distinct_entities(df: DataFrame, key: str = "channel") -> DataFrame:
    return df.select(key).distinct()


def merge_flags(a: DataFrame, b: DataFrame, key: str = "channel", flags: str = "validation_flags") -> DataFrame:
    """Per entity the union of both flag sets and what each side alone carries."""
    empty = F.array().cast("array<string>")
    rows = a.select(key, F.col(flags).alias("_a")).join(b.select(key, F.col(flags).alias("_b")), key, "full")
    x, y = F.coalesce("_a", empty), F.coalesce("_b", empty)
    return rows.select(key, F.sort_array(F.array_union(x, y)).alias(flags), F.sort_array(F.array_except(x, y)).alias("only_a"),
                       F.sort_array(F.array_except(y, x)).alias("only_b"))


def split_complete_incomplete(df: DataFrame, entities: DataFrame, key: str = "channel") -> tuple[DataFrame, DataFrame]:
    """Panel rows of fully enriched entities, and of all others (unknown entities included)."""
    good = entities.filter(F.col("processing_status") == "enriched").select(key)
    return df.join(good, key, "left_semi"), df.join(good, key, "left_anti")
