"""Exact group quantiles that hold when one group carries most of the rows.

The sketch of a group is a histogram over buckets of the value's logarithm, eight for each power of two, with count,
least and greatest value of each bucket. Sketches of parts are added up bucket by bucket, so they can be kept and
extended. A quantile's rank falls into one bucket; its exact value is found by counting again inside of that
bucket only, in finer and finer equal parts, until what is left is small enough to be ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.session import cut_lineage

_PER_POWER, _OFFSET = 8, 8 * 1100         # doubles lie between 2^-1074 and 2^1024
_PARTS = 1 << 12                          # parts into which a bucket is cut in a round
_LIMIT = 1 << 16                          # rows of a group that are ordered at last


def bucket_of(value: Column) -> Column:
    """Order-preserving bucket of a double: a bucket is some 9 % wide; NaN comes last."""
    step = F.floor(F.log2(F.abs(value)) * _PER_POWER).cast("int") + 1 + _OFFSET
    far = F.lit(_OFFSET * 3)
    size = F.when(F.isnan(value), far + 1).when(F.abs(value) == float("inf"), far).when(value == 0, F.lit(0)).otherwise(step)
    return F.when(value < 0, -size).otherwise(size)


def quantile_cells(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The sketch of each group: (keys, bucket, n, lo, hi). Combined in the map task; a group has some thousand buckets at most."""
    v = F.col(value).cast("double")
    return (df.filter(v.isNotNull()).groupBy(*keys, bucket_of(v).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi")))


def merge_cells(*parts: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of several parts of the rows as one."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def _ranks(p: float) -> Column:
    pos = (F.col("_total") - 1) * F.lit(float(p))
    return F.array(F.struct(F.lit(0).alias("which"), F.floor(pos).alias("rank")), F.struct(F.lit(1).alias("which"), F.ceil(pos).alias("rank")))


def _chosen(cells: DataFrame, keys: list[str], rank: Column) -> DataFrame:
    """Of the counted parts (keys, _part, n, lo, hi) the one that holds the rank, with the rank inside of it."""
    w = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    rows = cells.withColumn("_end", F.sum("n").over(w)).withColumn("_rank", rank)
    return rows.filter((F.col("_rank") < F.col("_end")) & (F.col("_rank") >= F.col("_end") - F.col("n"))).withColumn("rank", F.col("_rank") - (F.col("_end") - F.col("n")))


def approx_quantile(cells: DataFrame, keys: list[str], p: float = 0.5, out: str = "quantile") -> DataFrame:
    """The quantile of each group from its sketch alone: between the least and greatest value of the right bucket."""
    total = F.sum("n").over(Window.partitionBy(*keys))
    rows = cells.withColumn("_total", total).withColumn("_part", F.col("bucket"))
    one = _chosen(rows, keys, F.floor((F.col("_total") - 1) * F.lit(float(p))))
    return one.select(*keys, (F.col("lo") + (F.col("hi") - F.col("lo")) / 2).alias(out))


def exact_quantile(df: DataFrame, keys: list[str], value: str, p: float = 0.5, out: str = "quantile", spread: list[str] | None = None,
                   salts: int = 32, cells: DataFrame | None = None, limit: int = _LIMIT) -> DataFrame:
    """Linear-interpolated quantile per group, one row per group.

    ``df`` is read once for the sketch, unless its ``cells`` are given, and once for each round of counting; store it
    first if it is costly. Rounds go on until no group has more than ``limit`` rows left beside its rank, or all of
    those are equal: one round for groups of some hundred thousand rows, and never more than values have digits.
    Only then values are ordered, at most ``limit`` of a group. Before, tasks hold counts.
    ``spread`` names columns that tell the rows of a group apart; their hash cuts a hot group into ``salts`` join keys.
    """
    v = F.col(value).cast("double")
    rows = df.select(*keys, v.alias("_v"), F.pmod(F.xxhash64(value, *(spread or [])), F.lit(salts)).alias("_salt")).filter(F.col("_v").isNotNull())
    cells = quantile_cells(rows, keys, "_v") if cells is None else cells
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    group = [f"_k{i}" for i in range(len(keys))]
    # null keys are groups too
    same = F.lit(True)
    for k in group:
        same = same & F.col(k).eqNullSafe(F.col(f"_r{k}"))
    rows = rows.select(*[c.alias(f"_r{g}") for c, g in zip([F.col(k) for k in keys], group)], "_v", "_salt")
    total = cells.withColumn("_total", F.sum("n").over(Window.partitionBy(*keys)))
    asked = total.select(*named, F.col("bucket").alias("_part"), "n", "lo", "hi", F.explode(_ranks(p)).alias("_q")).select(*group, "_part", "n", "lo", "hi", "_q.*")
    target = [*group, "which"]
    found = cut_lineage(_chosen(asked.withColumnRenamed("rank", "_r"), target, F.col("_r")).select(*target, "rank", "n", "lo", "hi"))

    def beside(chosen: DataFrame) -> DataFrame:
        """Rows between the ends of a target's bucket."""
        salted = chosen.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
        return salted.join(rows, same & (F.col("_s") == F.col("_salt")) & (F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi")))

    while (found.filter("lo < hi").agg(F.max("n")).first()[0] or 0) > limit:
        part = F.when(F.col("lo") < F.col("hi"), F.floor((F.col("_v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * (_PARTS - 1)).cast("int")).otherwise(F.lit(0))
        counted = (beside(found).groupBy(*target, "rank", part.alias("_part")).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")))
        found = cut_lineage(_chosen(counted.withColumnRenamed("rank", "_r"), target, F.col("_r")).select(*target, "rank", "n", "lo", "hi"))
    values = beside(found).groupBy(*target, "rank", F.col("_v").alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    exact = _chosen(values.withColumn("lo", F.col("_part")).withColumnRenamed("rank", "_r"), target, F.col("_r"))
    picked = exact.groupBy(*group).agg(F.max(F.when(F.col("which") == 0, F.col("lo"))).alias("_a"), F.max(F.when(F.col("which") == 1, F.col("lo"))).alias("_z"))
    sizes = cells.groupBy(*named).agg(F.sum("n").alias("_total"))
    pos = (F.col("_total") - 1) * F.lit(float(p))
    both = picked.select(*[F.col(g).alias(f"_p{g}") for g in group], "_a", "_z")
    match = F.lit(True)
    for g in group:
        match = match & F.col(g).eqNullSafe(F.col(f"_p{g}"))
    return sizes.join(both, match).select(*[F.col(g).alias(k) for g, k in zip(group, keys)], (F.col("_a") + (F.col("_z") - F.col("_a")) * (pos - F.floor(pos))).alias(out))
