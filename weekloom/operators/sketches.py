"""Reports from mergeable cells: a new partition of the panel costs that partition, not the panel.

A cell has the rows, the first and last day and a sketch of the entities of one (partition, source, flag). Cells of all
partitions together are small; distinct entities over any group of cells are the union of their sketches. The relative
standard error of a count is 1.04 / sqrt(2^lg_bits), about 0.8 % with 14 bits; up to some hundred entities it is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LG_BITS = 14
GROUPS = ("collection_source", "data_quality_flag")


def standard_error(lg_bits: int = LG_BITS) -> float:
    return 1.04 / 2 ** (lg_bits / 2)


def cells(df: DataFrame, partition: Column, key: str = "channel", t: str = "week", groups=GROUPS, lg_bits: int = LG_BITS) -> DataFrame:
    """(part, *groups, rows, first_day, last_day, entities): one row for each group of each partition, combined in the map task."""
    return (df.groupBy(partition.cast("string").alias("part"), *groups)
            .agg(F.count(F.lit(1)).alias("rows"), F.min(F.col(t).cast("date")).alias("first_day"), F.max(F.col(t).cast("date")).alias("last_day"),
                 F.hll_sketch_agg(F.col(key).cast("string"), F.lit(lg_bits)).alias("entities")))


def write_cells(made: DataFrame, path: str) -> None:
    """Store cells by partition; those of a partition that is written again are replaced, all others stay."""
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def read_cells(spark: SparkSession, path: str, groups=GROUPS) -> DataFrame:
    kinds = ", ".join(f"{g} string" for g in groups)
    return spark.read.schema(f"{kinds}, rows bigint, first_day date, last_day date, entities binary, part string").parquet(path)


def merged(stored: DataFrame, *by: str) -> DataFrame:
    """Cells put together by ``by`` (no name: all of them): rows, days and the estimated number of entities."""
    out = stored.groupBy(*by).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"), F.hll_union_agg("entities").alias("_s"))
    return out.withColumn("entities", F.coalesce(F.hll_sketch_estimate("_s"), F.lit(0).cast("bigint"))).drop("_s")


def summary_of_cells(stored: DataFrame, source: str = "collection_source", flag: str = "data_quality_flag") -> DataFrame:
    """The dataset summary (D1) from cells: everything exact but the number of entities."""
    def counts(col: str) -> Column:
        per = F.struct(F.coalesce(F.col(col), F.lit("")).alias("v"), F.col("rows").alias("n"))
        pairs = F.collect_list(per)
        names = F.array_sort(F.array_distinct(F.transform(pairs, lambda p: p["v"])))
        return F.map_from_arrays(names, F.transform(names, lambda v: F.aggregate(F.filter(pairs, lambda p: p["v"] == v), F.lit(0).cast("bigint"), lambda a, p: a + p["n"])))
    # the cells of one source and flag are put together first, so the lists are as short as there are kinds
    few = stored.groupBy(source, flag).agg(F.sum("rows").alias("rows"), F.min("first_day").alias("lo"), F.max("last_day").alias("hi"), F.hll_union_agg("entities").alias("_s"))
    return few.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("total_records"), F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("_s")), F.lit(0).cast("bigint")).alias("unique_channels"),
                   F.min("lo").alias("start_date"), F.max("hi").alias("end_date"), counts(source).alias("collection_sources"), counts(flag).alias("quality_flags"))


def coverage_of_cells(stored: DataFrame, era: Column, source: str = "collection_source") -> DataFrame:
    """(era, source, entities) with subtotals, null for all, as in the coverage report (D8); ``era`` is computed of ``part``."""
    rows = stored.withColumn("era", era).filter("era IS NOT NULL").groupBy("era", F.col(source).alias("source")).agg(F.hll_union_agg("entities").alias("_s"))
    return rows.rollup("era", "source").agg(F.hll_sketch_estimate(F.hll_union_agg("_s")).alias("entities"))
