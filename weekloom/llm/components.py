"""Connected components by alternating large and small stars (Kiveris et al., 2014), on joins and aggregates.

Minima combine in the map task, so a hub with a third of all edges is no hot group; the joins meet one row
for each node and adaptive execution splits a hub's edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import stored


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = stored(both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low")), "low")
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    low = stored(edges.groupBy("u").agg(F.min("v").alias("low")), "low")
    return edges.join(low, "u").filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(low.select("u", F.col("low").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of ``edges``(u, v) that is not its component's smallest, with the smallest.

    Edges may repeat, point either way and loop. A round is a few joins over the edges; the number of
    rounds grows with the logarithm of the longest way.
    """
    star = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        star = stored(_small(stored(_large(star).distinct(), "large")).distinct(), "small")
        now = star.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return star.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
