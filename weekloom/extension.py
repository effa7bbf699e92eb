"""Extension surface: sources, a per-entity hook, progress metrics. Rules live in ``operators.quality``."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from weekloom.operators.setops import append_sources
from weekloom.sources.readers import Source


def read_sources(spark: SparkSession, sources: list[Source]) -> DataFrame:
    """Rows of all sources; rows without a source tag get the source's name."""
    frames = []
    for s in sources:
        df = s.read(spark)
        tag = F.coalesce(F.col("collection_source"), F.lit(s.name)) if "collection_source" in df.columns else F.lit(s.name)
        frames.append(df.withColumn("collection_source", tag))
    return append_sources(*frames)


def map_entities(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, key: str = "channel") -> DataFrame:
    """Escape hatch: a pandas function per entity of a panel (at most one row per week each)."""
    return df.groupBy(key).applyInPandas(fn, schema)


def with_progress(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Count rows (and further aggregates) while ``df`` is used by its next action."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()]), seen
