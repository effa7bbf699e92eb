"""From typed sources to a graded panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.operators import joins, junctions, quality, ranking, setops, windows
from weekloom.operators.aggregates import value_distribution
from weekloom.schema import METRICS, QUALITY_FLAGS
from weekloom.session import cut_lineage
from weekloom.sources.versions import publish_version, read_version
from weekloom.sources.writers import read_written, write_panel, write_summary


def _complete(df: DataFrame) -> DataFrame:
    """Enhanced columns a source did not bring, with their defaults."""
    zero = F.lit(0).cast("bigint")
    defaults = {"total_longform_views": zero, "total_shorts_views": zero, "channel_name": F.lit(""),
                "data_quality_flag": F.lit("good"), "activity": F.lit("unknown")}
    return df.withColumns({c: F.coalesce(F.col(c), d) if c in df.columns else d for c, d in defaults.items()})


def build_enriched_panel(base: DataFrame, entities: DataFrame, extra: list[DataFrame], uploads: DataFrame | None,
                         current_week, js: list[junctions.Junction], key: str = "channel", t: str = "week") -> DataFrame:
    """Base panel plus later sources, one row per entity and week, corrected, promoted and checked.

    Rows are put together and reduced to one per entity and week before anything is ordered, so
    the entity windows behind it are bounded and share one exchange; metadata joins come last.
    """
    rows = setops.append_sources(base, *extra)
    rows = _complete(rows.withColumn("_t", F.col(t)))
    rows = ranking.dedup_weekly(rows, key, "_t", t).drop("_t")
    if uploads is not None:
        rows = joins.asof_uploads(rows, uploads, key, t)
    rows = windows.deltas(rows, METRICS, key, t)
    rows = ranking.promote_latest(rows, current_week, key, t)
    rows = junctions.flag_junctions(rows, js, 7, key, t)
    rows = windows.iqr_outliers(rows, ["delta_views", "delta_subs"], key=key)
    rows = rows.drop("delta_views_iqr_outlier", "delta_subs_iqr_outlier")
    return joins.attach_metadata(rows, entities, key)


def publish(panel: DataFrame, path: str, fmt: str = "parquet", t: str = "week", mode: str = "errorifexists", run: str | None = None) -> DataFrame:
    """Write the panel and its summary; returns the flag counts.

    Summary and counts read the written files, whatever their format, so the panel is computed once. With ``run`` the
    panel becomes the version of that run (``sources.versions``): it is seen in full or not at all, and a run that is
    repeated after it published changes nothing.
    """
    spark = panel.sparkSession
    if run is not None:
        publish_version(panel, path, run, fmt, t)
        return value_distribution(read_version(spark, path, run), "data_quality_flag", QUALITY_FLAGS)
    write_panel(panel, f"{path}/panel", fmt, t=t, mode=mode)
    done = read_written(panel, f"{path}/panel", fmt, t)
    write_summary(done, f"{path}/summary", t=t, mode=mode)
    return value_distribution(done, "data_quality_flag", QUALITY_FLAGS)


def assemble_final(*sources: DataFrame, js: list[junctions.Junction], as_of, level: str = "comprehensive", conflicts: str = "quality",
                   overrides: dict | None = None, key: str = "channel", t: str = "week", materialize: bool = False) -> dict[str, DataFrame]:
    """All sources to one graded panel.

    ``conflicts``: ``quality`` keeps the best-flagged row of a week, ``precedence`` the highest
    ranked source. Returns panel, results, metrics and entity scores.
    """
    rows = _complete(setops.append_sources(*sources).withColumn("_t", F.col(t)))
    if conflicts == "precedence":
        rows = rows.withColumn("_flag", F.col("data_quality_flag")).withColumn("data_quality_flag", F.lit("good"))
        rows = ranking.dedup_weekly(rows, key, "_t", t).withColumn("data_quality_flag", F.col("_flag")).drop("_flag")
    elif conflicts == "quality":
        rows = ranking.dedup_weekly(rows, key, "_t", t)
    else:
        raise ValueError("conflicts must be quality or precedence")
    rows = windows.deltas(rows.drop("_t"), METRICS, key, t)
    if materialize:
        rows = cut_lineage(rows)      # checks and scores both start here
    flagged, results, metrics = quality.validate(rows, level, js, overrides, key, t, materialize=materialize)
    scores = quality.composite_score(rows, as_of, js, key=key, t=t)
    return {"panel": flagged, "results": results, "metrics": metrics, "scores": scores}
