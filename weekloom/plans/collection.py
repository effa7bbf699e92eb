"""From stored pages and payloads to observations, and the reports about a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.operators import aggregates, extract, joins, projections, quality, ranking, series, windows
from weekloom.sources.page_store import PageStore, fetch_pages
from weekloom.sources.writers import flatten_report


def _chosen_pages(pages: DataFrame | PageStore, chosen: DataFrame, key: str) -> DataFrame:
    """Pages of the chosen snapshots; html of a store is read in place, html of a frame is shuffled only where chosen."""
    return fetch_pages(pages, chosen.select(key, F.col("timestamp").alias("snapshot_ts")), key)


def pages_to_observations(index: DataFrame, pages: DataFrame | PageStore, end, start=None, n: int | None = 3, target_weeks: int = 165,
                          key: str = "channel", materialize: bool = False) -> dict[str, DataFrame]:
    """Best snapshots of each entity to flagged weekly points, with a grade per entity and the
    pages that gave nothing. Only the ``n`` best snapshots of an entity are read (None: all that
    score). ``materialize`` keeps the chart texts, for callers of several outputs. ``pages`` in a
    :class:`PageStore` are read where they lie."""
    pages = _chosen_pages(pages, ranking.top_snapshots(index, end, n, key), key)
    points = extract.extract_points(pages, materialize=materialize)
    obs = extract.standardize(points)
    obs = ranking.best_duplicate(obs, key, "obs_date", "snapshot_ts")
    if start is not None:
        obs = projections.filter_range(obs, start, end, "obs_date")
    obs = ranking.first_per_week(obs, key, "obs_date")
    obs = windows.point_flags(obs, key, "week")
    return {"observations": obs, "grades": aggregates.source_quality_grade(obs, target_weeks, key=key),
            "errors": extract.extract_errors(pages, points)}


def uploads_to_observations(index: DataFrame, pages: DataFrame | PageStore, current: DataFrame, as_of, n: int | None = 10,
                            key: str = "channel", max_count: int | None = None, out_of_range: str = "keep") -> dict[str, DataFrame]:
    """About ``n`` evenly spread snapshots of each entity (None: all) to an interpolated upload series.

    Series that exceed ``max_count`` are not valid; by default there is no bound. Counts beyond the
    plausible range stay in the series, as they are in the source, unless ``out_of_range`` is
    ``drop``. ``errors`` lists the pages that gave no point, with the reason ``no_count`` or
    ``out_of_range``.
    """
    if out_of_range not in ("keep", "drop"):
        raise ValueError("out_of_range must be keep or drop")
    pages = _chosen_pages(pages, ranking.spread_snapshots(index, n, key), key)
    found = extract.extract_upload_count(pages)
    usable = found.filter("in_range") if out_of_range == "drop" else found
    counts = usable.withColumn("obs_date", F.to_date(F.substring("snapshot_ts", 1, 8), "yyyyMMdd"))
    # one count per entity and day: the latest snapshot of the day
    counts = ranking.pick_best(counts, [key, "obs_date"], [F.col("snapshot_ts")])
    filled = series.interpolate_weekly(counts, key=key, stamp="snapshot_ts")
    flagged = windows.upload_flags(filled, key)
    validity = windows.upload_series_validity(flagged, key, "obs_date", "upload_count", max_count=max_count)
    valid = counts.join(validity.filter("valid").select(key), key, "left_semi")
    # the reason is a column of the same pass that reads the count, so pages are not joined with it
    stated = extract.page_upload_count(pages)
    reason = F.when(F.col("upload_count").isNull(), F.lit("no_count"))
    if out_of_range == "drop":
        reason = reason.when(~F.col("in_range"), F.lit("out_of_range"))
    errors = stated.select(key, "snapshot_ts", "url", reason.alias("reason")).filter("reason IS NOT NULL")
    return {"observations": flagged, "validity": validity, "to_current": series.extrapolate_to_current(valid, current, as_of, key=key), "errors": errors}


def entity_enrichment(entities: DataFrame, done: DataFrame, items: DataFrame, phase: str = "phase_1",
                      key: str = "channel") -> dict[str, DataFrame]:
    """Entities not yet processed, enriched from returned items, with derived ratios and counts."""
    flat = projections.project_api_item(items) if "item" in items.columns else items
    rows = joins.enrich_entities(joins.remaining(entities, done, key), flat, key)
    rows = projections.derived_channel_metrics(rows, "current_views", "current_subs", "current_videos")
    results = rows.select(F.lit(phase).alias("phase"), key, (F.col("processing_status") == "enriched").alias("success"),
                          F.when(F.col("processing_status") == "enriched", 1).otherwise(0).cast("bigint").alias("data_points"),
                          F.lit(0).cast("bigint").alias("weeks"))
    return {"entities": rows, "unexpected": joins.unexpected_items(flat, entities, key), "stats": aggregates.phase_stats(results)}


def quality_and_progress_reports(events: DataFrame, phases: DataFrame, logs: DataFrame, results: DataFrame,
                                 metrics: DataFrame) -> dict[str, DataFrame]:
    """Collector, run and log summaries and the validation report, also as flat rows."""
    report = quality.validation_report(results, metrics)
    return {"collectors": aggregates.collector_stats(events), "runs": aggregates.run_rollup(phases),
            "logs": aggregates.log_summary(logs), "report": report, "rows": flatten_report(report)}
