"""Section L: end-to-end compositions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks import fixtures as X
from checks.q_pages import STAMP, mixed_pages
from checks.q_reports import _OVER, SCORES_CTES, SCORES_SQL, _phases, _validated, log_lines
from checks.q_windows import _P, _steps_sql
from checks.registry import cte, joined, query, r6
from weekloom import plans
from weekloom.operators import joins
from weekloom.operators.aggregates import parse_log_lines
from weekloom.plans import panel as PP
from weekloom.sources.page_store import write_page_store

_CUT = "2001-10-07"

cte("steps7", " UNION ALL ".join(_steps_sql(j.name, j.day, j.tolerance, 7) for j in X.JUNCTIONS), "full_panel")
cte("fair7", """SELECT DISTINCT s.channel, s.week FROM steps7 s JOIN (SELECT channel, junction FROM steps7 GROUP BY ALL HAVING sum(hits) > 0) b
 ON b.channel = s.channel AND b.junction = s.junction""", "steps7")
cte("with_uploads", """SELECT channel, week, CASE WHEN collection_source = 'WAYBACK_CHARTS' AND upload_count IS NOT NULL THEN upload_count ELSE videos END AS videos,
 CASE WHEN collection_source = 'WAYBACK_CHARTS' AND upload_count IS NOT NULL THEN 'WAYBACK_UPLOADS' ELSE collection_source END AS collection_source
 FROM (SELECT p.channel, p.week, p.videos, p.collection_source, u.upload_count FROM panel p ASOF LEFT JOIN uploads u ON u.channel = p.channel AND p.week >= u.obs_date)""", "panel", "uploads")


def _sources(spark, sf):
    """The panel by era, plus a worse second opinion on the middle era."""
    p = X.panel(spark, sf).withColumn("activity", F.lit("active"))
    base = p.filter(F.col("collection_source") == "API")
    charts = p.filter(F.col("collection_source") == "WAYBACK_CHARTS")
    recent = p.filter(F.col("collection_source") == "VIEWSTATS")
    doubt = charts.withColumns({"views": F.col("views") + 1, "data_quality_flag": F.lit("poor")}).drop("activity")
    return base, [charts, recent, doubt]


@query("l1_build_enriched_panel", f"""SELECT i.channel, i.week, i.views, i.subs, u.videos, i.delta_views, COALESCE(u.videos - lag(u.videos) OVER (PARTITION BY i.channel ORDER BY i.week), 0) AS delta_videos,
 CASE WHEN l THEN 'FINAL_API' ELSE u.collection_source END AS collection_source,
 CASE WHEN f.channel IS NOT NULL OR i.delta_views_iqr_outlier OR i.delta_subs_iqr_outlier THEN 'fair' WHEN l THEN 'excellent' ELSE 'good' END AS data_quality_flag, e.channel_name, e.category
 FROM (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY week DESC) = 1 AND week >= DATE '{_CUT}' - 7 AS l FROM iqr) i JOIN with_uploads u ON u.channel = i.channel AND u.week = i.week
 JOIN entities e ON e.channel = i.channel LEFT JOIN fair7 f ON f.channel = i.channel AND f.week = i.week""", "iqr", "with_uploads", "fair7", "entities")
def _(spark, sf):
    base, extra = _sources(spark, sf)
    out = plans.build_enriched_panel(base, X.entities(spark, sf), extra, X.uploads(spark, sf), _CUT, X.JUNCTIONS)
    return out.select("channel", "week", "views", "subs", "videos", "delta_views", "delta_videos", "collection_source", "data_quality_flag", "channel_name", "category")


@query("l1_publish", "SELECT f AS value, count(data_quality_flag) AS n FROM (SELECT unnest(['excellent', 'good', 'fair', 'poor', 'missing']) AS f) LEFT JOIN defects ON data_quality_flag = f GROUP BY f", "defects")
def _(spark, sf):
    from checks.scratch import scratch
    return plans.publish(X.defects(spark, sf), scratch(spark, "publish"))


@query("l1_publish_versions", "SELECT channel, week, views, subs, data_quality_flag, 'second' AS run FROM defects", "defects")
def _(spark, sf):
    from checks.scratch import scratch
    from weekloom.sources import versions as V
    path = scratch(spark, "versions")
    panel = X.defects(spark, sf)
    plans.publish(panel.filter(F.col("week") < F.lit(X.J2)), path, run="first")
    # a write that dies leaves the first version in place
    broken = panel.withColumn("views", F.when(F.col("week") > F.lit(X.J2), F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("views")))
    try:
        plans.publish(broken, path, run="second")
    except Exception:  # noqa: BLE001
        seen = V.current(spark, path)["run"]
    else:
        seen = "none"
    if seen != "first" or V.read_version(spark, path).agg(F.max("week")).first()[0] >= X.J2:
        raise ValueError(f"half a panel was seen: {seen}")
    plans.publish(panel, path, run="second")
    plans.publish(panel.limit(0), path, run="second")        # repeated: changes nothing
    return V.read_version(spark, path).select("channel", "week", "views", "subs", "data_quality_flag", F.lit(V.current(spark, path)["run"]).alias("run"))


@query("c3_run_in_parts", "SELECT channel, channel_name, status FROM enriched", "enriched")
def _(spark, sf):
    from checks.scratch import scratch
    from weekloom.sources.versions import run_in_parts
    path, items, turns = scratch(spark, "parts"), X.api_items(spark, sf), []

    def enrich(part):
        turns.append(1)
        if len(turns) == 3:
            raise RuntimeError("lost")
        return joins.enrich_entities(part, items).select("channel", "channel_name", "status")
    try:
        run_in_parts(X.entities(spark, sf), enrich, path, "r", 4)
    except RuntimeError:
        pass
    out = run_in_parts(X.entities(spark, sf), enrich, path, "r", 4)
    if len(turns) != 5:
        raise ValueError("finished parts were processed again")
    return out


@query("l2_assemble_final", "SELECT channel, week, views, data_quality_flag FROM validated", "validated")
def _(spark, sf):
    base, extra = _sources(spark, sf)
    out = PP.assemble_final(base, *extra, js=X.JUNCTIONS, as_of=date(2001, 11, 6), overrides=_OVER)
    return out["panel"].select("channel", "week", "views", "data_quality_flag")


@query("l2_assemble_final_scores", SCORES_SQL, *SCORES_CTES)
def _(spark, sf):
    base, extra = _sources(spark, sf)
    out = PP.assemble_final(base, *extra, js=X.JUNCTIONS, as_of=date(2001, 11, 6), overrides=_OVER, conflicts="precedence")
    return r6(out["scores"], "completeness", "continuity", "statistical", "temporal", "freshness", "score")


_KIND = "CAST(substr(channel, 2) AS BIGINT) % 5"
cte("page_stamps", "SELECT channel, max(timestamp) AS snapshot_ts FROM snapshot_index WHERE statuscode = '200' GROUP BY 1 HAVING max(timestamp) >= '20010101'", "snapshot_index")


# real pages without a chart, stored under the first indexed stamp of an entity's last year
cte("blank_pages", """SELECT s.channel, s.snapshot_ts, p.url FROM (SELECT channel, min(timestamp) AS snapshot_ts FROM snapshot_index WHERE statuscode = '200' AND timestamp >= '20010101'
 GROUP BY 1 HAVING min(timestamp) < max(timestamp)) s JOIN pages p ON p.page_id = CAST(substr(s.channel, 2) AS BIGINT)""", "snapshot_index")


def _stored_pages(spark, sf):
    """Rendered and real pages in a bucketed store."""
    from checks.scratch import scratch
    index = X.snapshot_index(spark, sf).filter((F.col("statuscode") == "200") & (F.col("timestamp") >= "20010101"))
    stamps = index.groupBy("channel").agg(F.min("timestamp").alias("snapshot_ts"), F.max("timestamp").alias("last")).filter("snapshot_ts < last").drop("last")
    raw = X.table(spark, sf, "pages").withColumn("channel", F.concat(F.lit("S"), F.lpad(F.col("page_id").cast("string"), 6, "0")))
    blank = stamps.join(raw, "channel").select("channel", "snapshot_ts", "url", "html")
    return write_page_store(mixed_pages(spark, sf).select("channel", "snapshot_ts", "url", "html").unionByName(blank), scratch(spark, "pages"), 8)


cte("chart_points", f"""SELECT o.channel, obs_date, obs_date - CAST(dayofweek(obs_date) AS INTEGER) AS week, subs, views, extraction_method, snapshot_ts FROM
 (SELECT channel, week AS obs_date, subs, CASE WHEN {_KIND} = 2 THEN 0 ELSE views END AS views, CASE {_KIND} WHEN 1 THEN 'highcharts' WHEN 2 THEN 'plotly' WHEN 3 THEN 'chartjs' ELSE 'table' END AS extraction_method
 FROM panel WHERE {_KIND} <> 0 UNION ALL SELECT channel, DATE '1970-01-01' + CAST(t // 86400000 AS INTEGER), subs, views, 'dygraph' FROM combined WHERE {_KIND} = 0) o JOIN page_stamps p ON p.channel = o.channel""", "panel", "combined", "page_stamps")
cte("chart_flags", """SELECT *, concat_ws('; ', CASE WHEN abs(ds) > subs * 0.5 THEN 'large_subscriber_change' END, CASE WHEN abs(dv) > views * 0.5 THEN 'large_view_change' END, CASE WHEN subs = 0 AND views = 0 THEN 'zero_values' END) AS flags
 FROM (SELECT *, COALESCE(subs - lag(subs) OVER w, 0) AS ds, COALESCE(views - lag(views) OVER w, 0) AS dv FROM chart_points WINDOW w AS (PARTITION BY channel ORDER BY week))""", "chart_points")


def _observed(spark, sf, n=3):
    return plans.pages_to_observations(X.snapshot_index(spark, sf), _stored_pages(spark, sf), X.INDEX_END, n=n, materialize=True)


@query("l3_pages_to_observations", """SELECT channel, obs_date, week, subs, views, ds AS delta_subs, dv AS delta_views, extraction_method = 'table' AS low_quality, 'WAYBACK_CHARTS' AS collection_source,
 extraction_method, snapshot_ts, flags AS point_flags FROM chart_flags""", "chart_flags")
def _(spark, sf):
    out = _observed(spark, sf)["observations"]
    return out.select("channel", "obs_date", "week", "subs", "views", "delta_subs", "delta_views", "low_quality", "collection_source", "extraction_method", "snapshot_ts", joined("point_flags").alias("point_flags"))


@query("l3_all_snapshots", "SELECT channel, obs_date, subs, views, snapshot_ts FROM chart_points", "chart_points")
def _(spark, sf):
    return _observed(spark, sf, None)["observations"].select("channel", "obs_date", "subs", "views", "snapshot_ts")


@query("l3_grades", """SELECT channel, points, weeks_covered, round(f, 6) AS flagged_share, round(c, 6) AS complete_share, round(weeks_covered / 165.0::DOUBLE, 6) AS coverage,
 CASE WHEN weeks_covered / 165.0 > 0.9 AND f < 0.1 THEN 'excellent' WHEN weeks_covered / 165.0 > 0.7 AND f < 0.2 THEN 'good' WHEN weeks_covered / 165.0 > 0.5 AND f < 0.3 THEN 'fair' ELSE 'poor' END AS grade
 FROM (SELECT channel, count(*) AS points, CAST((max(week) - min(week)) // 7 AS INTEGER) AS weeks_covered, CAST(count_if(flags <> '') / count(*) AS DOUBLE) AS f,
 CAST(count_if(subs > 0 AND views > 0) / count(*) AS DOUBLE) AS c FROM chart_flags GROUP BY channel)""", "chart_flags")
def _(spark, sf):
    return r6(_observed(spark, sf)["grades"], "flagged_share", "complete_share", "coverage")


@query("l3_errors", "SELECT channel, snapshot_ts, url, 'unknown' AS library FROM blank_pages", "blank_pages")
def _(spark, sf):
    return _observed(spark, sf, None)["errors"]


cte("stated", """SELECT i.channel, i.timestamp, original AS url, CASE WHEN CAST(digest AS BIGINT) % 11 = 5 THEN NULL WHEN CAST(digest AS BIGINT) % 13 = 7 THEN 200000 + CAST(digest AS BIGINT) % 40
 ELSE CAST(digest AS BIGINT) % 40 + (CAST(strptime(i.timestamp, '%Y%m%d%H%M%S') AS DATE) - DATE '1990-01-01') END AS v FROM snapshot_index i WHERE statuscode = '200'
 QUALIFY row_number() OVER (PARTITION BY channel, timestamp ORDER BY digest) = 1""", "snapshot_index")
cte("spread10", """SELECT DISTINCT channel, timestamp FROM (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY timestamp, digest) - 1 AS pos, count(*) OVER (PARTITION BY channel) AS total
 FROM snapshot_index WHERE statuscode = '200') WHERE total <= 10 OR list_contains([CAST(floor(i * total / 10.0::DOUBLE) AS BIGINT) FOR i IN range(10)], pos)""", "snapshot_index")


def _series_sql(stated: str) -> str:
    return f"""WITH c AS (SELECT channel, CAST(strptime(timestamp, '%Y%m%d%H%M%S') AS DATE) AS d, arg_max(v, timestamp) AS v FROM ({stated}) WHERE v IS NOT NULL GROUP BY 1, 2),
n AS (SELECT *, CASE WHEN t2 - d > 14 THEN greatest(1, (t2 - d) // 7 - 1) ELSE 0 END AS n FROM (SELECT *, lead(d) OVER (PARTITION BY channel ORDER BY d) AS t2, lead(v) OVER (PARTITION BY channel ORDER BY d) AS v2 FROM c)),
i AS (SELECT *, unnest(generate_series(0, n)) AS i FROM n),
r AS (SELECT channel, d + CAST(i AS INTEGER) * 7 AS obs_date, CASE WHEN i = 0 THEN v WHEN v2 <= v THEN v ELSE greatest(CAST(trunc(v + (v2 - v) * (i / CAST(n + 1 AS DOUBLE))) AS BIGINT), v) END AS upload_count, i > 0 AS interpolated FROM i),
z AS (SELECT *, COALESCE(upload_count - lag(upload_count) OVER (PARTITION BY channel ORDER BY obs_date), 0) AS du FROM r)
SELECT channel, obs_date, upload_count, interpolated, du AS delta_uploads, concat_ws('; ', CASE WHEN interpolated THEN 'interpolated_data' END, CASE WHEN abs(du) > 1000 THEN 'large_upload_change' END,
 CASE WHEN du < 0 AND interpolated THEN 'interpolated_decrease' END, CASE WHEN du < 0 AND NOT interpolated THEN 'decreasing_uploads' END) AS quality_flags FROM z"""


_IN_RANGE = "SELECT * REPLACE (CASE WHEN v <= 100000 THEN v END AS v) FROM stated"
cte("counts10", _series_sql("SELECT stated.* FROM stated JOIN spread10 USING (channel, timestamp)"), "stated", "spread10")
cte("counts_all", _series_sql(_IN_RANGE), "stated")
cte("counts_valid", """SELECT channel, count(*) AS points, arg_min(upload_count, obs_date) AS first_count, arg_max(upload_count, obs_date) AS last_count, max(upload_count) AS max_count FROM counts_all GROUP BY 1""", "counts_all")


def _uploads(spark, sf, **options):
    """Pages of every snapshot in a store; some state no count, some one beyond the range."""
    from checks.scratch import scratch
    idx = X.snapshot_index(spark, sf)
    d = F.col("digest").cast("bigint")
    count = d % 40 + F.datediff(F.to_date(F.substring("timestamp", 1, 8), "yyyyMMdd"), F.lit("1990-01-01").cast("date"))
    html = F.when(d % 11 == 5, F.lit("<p>Nothing stated about uploads.</p>")).otherwise(F.concat(
        F.lit('<div><span id="youtube-stats-header-uploads">'), F.format_number(F.when(d % 13 == 7, 200_000 + d % 40).otherwise(count), 0), F.lit("</span></div>")))
    first = idx.filter(F.col("statuscode") == "200").groupBy("channel", "timestamp").agg(F.min(F.struct("digest", "original")).alias("r")).select("channel", "timestamp", "r.*")
    pages = first.select("channel", F.col("timestamp").alias("snapshot_ts"), F.col("original").alias("url"), html.alias("html"))
    cur = X.entities(spark, sf).select("channel", F.lit(9000).cast("bigint").alias("current_count"))
    return plans.uploads_to_observations(idx, write_page_store(pages, scratch(spark, "uploads"), 8), cur, X.AS_OF, **options)


@query("l4_uploads_to_observations", "SELECT * FROM counts10", "counts10")
def _(spark, sf):
    out = _uploads(spark, sf)["observations"]
    return out.select("channel", "obs_date", "upload_count", "interpolated", "delta_uploads", joined("quality_flags").alias("quality_flags"))


@query("l4_all_in_range", "SELECT * FROM counts_all", "counts_all")
def _(spark, sf):
    out = _uploads(spark, sf, n=None, out_of_range="drop")["observations"]
    return out.select("channel", "obs_date", "upload_count", "interpolated", "delta_uploads", joined("quality_flags").alias("quality_flags"))


@query("l4_validity", """SELECT *, CASE WHEN points > 1 AND last_count < first_count * 0.8 THEN 'decreased' WHEN max_count > 4340 THEN 'too_high' ELSE 'ok' END AS reason,
 NOT (points > 1 AND last_count < first_count * 0.8) AND max_count <= 4340 AS valid FROM counts_valid""", "counts_valid")
def _(spark, sf):
    return _uploads(spark, sf, n=None, out_of_range="drop", max_count=4340)["validity"]


@query("l4_to_current", f"""WITH c AS (SELECT channel, CAST(strptime(timestamp, '%Y%m%d%H%M%S') AS DATE) AS d, arg_max(v, timestamp) AS v FROM ({_IN_RANGE}) WHERE v IS NOT NULL GROUP BY 1, 2),
l AS (SELECT c.channel, max(d) AS t, arg_max(v, d) AS v, CAST(9000 AS BIGINT) AS c FROM c JOIN counts_valid q ON q.channel = c.channel AND max_count <= 4340 AND NOT (points > 1 AND last_count < first_count * 0.8)
 JOIN entities e ON e.channel = c.channel GROUP BY 1),
x AS (SELECT *, DATE '{X.AS_OF}' - t AS gap FROM l WHERE DATE '{X.AS_OF}' - t > 30 AND c > v), y AS (SELECT *, unnest(generate_series(1, (gap - 1) // 30 + 1)) AS i FROM x)
SELECT channel, CASE WHEN i <= (gap - 1) // 30 THEN t + CAST(i AS INTEGER) * 30 ELSE DATE '{X.AS_OF}' END AS obs_date,
 CASE WHEN i <= (gap - 1) // 30 THEN least(CAST(trunc(v + (c - v) / CAST(gap AS DOUBLE) * (i * 30)) AS BIGINT), c) ELSE c END AS upload_count,
 CASE WHEN i <= (gap - 1) // 30 THEN 'current_api_interpolated' ELSE 'youtube_api_current' END AS source, i <= (gap - 1) // 30 AS interpolated FROM y""", "stated", "counts_valid", "entities")
def _(spark, sf):
    return _uploads(spark, sf, n=None, out_of_range="drop", max_count=4340)["to_current"]


@query("l4_errors", """SELECT channel, timestamp AS snapshot_ts, url, CASE WHEN v IS NULL THEN 'no_count' ELSE 'out_of_range' END AS reason FROM stated WHERE v IS NULL OR v > 100000""", "stated")
def _(spark, sf):
    return _uploads(spark, sf, n=None, out_of_range="drop")["errors"]


@query("l5_entity_enrichment", """SELECT channel, channel_name, status, processing_status, round(CASE WHEN current_videos > 0 THEN current_views / current_videos ELSE 0 END, 6) AS avg_views_per_video FROM enriched WHERE k % 4 <> 0""", "enriched")
def _(spark, sf):
    out = plans.entity_enrichment(X.entities(spark, sf), X.done(spark, sf), X.api_items(spark, sf))
    return r6(out["entities"].select("channel", "channel_name", "status", "processing_status", "avg_views_per_video"), "avg_views_per_video")


@query("l5_entity_enrichment_stats", """SELECT 'phase_1' AS phase, count(*) AS channels_processed, CAST(count_if(processing_status = 'enriched') AS BIGINT) AS channels_successful FROM enriched WHERE k % 4 <> 0""", "enriched")
def _(spark, sf):
    out = plans.entity_enrichment(X.entities(spark, sf), X.done(spark, sf), X.api_items(spark, sf))
    return out["stats"].select("phase", "channels_processed", "channels_successful")


@query("l6_quality_and_progress_reports", """SELECT 'validation_summary' AS Category, unnest(['total_rules_checked', 'rules_passed', 'rules_failed', 'total_records_affected']) AS Metric,
 unnest([count(*), count_if(passed), count_if(NOT passed), sum(affected_records)])::VARCHAR AS Value FROM rule_results UNION ALL SELECT 'quality_flags', data_quality_flag, CAST(count(*) AS VARCHAR) FROM validated GROUP BY ALL""", "rule_results", "validated")
def _(spark, sf):
    _, results, metrics = _validated(spark, sf)
    runs = _phases(spark, sf).select(F.lit("run").alias("run_id"), "channels_processed", "channels_successful",
                                     F.col("total_data_points").alias("records_created"), F.col("total_weeks_covered").cast("double").alias("duration_seconds"))
    out = plans.quality_and_progress_reports(X.collector_events(spark, sf), runs, parse_log_lines(log_lines(spark, sf)), results, metrics)
    return out["rows"].filter(F.col("Category").isin("validation_summary", "quality_flags"))
