"""Sections D and I: summaries, coverage, rules, scores, gates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks import fixtures as X
from checks.registry import ORACLES, cte, joined, query, r6
from checks.scratch import scratch
from checks.q_windows import QRANK, SRANK, _P
from weekloom.functions import scalars as S
from weekloom.operators import aggregates as A, quality as Q, sketches as SK, windows as W
from weekloom.schema import QUALITY_FLAGS, SOURCES
from weekloom.sources.writers import flatten_report


def _map(col):
    """Map to text ``k=v`` in key order."""
    entries = F.sort_array(F.map_entries(col))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), "; ")


_MAP_SQL = "string_agg(concat(v, '=', n), '; ' ORDER BY v)"


@query("d1_dataset_summary", f"""SELECT CAST((SELECT count(*) FROM defects) AS BIGINT) AS total_records, (SELECT count(DISTINCT channel) FROM defects) AS unique_channels,
 (SELECT min(week) FROM defects) AS start_date, (SELECT max(week) FROM defects) AS end_date,
 (SELECT {_MAP_SQL} FROM (SELECT collection_source AS v, count(*) AS n FROM defects GROUP BY 1)) AS collection_sources,
 (SELECT {_MAP_SQL} FROM (SELECT data_quality_flag AS v, count(*) AS n FROM defects GROUP BY 1)) AS quality_flags""", "defects")
def _(spark, sf):
    return A.dataset_summary(X.defects(spark, sf)).withColumns({
        "collection_sources": _map("collection_sources"), "quality_flags": _map("quality_flags")})


@query("d2_value_distribution", """SELECT v AS value, count(collection_source) AS n FROM (SELECT unnest(['API', 'WAYBACK_CHARTS', 'WAYBACK_UPLOADS', 'VIEWSTATS', 'FINAL_API']) AS v)
 LEFT JOIN panel ON collection_source = v GROUP BY v""", "panel")
def _(spark, sf):
    return A.value_distribution(X.panel(spark, sf), "collection_source", SOURCES)


_FIELDS = [("channel", "critical", 1.0), ("week", "critical", 1.0), ("views", "critical", 1.0), ("subs", "critical", 1.0),
           ("category", "important", 0.95), ("videos", "important", 0.95), ("channel_name", "optional", 0.8), ("total_longform_views", "optional", 0.8)]


@query("d3_completeness", " UNION ALL ".join(f"""SELECT '{f}' AS field, '{lv}' AS importance, CAST(count_if({f} IS NULL) AS BIGINT) AS nulls, {need}::DOUBLE AS required,
 round(CAST(1.0::DOUBLE - count_if({f} IS NULL) / count(*) AS DOUBLE), 6) AS filled_ratio, 1.0::DOUBLE - count_if({f} IS NULL) / count(*) >= {need} AS passed FROM defects""" for f, lv, need in _FIELDS), "defects")
def _(spark, sf):
    fields = {}
    for f, level, _ in _FIELDS:
        fields.setdefault(level, []).append(f)
    return r6(A.completeness(X.defects(spark, sf), fields), "filled_ratio")


@query("d4_entity_coverage", f"""SELECT channel, min(week) AS first_date, max(week) AS last_date, count(*) AS points, round(least(count(*) / 300.0, 1.0)::DOUBLE, 6) AS coverage,
 string_agg(DISTINCT collection_source, '; ' ORDER BY collection_source) AS sources, round(avg({QRANK}), 6) AS mean_grade FROM defects GROUP BY channel""", "defects")
def _(spark, sf):
    return r6(A.entity_coverage(X.defects(spark, sf), 300).withColumn("sources", joined("sources")), "coverage", "mean_grade")


cte("flagged_points", f"""SELECT *, abs(ds) > subs * 0.5 OR abs(dv) > views * 0.5 OR subs < 0 OR views < 0 OR (subs = 0 AND views = 0) AS bad
 FROM (SELECT *, COALESCE(subs - lag(subs) OVER ({_P}), 0) AS ds, COALESCE(views - lag(views) OVER ({_P}), 0) AS dv FROM defects)""", "defects")

for _variant, _ok in (("flagged", ("f < 0.1", "f < 0.2", "f < 0.3")), ("complete", ("c > 0.9", "c > 0.8", "c > 0.7"))):
    @query(f"d5_source_quality_{_variant}", f"""SELECT channel, points, weeks_covered, round(f, 6) AS flagged_share, round(c, 6) AS complete_share, round(weeks_covered / 340.0::DOUBLE, 6) AS coverage,
 CASE WHEN weeks_covered / 340.0 > 0.9 AND {_ok[0]} THEN 'excellent' WHEN weeks_covered / 340.0 > 0.7 AND {_ok[1]} THEN 'good' WHEN weeks_covered / 340.0 > 0.5 AND {_ok[2]} THEN 'fair' ELSE 'poor' END AS grade
 FROM (SELECT channel, count(*) AS points, CAST((max(week) - min(week)) // 7 AS INTEGER) AS weeks_covered, CAST(count_if(bad) / count(*) AS DOUBLE) AS f,
 CAST(count_if(subs > 0 AND views > 0) / count(*) AS DOUBLE) AS c FROM flagged_points GROUP BY channel)""", "flagged_points")
    def _(spark, sf, variant=_variant):
        return r6(A.source_quality_grade(W.point_flags(X.defects(spark, sf)), 340, variant), "flagged_share", "complete_share", "coverage")


@query("d6_collection_report", """SELECT count(*) AS total_channels, CAST(count_if(processing_status = 'enriched') AS BIGINT) AS enriched_channels, CAST(count_if(processing_status = 'failed') AS BIGINT) AS failed_channels,
 CAST(count_if(processing_status = 'not_found') AS BIGINT) AS not_found_channels, round(CAST(count_if(processing_status = 'enriched') / count(*) * 100 AS DOUBLE), 6) AS success_rate,
 CAST(count_if(status = 'active') AS BIGINT) AS active, CAST(count_if(status = 'inactive') AS BIGINT) AS inactive, CAST(count_if(status = 'terminated') AS BIGINT) AS terminated,
 CAST(count_if(status = 'private') AS BIGINT) AS private, CAST(count_if(status = 'unknown') AS BIGINT) AS unknown FROM enriched""", "enriched")
def _(spark, sf):
    return r6(A.collection_report(X.enriched(spark, sf)), "success_rate")


cte("phases", """SELECT phase, count(*) AS channels_processed, CAST(count_if(ok) AS BIGINT) AS channels_successful, CAST(sum(p) AS BIGINT) AS total_data_points, CAST(sum(w) AS BIGINT) AS total_weeks_covered
 FROM (SELECT collector AS phase, entity, bool_or(success) AS ok, sum(data_points) AS p, sum(weeks) AS w FROM collector_events GROUP BY 1, 2) GROUP BY phase""", "collector_events")


def _phases(spark, sf):
    e = X.collector_events(spark, sf)
    return A.phase_stats(e.select(F.col("collector").alias("phase"), F.col("entity").alias("channel"), "success", "data_points", "weeks"))


@query("d7_phase_stats", """SELECT *, round(CAST(channels_successful / channels_processed * 100 AS DOUBLE), 6) AS success_rate,
 round(CAST(total_weeks_covered / channels_processed AS DOUBLE), 6) AS average_weeks_per_channel FROM phases""", "phases")
def _(spark, sf):
    return r6(_phases(spark, sf), "success_rate", "average_weeks_per_channel")


_ERAS = [("history", date(1995, 1, 1), date(1997, 9, 6), 0.80), ("middle", date(1997, 9, 7), date(1999, 7, 31), 0.95), ("current", date(1999, 8, 1), date(2002, 12, 31), 0.98)]
_ERA_SQL = "CASE " + " ".join(f"WHEN week BETWEEN DATE '{a}' AND DATE '{b}' THEN '{n}'" for n, a, b, _ in _ERAS) + " END"


@query("d8_coverage_report", f"""WITH e AS (SELECT {_ERA_SQL} AS era, collection_source AS source, channel FROM observations WHERE {_ERA_SQL} IS NOT NULL),
r AS (SELECT era, source, count(DISTINCT channel) AS entities FROM e GROUP BY ROLLUP (era, source)),
t AS (SELECT *, entities / (SELECT entities FROM r WHERE era IS NULL) AS share, CASE era WHEN 'history' THEN 0.8 WHEN 'middle' THEN 0.95 WHEN 'current' THEN 0.98 ELSE 0.9 END::DOUBLE AS goal FROM r)
SELECT COALESCE(era, 'ALL') AS era, COALESCE(source, 'ALL') AS source, entities, round(share, 6) AS share, goal, share >= goal AS met FROM t""", "observations")
def _(spark, sf):
    return r6(A.coverage_report(X.observations(spark, sf), _ERAS), "share")


def _stored_cells(spark, sf, rows):
    """Cells by year, written for the first years and then for the others."""
    path = scratch(spark, "cells")
    for later in (False, True):
        part = rows.filter((F.year("week") >= 1998) == later)
        SK.write_cells(SK.cells(part, F.year("week")), path)
    return SK.read_cells(spark, path)


@query("d1_summary_of_cells", ORACLES["d1_dataset_summary"])
def _(spark, sf):
    return SK.summary_of_cells(_stored_cells(spark, sf, X.defects(spark, sf))).withColumns({"collection_sources": _map("collection_sources"), "quality_flags": _map("quality_flags")})


@query("d4_cells_by_source", "SELECT collection_source, count(*) AS rows, min(week) AS first_day, max(week) AS last_day, count(DISTINCT channel) AS entities FROM defects GROUP BY 1", "defects")
def _(spark, sf):
    return SK.merged(_stored_cells(spark, sf, X.defects(spark, sf)), "collection_source")


@query("d8_coverage_of_cells", """SELECT era, source, count(DISTINCT channel) AS entities FROM (SELECT CASE WHEN year(week) < 1998 THEN 'early' ELSE 'late' END AS era, collection_source AS source, channel FROM observations) GROUP BY ROLLUP (era, source)""", "observations")
def _(spark, sf):
    cells = _stored_cells(spark, sf, X.observations(spark, sf))
    return SK.coverage_of_cells(cells, F.when(F.col("part").cast("int") < 1998, F.lit("early")).otherwise(F.lit("late")))


@query("d8_sketch_error", "SELECT count(DISTINCT l_orderkey) AS orders, true AS within FROM lineitem")
def _(spark, sf):
    # entities by the thousand: three standard errors around the exact number
    li = X.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("channel"), F.to_date("l_shipdate").alias("week"), F.lit("API").alias("collection_source"), F.col("l_returnflag").alias("data_quality_flag"))
    exact = li.select("channel").distinct().agg(F.count(F.lit(1)).alias("orders"))
    seen = SK.merged(_stored_cells(spark, sf, li)).select(F.col("entities").alias("e"))
    both = exact.unionByName(seen, allowMissingColumns=True).agg(F.max("orders").alias("orders"), F.max("e").alias("e"))
    return both.select("orders", (F.abs(F.col("e") - F.col("orders")) <= 3 * SK.standard_error() * F.col("orders")).alias("within"))


@query("d9_collector_stats", """SELECT collector, count(*) AS requests_made, CAST(count_if(success) AS BIGINT) AS requests_successful, CAST(count(*) - count_if(success) AS BIGINT) AS requests_failed,
 round(CAST(count_if(success) / count(*) * 100 AS DOUBLE), 6) AS success_rate, round(avg(wait), 6) AS average_wait, CAST(sum(data_points) AS BIGINT) AS data_points_collected FROM collector_events GROUP BY collector""", "collector_events")
def _(spark, sf):
    return r6(A.collector_stats(X.collector_events(spark, sf)), "success_rate", "average_wait")


@query("d10_run_rollup", """SELECT concat('run', CAST(length(phase) % 2 AS VARCHAR)) AS run_id, CAST(sum(channels_processed) AS BIGINT) AS total_channels_processed, CAST(sum(total_data_points) AS BIGINT) AS total_records_created,
 CAST(sum(total_weeks_covered) AS DOUBLE) AS total_seconds, round(sum(total_weeks_covered) / 3600, 3) AS total_hours, round(sum(channels_successful) / sum(channels_processed), 3) AS success_rate FROM phases GROUP BY 1""", "phases")
def _(spark, sf):
    p = _phases(spark, sf).select(F.concat(F.lit("run"), (F.length("phase") % 2).cast("string")).alias("run_id"), "channels_processed", "channels_successful",
                                  F.col("total_data_points").alias("records_created"), F.col("total_weeks_covered").cast("double").alias("duration_seconds"))
    return A.run_rollup(p)


@query("d11_junction_pass_rates", """SELECT j AS junction, CAST(count_if((j = 'first' AND k % 3 = 0) OR (j = 'second' AND k % 4 = 1)) AS BIGINT) AS validated, count(*) AS total_channels,
 round(CAST(count_if((j = 'first' AND k % 3 = 0) OR (j = 'second' AND k % 4 = 1)) / count(*) * 100 AS DOUBLE), 6) AS rate FROM entities, (SELECT unnest(['first', 'second', 'third']) AS j) GROUP BY j""", "entities")
def _(spark, sf):
    k = F.col("k")
    done = F.array_compact(F.array(F.when(k % 3 == 0, F.lit("first")), F.when(k % 4 == 1, F.lit("second"))))
    return r6(A.junction_pass_rates(X.entities(spark, sf).withColumn("junction_points_validated", done), ["first", "second", "third"]), "rate")


@query("d12_metric_correlation", """SELECT channel, count(*) AS points, round(corr(CAST(subs AS DOUBLE), CAST(views AS DOUBLE)), 6) AS correlation FROM panel GROUP BY channel""", "panel")
def _(spark, sf):
    return r6(A.metric_correlation(X.panel(spark, sf)), "correlation")


@query("d13_variation", """SELECT channel, count(*) AS points, round(CASE WHEN count(*) > 1 THEN stddev_samp(views) / avg(views) END, 6) AS cv FROM panel WHERE week BETWEEN DATE '1997-01-05' AND DATE '1998-12-27' GROUP BY channel""", "panel")
def _(spark, sf):
    return r6(A.variation(X.panel(spark, sf), date(1997, 1, 5), date(1998, 12, 27)), "cv")


def log_lines(spark, sf):
    """Log text lines derived from the events."""
    e = X.table(spark, sf, "events")
    m = F.col("event_id") % 6
    level = F.when(F.col("event_type") == "error", F.lit("ERROR")).when(m == 1, F.lit("WARNING")).otherwise(F.lit("INFO"))
    v = F.col("value").cast("decimal(12,2)").cast("string")
    msg = (F.when(m == 0, F.lit("Processed channel - one of many")).when(m == 1, F.lit("API request sent"))
           .when(m == 2, F.concat(F.lit("api_response_time: "), v)).when(m == 3, F.concat(F.lit("quality_score: 0."), F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0")))
           .otherwise(F.lit("idle")))
    line = F.concat_ws(" - ", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss"), F.concat(F.lit("app.collectors."), "event_type"), level, msg)
    return e.select(F.when(m == 5, F.lit("stack trace without separators")).otherwise(line).alias("value"))


cte("log_rows", """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, concat('app.collectors.', event_type) AS logger, CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_id % 6 = 1 THEN 'WARNING' ELSE 'INFO' END AS level,
 CASE event_id % 6 WHEN 0 THEN 'Processed channel - one of many' WHEN 1 THEN 'API request sent' WHEN 2 THEN concat('api_response_time: ', CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR))
 WHEN 3 THEN concat('quality_score: 0.', lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0')) ELSE 'idle' END AS message FROM events WHERE event_id % 6 <> 5""")


@query("d14_log_summary", """SELECT count(*) AS lines, CAST(count_if(level = 'ERROR') AS BIGINT) AS error_lines, CAST(count_if(level = 'WARNING') AS BIGINT) AS warning_lines, CAST(count_if(level = 'INFO') AS BIGINT) AS info_lines,
 string_agg(DISTINCT replace(logger, 'app.collectors.', ''), '; ' ORDER BY replace(logger, 'app.collectors.', '')) AS active_collectors,
 CAST(count_if(message LIKE 'Processed channel%') AS DOUBLE) AS processed_per_hour, round(CAST(count_if(message = 'API request sent') / 60 AS DOUBLE), 6) AS api_requests_per_minute,
 round(avg(CASE WHEN message LIKE 'api_response_time%' THEN CAST(substr(message, 20) AS DOUBLE) END), 6) AS mean_api_response_time,
 CAST(max(CASE WHEN message LIKE 'quality_score%' THEN concat(ts, substr(message, 16)) END)[20:] AS DOUBLE) AS last_quality_score FROM log_rows""", "log_rows")
def _(spark, sf):
    out = A.log_summary(A.parse_log_lines(log_lines(spark, sf)))
    return r6(out.withColumn("active_collectors", joined("active_collectors")), "api_requests_per_minute", "mean_api_response_time")


@query("f3_recent_errors", "SELECT ts, logger, level, message FROM log_rows WHERE level = 'ERROR' ORDER BY ts DESC, logger, message LIMIT 10", "log_rows")
def _(spark, sf):
    from weekloom.operators.ranking import recent_errors
    return recent_errors(A.parse_log_lines(log_lines(spark, sf)))


@query("d15_source_reliability", """SELECT collection_source AS source, count(*) AS rows, round(CAST(count_if(views IS NOT NULL AND subs IS NOT NULL AND videos IS NOT NULL AND data_quality_flag <> 'missing') / count(*) AS DOUBLE), 6) AS success_rate,
 round(CAST(count_if(views IS NULL OR subs IS NULL OR videos IS NULL) / count(*) AS DOUBLE), 6) AS null_share, round(CAST(count_if(data_quality_flag NOT IN ('excellent', 'good')) / count(*) AS DOUBLE), 6) AS flagged_share,
 round(CAST(count_if(o) / count(*) AS DOUBLE), 6) AS outlier_share FROM (SELECT *, COALESCE(n >= 4 AND (videos < q1 - 0.5 * (q3 - q1) OR videos > q3 + 0.5 * (q3 - q1)), false) AS o FROM
 (SELECT *, count(*) OVER (PARTITION BY channel) AS n, quantile_cont(videos, 0.25) OVER (PARTITION BY channel) AS q1, quantile_cont(videos, 0.75) OVER (PARTITION BY channel) AS q3 FROM defects)) GROUP BY 1""", "defects")
def _(spark, sf):
    rows = W.iqr_outliers(X.defects(spark, sf), ["videos"], 0.5, flag=None)
    return r6(A.source_reliability(rows, outlier="videos_iqr_outlier"), "success_rate", "null_share", "flagged_share", "outlier_share")


@query("d16_points_per_month", """WITH m AS (SELECT channel, CAST(date_trunc('month', week) AS DATE) AS month, count(*) AS points FROM panel GROUP BY 1, 2)
SELECT channel, month, points FROM (SELECT *, min(month) OVER (PARTITION BY channel) AS lo, max(month) OVER (PARTITION BY channel) AS hi FROM m) WHERE month > lo AND month < hi AND points < 4""", "panel")
def _(spark, sf):
    return A.points_per_month(X.panel(spark, sf))


from checks.registry import CTES  # noqa: E402

cte("cross_source_defects", CTES["cross_source"][1].replace("FROM full_panel", "FROM defects"), "defects")

# --- I ---------------------------------------------------------------------------------------

_OVER = {"date_range": {"min_date": "1996-01-01", "max_date": "2001-06-30"}}
_RANGE = "(week < DATE '1996-01-01' OR week > DATE '2001-06-30')::INTEGER"


def _hits(rule, severity, rows, level):
    return f"SELECT '{rule}' AS rule_name, '{severity}' AS severity, {level} AS lv, channel, CAST(sum(h) AS BIGINT) AS h FROM ({rows}) GROUP BY channel"


cte("rule_hits", " UNION ALL ".join([
    _hits("weekly_granularity", "high", f"SELECT channel, COALESCE(g < 4 OR g > 10, false)::INTEGER AS h FROM (SELECT channel, week - lag(week) OVER ({_P}) AS g FROM full_panel)", 0),
    _hits("date_range", "critical", f"SELECT channel, {_RANGE} AS h FROM full_panel", 0),
    _hits("critical_completeness", "critical", "SELECT channel, (views IS NULL)::INTEGER + (subs IS NULL)::INTEGER AS h FROM full_panel", 0),
    _hits("required_fields", "high", "SELECT channel, 0 AS h FROM full_panel", 0),
    _hits("data_types", "medium", "SELECT channel, 0 AS h FROM full_panel", 0),
    _hits("unique_weeks", "high", "SELECT channel, (row_number() OVER (PARTITION BY channel, week) > 1)::INTEGER AS h FROM full_panel", 0),
    _hits("important_completeness", "high", "SELECT channel, (category IS NULL)::INTEGER + (videos IS NULL)::INTEGER AS h FROM full_panel", 0),
    _hits("growth_rate_limits", "medium", "SELECT channel, sub_growth_hit::INTEGER + view_growth_hit::INTEGER + upload_hit::INTEGER AS h FROM limits", 1),
    _hits("outlier_detection", "low", """SELECT channel, delta_views_z_outlier::INTEGER + delta_subs_z_outlier::INTEGER AS h FROM zs
 UNION ALL SELECT channel, views_iqr_outlier::INTEGER + subs_iqr_outlier::INTEGER + videos_iqr_outlier::INTEGER FROM iqr_levels""", 1),
    _hits("junction_continuity", "high", "SELECT channel, 0 AS h FROM full_panel UNION ALL SELECT channel, hits FROM steps", 2),
    _hits("cross_source_consistency", "medium", "SELECT channel, COALESCE(score < 0.8, false)::INTEGER AS h FROM cross_source", 2),
]), "full_panel", "limits", "zs", "iqr_levels", "steps", "cross_source")
cte("rule_results", """SELECT rule_name, severity, lv, sum(h) = 0 AS passed, CAST(sum(h) AS BIGINT) AS affected_records, CAST(count_if(h > 0) AS BIGINT) AS affected_channels
 FROM rule_hits GROUP BY ALL""", "rule_hits")


def _validated(spark, sf, level="comprehensive"):
    return Q.validate(X.full_panel(spark, sf), level, X.JUNCTIONS, _OVER)


for _i, _level in enumerate(Q.LEVELS):
    @query(f"i1_validate_{_level}", f"SELECT * EXCLUDE lv FROM rule_results WHERE lv <= {_i}", "rule_results")
    def _(spark, sf, level=_level):
        return _validated(spark, sf, level)[1].select("rule_name", "severity", "passed", "affected_records", "affected_channels")


cte("junction_fair", """SELECT DISTINCT s.channel, s.week FROM steps s JOIN bad_entities b ON b.channel = s.channel AND b.junction = s.junction""", "steps", "bad_entities")
cte("validated", """SELECT f.channel, f.week, f.views, CASE WHEN z.delta_views_z_outlier OR z.delta_subs_z_outlier OR i.views_iqr_outlier OR i.subs_iqr_outlier OR i.videos_iqr_outlier
 OR j.channel IS NOT NULL OR COALESCE(c.score < 0.8, false) THEN 'fair' ELSE f.data_quality_flag END AS data_quality_flag FROM full_panel f
 JOIN zs z ON z.channel = f.channel AND z.week = f.week JOIN iqr_levels i ON i.channel = f.channel AND i.week = f.week JOIN cross_source c ON c.channel = f.channel AND c.week = f.week
 LEFT JOIN junction_fair j ON j.channel = f.channel AND j.week = f.week""", "full_panel", "zs", "iqr_levels", "cross_source", "junction_fair")


@query("i1_validate_flagged", "SELECT * FROM validated", "validated")
def _(spark, sf):
    return _validated(spark, sf)[0].select("channel", "week", "views", "data_quality_flag")


def _text_panel(spark, sf):
    p = X.full_panel(spark, sf)
    return p.select("channel", F.when(F.col("subs") % 13 == 2, F.lit("soon")).otherwise(F.col("week").cast("string")).alias("datetime"),
                    F.when(F.col("subs") % 7 == 3, F.lit("n/a")).otherwise(F.col("views").cast("string")).alias("views"), F.col("subs").cast("string").alias("subs"))


@query("i1_reduced_weeks", f"""SELECT channel, week, count(*) OVER (PARTITION BY channel, week) AS copies, data_quality_flag, collection_source, views FROM observations
 QUALIFY row_number() OVER (PARTITION BY channel, week ORDER BY {QRANK} DESC, {SRANK} DESC, views DESC) = 1""", "observations")
def _(spark, sf):
    return Q.reduced_weeks(X.observations(spark, sf)).select("channel", "week", F.col(Q.COPIES).alias("copies"), "data_quality_flag", "collection_source", "views")


@query("i2_schema_check", """SELECT 'data_types' AS rule_name, 'medium' AS severity, sum(b) = 0 AS passed, CAST(sum(b) AS BIGINT) AS affected_records
 FROM (SELECT (subs % 13 = 2)::INTEGER + (subs % 7 = 3)::INTEGER AS b FROM full_panel) UNION ALL SELECT 'required_fields', 'high', false, 0""", "full_panel")
def _(spark, sf):
    return Q.schema_check(_text_panel(spark, sf))[1].select("rule_name", "severity", "passed", "affected_records")


@query("i2_schema_repair", """SELECT channel, CASE WHEN subs % 13 = 2 THEN NULL ELSE week END AS datetime, CASE WHEN subs % 7 = 3 THEN 0 ELSE views END AS views, subs FROM full_panel""", "full_panel")
def _(spark, sf):
    return Q.schema_check(_text_panel(spark, sf))[0].withColumn("datetime", F.col("datetime").cast("date"))


@query("i3_date_range_check", f"SELECT CAST(sum({_RANGE}) AS BIGINT) AS out_of_range, min(week) AS earliest_found, max(week) AS latest_found FROM panel", "panel")
def _(spark, sf):
    return Q.date_range_check(X.panel(spark, sf), "1996-01-01", "2001-06-30")


cte("quality", """SELECT n AS total_records, greatest(n - a, 0) AS valid_records, ce + he + me + le AS validation_errors, ce AS critical_errors, he AS high_errors, me AS medium_errors, le AS low_errors,
 1.0::DOUBLE - least((ce * 0.4 + he * 0.3 + me * 0.2 + le * 0.1) / n, 0.1) AS quality_score, 1.0::DOUBLE AS completeness_score, greatest(1.0::DOUBLE - cs / n, 0.0) AS consistency_score,
 greatest(1.0::DOUBLE - tm / n, 0.0) AS temporal_score FROM (SELECT count(*) AS n FROM full_panel), (SELECT CAST(COALESCE(sum(affected_records), 0) AS BIGINT) AS a,
 CAST(count_if(NOT passed AND severity = 'critical') AS BIGINT) AS ce, CAST(count_if(NOT passed AND severity = 'high') AS BIGINT) AS he, CAST(count_if(NOT passed AND severity = 'medium') AS BIGINT) AS me,
 CAST(count_if(NOT passed AND severity = 'low') AS BIGINT) AS le, CAST(sum(CASE WHEN rule_name = 'cross_source_consistency' THEN affected_records ELSE 0 END) AS BIGINT) AS cs,
 CAST(sum(CASE WHEN rule_name IN ('weekly_granularity', 'date_range') THEN affected_records ELSE 0 END) AS BIGINT) AS tm FROM rule_results)""", "full_panel", "rule_results")


@query("i4_quality_metrics", f"""SELECT * REPLACE (round(quality_score, 6) AS quality_score, round(consistency_score, 6) AS consistency_score, round(temporal_score, 6) AS temporal_score),
 (SELECT {_MAP_SQL} FROM (SELECT data_quality_flag AS v, count(*) AS n FROM validated GROUP BY 1)) AS quality_flags FROM quality""", "quality", "validated")
def _(spark, sf):
    m = _validated(spark, sf)[2]
    return r6(m.withColumn("quality_flags", _map("quality_flags")), "quality_score", "completeness_score", "consistency_score", "temporal_score")


@query("i5_recommendations", f"""SELECT concat_ws('; ', CASE WHEN critical_errors > 0 THEN '{Q.RECOMMEND_CRITICAL}' END, CASE WHEN quality_score < 0.7 THEN '{Q.RECOMMEND_SCORE}' END,
 CASE WHEN (SELECT count(*) FROM rule_results WHERE rule_name = 'junction_continuity' AND NOT passed) > 0 THEN '{Q.RECOMMEND_JUNCTION}' END,
 CASE WHEN (SELECT count(*) FROM rule_results WHERE rule_name = 'weekly_granularity' AND NOT passed) > 0 THEN '{Q.RECOMMEND_WEEKLY}' END) AS recommendations FROM quality""", "quality", "rule_results")
def _(spark, sf):
    _, results, metrics = _validated(spark, sf)
    return Q.recommendations(metrics, results).select(joined("recommendations").alias("recommendations"))


@query("i6_validation_report", """SELECT (SELECT count(*) FROM rule_results) AS rules, (SELECT count(*) FROM rule_results WHERE NOT passed) AS failed,
 (SELECT CAST(sum(affected_records) AS BIGINT) FROM rule_results) AS affected, valid_records,
 (SELECT string_agg(concat(rule_name, '=', affected_records), '; ' ORDER BY rule_name) FROM rule_results) AS by_rule FROM quality""", "quality", "rule_results")
def _(spark, sf):
    _, results, metrics = _validated(spark, sf)
    r = Q.validation_report(results, metrics)
    by_rule = F.transform("validation_results", lambda x: F.concat(x["rule_name"], F.lit("="), x["affected_records"].cast("string")))
    return r.select(F.col("validation_summary.total_rules_checked").alias("rules"), F.col("validation_summary.rules_failed").alias("failed"),
                    F.col("validation_summary.total_records_affected").alias("affected"), F.col("quality_metrics.valid_records").alias("valid_records"),
                    joined(by_rule).alias("by_rule"))


@query("a9_flatten_report", """SELECT 'quality_metrics' AS Category, unnest(['total_records', 'valid_records', 'validation_errors', 'critical_errors', 'high_errors', 'medium_errors', 'low_errors']) AS Metric,
 unnest([total_records, valid_records, validation_errors, critical_errors, high_errors, medium_errors, low_errors])::VARCHAR AS Value FROM quality
 UNION ALL SELECT 'quality_flags', data_quality_flag, CAST(count(*) AS VARCHAR) FROM validated GROUP BY ALL UNION ALL SELECT 'General', 'title', 'panel'""", "quality", "validated")
def _(spark, sf):
    _, results, metrics = _validated(spark, sf)
    report = Q.validation_report(results, metrics)
    counts = [c for c in metrics.columns if c.endswith(("records", "errors"))]
    picked = report.select(F.struct(*[F.col(f"quality_metrics.{c}") for c in counts]).alias("quality_metrics"), "quality_flags", F.lit("panel").alias("title"))
    return flatten_report(picked)


SCORES_SQL = f"""WITH f AS (SELECT *, (views IS NOT NULL)::INTEGER + (subs IS NOT NULL)::INTEGER + (category IS NOT NULL)::INTEGER + (videos IS NOT NULL)::INTEGER AS full4 FROM full_panel),
b AS (SELECT f.channel, avg(full4 / 4.0) AS completeness, 1.0::DOUBLE - count_if(z.delta_views_z_outlier OR z.delta_subs_z_outlier OR i.delta_views_iqr_outlier OR i.delta_subs_iqr_outlier) / count(*) AS statistical,
 max(f.week) AS lw, arg_max(f.collection_source, f.week) AS ls FROM f JOIN zs z ON z.channel = f.channel AND z.week = f.week JOIN iqr i ON i.channel = f.channel AND i.week = f.week GROUP BY f.channel),
t AS (SELECT channel, 1.0::DOUBLE - count_if(COALESCE(g < 4 OR g > 10, false)) / count(*) AS temporal FROM (SELECT channel, week - lag(week) OVER ({_P}) AS g FROM full_panel) GROUP BY channel),
c AS (SELECT b.channel, completeness, 1.0::DOUBLE - (SELECT count(*) FROM bad_entities x WHERE x.channel = b.channel) / 2.0 AS continuity, statistical, temporal,
 CASE WHEN age <= lim THEN 1.0::DOUBLE ELSE greatest(0.0, least(1.0, 1.0 - (age - lim) / (168.0 - lim)))::DOUBLE END AS freshness
 FROM (SELECT *, (DATE '2001-11-06' - lw) * 24.0 AS age, CASE ls WHEN 'VIEWSTATS' THEN 72.0 ELSE 24.0 END AS lim FROM b) b JOIN t ON t.channel = b.channel),
s AS (SELECT *, completeness * 0.25 + continuity * 0.30 + statistical * 0.20 + temporal * 0.15 + freshness * 0.10 AS score FROM c)
SELECT channel, round(completeness, 6) AS completeness, round(continuity, 6) AS continuity, round(statistical, 6) AS statistical, round(temporal, 6) AS temporal, round(freshness, 6) AS freshness, round(score, 6) AS score,
 CASE WHEN score >= 0.95 THEN 'excellent' WHEN score >= 0.85 THEN 'good' WHEN score >= 0.75 THEN 'fair' WHEN score >= 0.6 THEN 'poor' ELSE 'missing' END AS grade FROM s"""
SCORES_CTES = ("full_panel", "zs", "iqr", "bad_entities")


@query("i7_composite_score", SCORES_SQL, *SCORES_CTES)
def _(spark, sf):
    out = Q.composite_score(X.full_panel(spark, sf), date(2001, 11, 6), X.JUNCTIONS)
    return r6(out, "completeness", "continuity", "statistical", "temporal", "freshness", "score")


@query("i8_freshness", """WITH l AS (SELECT channel, max(week) AS last_week, arg_max(s, week) AS source FROM (SELECT *, CASE CAST(substr(channel, 2) AS BIGINT) % 3 WHEN 0 THEN 'API' WHEN 1 THEN collection_source ELSE 'WAYBACK_UPLOADS' END AS s FROM panel) GROUP BY channel),
a AS (SELECT *, CAST((DATE '2001-11-03' - last_week) * 24.0 AS DOUBLE) AS age_hours, CASE source WHEN 'API' THEN 24.0 WHEN 'FINAL_API' THEN 24.0 WHEN 'VIEWSTATS' THEN 72.0 END::DOUBLE AS limit_hours FROM l)
SELECT *, round(CASE WHEN age_hours <= limit_hours THEN 1.0 WHEN limit_hours IS NOT NULL THEN greatest(0.0, least(1.0, 1.0 - (age_hours - limit_hours) / (168.0 - limit_hours))) END, 6) AS freshness_score,
 CASE WHEN limit_hours IS NULL THEN 'historical' WHEN age_hours <= limit_hours THEN 'fresh' WHEN age_hours > 48 THEN 'poor' ELSE 'stale' END AS status FROM a""", "panel")
def _(spark, sf):
    m = F.substring("channel", 2, 20).cast("bigint") % 3
    p = X.panel(spark, sf).withColumn("collection_source", F.when(m == 0, F.lit("API")).when(m == 1, F.col("collection_source")).otherwise(F.lit("WAYBACK_UPLOADS")))
    return r6(Q.freshness(p, date(2001, 11, 3)), "freshness_score")


@query("i9_resolve_precedence", f"""SELECT channel, week, collection_source, views, subs FROM observations QUALIFY row_number() OVER (PARTITION BY channel, week ORDER BY {SRANK} DESC, views DESC, subs DESC) = 1""", "observations")
def _(spark, sf):
    return Q.resolve_conflicts(X.observations(spark, sf))


@query("i9_resolve_weighted", """WITH p AS (SELECT channel, week, collection_source, CASE collection_source WHEN 'API' THEN 4.0 WHEN 'VIEWSTATS' THEN 3.0 ELSE 2.0 END::DOUBLE AS w, avg(views) AS v, avg(subs) AS s FROM observations GROUP BY ALL)
SELECT channel, week, count(*) AS sources, round(sum(v * w) / sum(w), 3) AS views, round(sum(s * w) / sum(w), 3) AS subs FROM p GROUP BY channel, week""", "observations")
def _(spark, sf):
    out = Q.resolve_conflicts(X.observations(spark, sf), "weighted")
    return out.withColumns({"views": F.round("views", 3), "subs": F.round("subs", 3)})


@query("i10_phase_gate", """SELECT phase, round(e, 6) AS error_rate, CASE WHEN e >= 0.15 THEN 'halt' WHEN 1 - e >= 0.9 AND e <= 0.05 THEN 'pass' ELSE 'warn' END AS gate FROM (SELECT collector AS phase, 1.0::DOUBLE - count_if(ok) / count(*) AS e FROM
 (SELECT *, event_type <> 'error' OR user_id % 11 < 8 AND event_id % 5 <> 1 AS ok, concat(event_type, CAST(event_id % 4 AS VARCHAR)) AS collector FROM events) GROUP BY 1)""")
def _(spark, sf):
    ok = (F.col("event_type") != "error") | ((F.col("user_id") % 11 < 8) & (F.col("event_id") % 5 != 1))
    e = X.table(spark, sf, "events").groupBy(F.concat("event_type", (F.col("event_id") % 4).cast("string")).alias("phase")).agg(
        F.count(F.lit(1)).alias("channels_processed"), F.count_if(ok).alias("channels_successful"))
    return r6(Q.phase_gate(e).select("phase", "error_rate", "gate"), "error_rate")


@query("i11_alerts", """WITH m AS (SELECT (SELECT count_if(NOT success) / count(*) FROM collector_events) AS er, (SELECT count_if(data_quality_flag = 'fair') / count(*) FROM validated) AS fs,
 (SELECT count(*) FROM bad_entities)::DOUBLE AS jf, (SELECT quality_score FROM quality) AS qs)
SELECT alert, severity, round(CAST(value AS DOUBLE), 6) AS value FROM (SELECT 'junction_validation_failure' AS alert, 'CRITICAL' AS severity, jf AS value, jf > 0 AS r FROM m UNION ALL SELECT 'error_rate', 'HIGH', er, er > 0.1 FROM m
 UNION ALL SELECT 'quality_flags', 'MEDIUM', fs, fs > 0.05 FROM m UNION ALL SELECT 'quality_score', 'MEDIUM', qs, qs < 0.9 FROM m UNION ALL SELECT 'success_rate', 'LOW', 1 - er, 1 - er >= 0.9 FROM m) WHERE r""",
       "collector_events", "validated", "bad_entities", "quality")
def _(spark, sf):
    from weekloom.operators.junctions import junction_continuity
    flagged, _, metrics = _validated(spark, sf)
    n = F.count(F.lit(1)).cast("double")
    err = X.collector_events(spark, sf).agg((F.count_if(~F.col("success")) / n).alias("error_rate"), (F.count_if("success") / n).alias("success_rate"))
    share = flagged.agg((F.count_if(F.col("data_quality_flag") == "fair") / n).alias("flagged_share"))
    failures = junction_continuity(X.panel(spark, sf), X.JUNCTIONS).agg(F.sum("bad_entities").alias("junction_failures"))
    return r6(Q.alerts(A.one_row(err, share, failures, metrics.select("quality_score"))), "value")


@query("i12_data_flags", """SELECT channel, week, CASE WHEN views IS NULL AND subs IS NULL THEN 'MISSING' WHEN views < 0 OR subs < 0 OR videos < 0 THEN 'INVALID' WHEN views IS NULL OR subs IS NULL OR videos IS NULL THEN 'PARTIAL'
 WHEN subs % 17 = 5 THEN 'INTERPOLATED' WHEN data_quality_flag IN ('fair', 'poor', 'missing') THEN 'SUSPICIOUS' WHEN DATE '2001-11-04' - week > 700 THEN 'OUTDATED' ELSE 'COMPLETE' END AS data_flag FROM defects""", "defects")
def _(spark, sf):
    d = X.defects(spark, sf).withColumn("interpolated", F.col("subs") % 17 == 5)
    return Q.data_flags(d, date(2001, 11, 4), 700).select("channel", "week", "data_flag")


@query("i13_impute", f"""WITH l AS (SELECT *, last_value(CASE WHEN views IS NOT NULL THEN week END IGNORE NULLS) OVER p AS lt, last_value(views IGNORE NULLS) OVER p AS lv FROM spine_panel WINDOW p AS ({_P} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
m AS (SELECT category, week, quantile_cont((views - lv) / lv, 0.5) AS g FROM l WHERE views IS NOT NULL AND lv > 0 GROUP BY ALL)
SELECT channel, l.category, l.week, CASE WHEN views IS NOT NULL THEN views WHEN l.week - lt <= 14 THEN lv ELSE CAST(trunc(lv * (1.0 + COALESCE(g, 0.0))) AS BIGINT) END AS views,
 CASE WHEN views IS NOT NULL THEN 'observed' WHEN l.week - lt <= 14 THEN 'history' WHEN lt IS NOT NULL THEN 'peers' ELSE 'none' END AS method,
 CASE WHEN views IS NOT NULL THEN 1.0 WHEN l.week - lt <= 14 THEN 0.8 WHEN lt IS NOT NULL THEN 0.5 ELSE 0.0 END::DOUBLE AS confidence FROM l LEFT JOIN m ON m.category = l.category AND m.week = l.week""", "spine_panel")
def _(spark, sf):
    return Q.impute(X.spine_panel(spark, sf))


@query("i14_manual_review", f"""WITH r AS (SELECT i.channel, i.week, COALESCE(j.h, 0) > 0 AS jv, delta_views_iqr_outlier OR delta_subs_iqr_outlier AS o, COALESCE(p > 0 AND subs < p, false) AS ng FROM
 (SELECT *, lag(subs) OVER ({_P}) AS p FROM iqr) i LEFT JOIN (SELECT channel, week, sum(h) AS h FROM (
 {" UNION ALL ".join(f'''SELECT channel, week, (COALESCE(abs(subs - lag(subs) OVER ({_P})) / lag(subs) OVER ({_P}) * 100 > 15, false)::INTEGER + COALESCE(abs(views - lag(views) OVER ({_P})) / lag(views) OVER ({_P}) * 100 > 15, false)::INTEGER) AS h
 FROM full_panel WHERE week BETWEEN DATE '{d}' - 14 AND DATE '{d}' + 14''' for d in (X.J1, X.J2))}) GROUP BY 1, 2) j ON j.channel = i.channel AND j.week = i.week)
SELECT channel, week, concat_ws('; ', CASE WHEN jv THEN 'junction_variance' END, CASE WHEN o THEN 'outlier' END, CASE WHEN ng THEN 'negative_growth' END) AS reasons FROM r WHERE jv OR o OR ng""", "iqr", "full_panel")
def _(spark, sf):
    return Q.manual_review(X.full_panel(spark, sf), X.JUNCTIONS).withColumn("reasons", joined("reasons"))


@query("i15_dimension_gate", """WITH m AS (SELECT avg(((channel IS NOT NULL)::INTEGER + (week IS NOT NULL)::INTEGER + (views IS NOT NULL)::INTEGER + (subs IS NOT NULL)::INTEGER) / 4.0) AS c, CAST(count_if(COALESCE(views >= 0 AND subs >= 0 AND videos >= 0, false)) / count(*) AS DOUBLE) AS f,
 CAST((DATE '2001-11-05' - max(week)) * 24.0 AS DOUBLE) AS t FROM defects), a AS (SELECT COALESCE(avg(score), 1.0)::DOUBLE AS a FROM cross_source_defects)
SELECT 'completeness' AS dimension, round(c, 6) AS value, 0.95::DOUBLE AS threshold, 'high' AS criticality, c >= 0.95 AS passed FROM m UNION ALL SELECT 'accuracy', round(a, 6), 0.9, 'high', a >= 0.9 FROM a
 UNION ALL SELECT 'consistency', round(f, 6), 0.98, 'medium', f >= 0.98 FROM m UNION ALL SELECT 'timeliness', round(t, 6), 24.0, 'medium', t <= 24 FROM m""", "defects", "cross_source_defects")
def _(spark, sf):
    return r6(Q.dimension_gate(X.defects(spark, sf), date(2001, 11, 5)), "value")
