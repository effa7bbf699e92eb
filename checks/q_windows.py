"""Sections E and F: per-entity windows, duplicates, junctions, gaps, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as X
from checks.q_scalars import SCORE_SQL
from checks.registry import cte, joined, query, r6
from weekloom.operators import junctions as J, ranking as R, series, windows as W

_P = "PARTITION BY channel ORDER BY week"


@query("e1_deltas", "SELECT channel, week, delta_views, delta_subs, delta_videos FROM full_panel", "full_panel")
def _(spark, sf):
    return W.deltas(X.panel(spark, sf)).select("channel", "week", "delta_views", "delta_subs", "delta_videos")


@query("e2_growth_rates", f"""SELECT channel, week, round(COALESCE(CASE WHEN ps > 0 THEN (subs - ps) / ps END, 0), 6) AS subs_growth,
 round(COALESCE(CASE WHEN pv > 0 THEN (views - pv) / pv END, 0), 6) AS views_growth, COALESCE(videos - pn, 0) AS videos_growth
 FROM (SELECT *, lag(subs) OVER w AS ps, lag(views) OVER w AS pv, lag(videos) OVER w AS pn FROM panel WINDOW w AS ({_P}))""", "panel")
def _(spark, sf):
    return r6(W.growth_rates(X.panel(spark, sf)), "subs_growth", "views_growth").select("channel", "week", "subs_growth", "views_growth", "videos_growth")


QRANK = "CASE data_quality_flag WHEN 'excellent' THEN 5 WHEN 'good' THEN 4 WHEN 'fair' THEN 3 WHEN 'poor' THEN 2 WHEN 'missing' THEN 1 ELSE 0 END"
SRANK = """CASE collection_source WHEN 'FINAL_API' THEN 5 WHEN 'API' THEN 4 WHEN 'VIEWSTATS' THEN 3 WHEN 'WAYBACK_UPLOADS' THEN 2
 WHEN 'WAYBACK_CHARTS' THEN 1 ELSE 0 END"""


@query("e3_dedup_weekly", f"""SELECT * FROM observations QUALIFY row_number() OVER (PARTITION BY channel, week ORDER BY {QRANK} DESC, {SRANK} DESC,
 obs_date DESC, views DESC, subs DESC) = 1""", "observations")
def _(spark, sf):
    return R.dedup_weekly(X.observations(spark, sf), t="obs_date")


@query("e4_best_duplicate", """SELECT * FROM observations QUALIFY row_number() OVER (PARTITION BY channel, obs_date
 ORDER BY CASE WHEN views > 0 THEN 1000.0::DOUBLE ELSE 0.0::DOUBLE END + views / 1000000.0::DOUBLE + subs / 1000.0::DOUBLE DESC, week DESC, views DESC, subs DESC, collection_source DESC,
 data_quality_flag DESC) = 1""", "observations")
def _(spark, sf):
    return R.best_duplicate(X.observations(spark, sf))


@query("e5_first_per_week", """SELECT * FROM observations QUALIFY row_number() OVER (PARTITION BY channel, week
 ORDER BY obs_date, views DESC, subs DESC, collection_source DESC, data_quality_flag DESC) = 1""", "observations")
def _(spark, sf):
    return R.first_per_week(X.observations(spark, sf))


def _iqr_sql(metrics, k=1.5):
    q = ", ".join(f"quantile_cont({m}, 0.25) OVER (PARTITION BY channel) AS q1_{m}, quantile_cont({m}, 0.75) OVER (PARTITION BY channel) AS q3_{m}" for m in metrics)
    hits = ", ".join(f"n >= 4 AND ({m} < q1_{m} - {k} * (q3_{m} - q1_{m}) OR {m} > q3_{m} + {k} * (q3_{m} - q1_{m})) AS {m}_iqr_outlier" for m in metrics)
    return f"SELECT *, {hits} FROM (SELECT *, count(*) OVER (PARTITION BY channel) AS n, {q} FROM full_panel)"


def _z_sql(metrics):
    s = ", ".join(f"avg({m}) OVER (PARTITION BY channel) AS a_{m}, stddev_pop({m}) OVER (PARTITION BY channel) AS d_{m}" for m in metrics)
    hits = ", ".join(f"COALESCE(d_{m} > 0 AND n >= 4 AND abs({m} - a_{m}) / NULLIF(d_{m}, 0) > 3, false) AS {m}_z_outlier" for m in metrics)
    return f"SELECT *, {hits} FROM (SELECT *, count(*) OVER (PARTITION BY channel) AS n, {s} FROM full_panel)"


cte("iqr", _iqr_sql(["delta_views", "delta_subs"]), "full_panel")
cte("iqr_levels", _iqr_sql(["views", "subs", "videos"]), "full_panel")
cte("zs", _z_sql(["delta_views", "delta_subs"]), "full_panel")


@query("e6_iqr_outliers", """SELECT channel, week, delta_views_iqr_outlier, delta_subs_iqr_outlier,
 CASE WHEN delta_views_iqr_outlier OR delta_subs_iqr_outlier THEN 'fair' ELSE data_quality_flag END AS data_quality_flag FROM iqr""", "iqr")
def _(spark, sf):
    return W.iqr_outliers(X.full_panel(spark, sf)).select("channel", "week", "delta_views_iqr_outlier", "delta_subs_iqr_outlier", "data_quality_flag")


@query("e6_iqr_outliers_levels", "SELECT channel, week, views_iqr_outlier, subs_iqr_outlier, videos_iqr_outlier FROM iqr_levels", "iqr_levels")
def _(spark, sf):
    m = ["views", "subs", "videos"]
    return W.iqr_outliers(X.full_panel(spark, sf), m).select("channel", "week", *[f"{x}_iqr_outlier" for x in m])


@query("e7_zscore_outliers", """SELECT channel, week, delta_views_z_outlier, delta_subs_z_outlier,
 CASE WHEN delta_views_z_outlier OR delta_subs_z_outlier THEN 'fair' ELSE data_quality_flag END AS data_quality_flag FROM zs""", "zs")
def _(spark, sf):
    return W.zscore_outliers(X.full_panel(spark, sf)).select("channel", "week", "delta_views_z_outlier", "delta_subs_z_outlier", "data_quality_flag")


@query("e8_weekly_granularity", f"""SELECT channel, week, CAST(g AS INTEGER) AS gap_days, COALESCE(g < 4 OR g > 10, false) AS off_rhythm
 FROM (SELECT *, week - lag(week) OVER ({_P}) AS g FROM panel)""", "panel")
def _(spark, sf):
    return W.weekly_granularity(X.panel(spark, sf)).select("channel", "week", "gap_days", "off_rhythm")


# one junction's in-window steps: the window filter comes before the lag
def _steps_sql(name, day, tol, days):
    return f"""SELECT channel, week, '{name}' AS junction,
 COALESCE(CASE WHEN ps > 0 THEN abs(subs - ps) / ps * 100 > {tol} END, false)::INTEGER + COALESCE(CASE WHEN pv > 0 THEN abs(views - pv) / pv * 100 > {tol} END, false)::INTEGER AS hits
 FROM (SELECT *, lag(subs) OVER ({_P}) AS ps, lag(views) OVER ({_P}) AS pv FROM full_panel
  WHERE week BETWEEN DATE '{day}' - {days} AND DATE '{day}' + {days})"""


cte("steps", " UNION ALL ".join(_steps_sql(j.name, j.day, j.tolerance, 14) for j in X.JUNCTIONS), "full_panel")
cte("bad_entities", "SELECT channel, junction FROM steps GROUP BY ALL HAVING sum(hits) > 0", "steps")


@query("e9_junction_continuity", """SELECT junction, CAST(sum(h) AS BIGINT) AS bad_pairs, CAST(count_if(h > 0) AS BIGINT) AS bad_entities
 FROM (SELECT junction, channel, sum(hits) AS h FROM steps GROUP BY ALL) GROUP BY junction""", "steps")
def _(spark, sf):
    return J.junction_continuity(X.panel(spark, sf), X.JUNCTIONS)


@query("e9_flag_junctions", """SELECT p.channel, p.week, CASE WHEN s.channel IS NOT NULL THEN 'fair' ELSE data_quality_flag END AS data_quality_flag FROM full_panel p
 LEFT JOIN (SELECT DISTINCT s.channel, s.week FROM steps s JOIN bad_entities b ON b.channel = s.channel AND b.junction = s.junction) s
 ON s.channel = p.channel AND s.week = p.week""", "full_panel", "steps", "bad_entities")
def _(spark, sf):
    return J.flag_junctions(X.full_panel(spark, sf), X.JUNCTIONS).select("channel", "week", "data_quality_flag")


cte("cross_source", f"""SELECT *, CASE WHEN psrc IS NOT NULL AND psrc <> collection_source THEN
 1.0 - COALESCE((COALESCE(ds, 0) + COALESCE(dv, 0) + COALESCE(dn, 0)) / NULLIF((ds IS NOT NULL)::INTEGER + (dv IS NOT NULL)::INTEGER + (dn IS NOT NULL)::INTEGER, 0), 0) END AS score
 FROM (SELECT *, CASE WHEN ps > 0 THEN least(abs(subs - ps) / ps, 1.0) END AS ds, CASE WHEN pv > 0 THEN least(abs(views - pv) / pv, 1.0) END AS dv,
 CASE WHEN pn > 0 THEN least(abs(videos - pn) / pn, 1.0) END AS dn FROM (SELECT *, lag(subs) OVER w AS ps, lag(views) OVER w AS pv, lag(videos) OVER w AS pn,
 lag(collection_source) OVER w AS psrc FROM full_panel WINDOW w AS ({_P})))""", "full_panel")


@query("e10_cross_source_consistency", """SELECT channel, week, round(CAST(score AS DOUBLE), 6) AS consistency_score, COALESCE(score < 0.8, false) AS inconsistent,
 CASE WHEN score < 0.8 THEN 'fair' ELSE data_quality_flag END AS data_quality_flag FROM cross_source""", "cross_source")
def _(spark, sf):
    return r6(W.cross_source_consistency(X.full_panel(spark, sf)), "consistency_score").select(
        "channel", "week", "consistency_score", "inconsistent", "data_quality_flag")


cte("limits", f"""SELECT *, COALESCE(n > 1 AND delta_subs / (ps + 1) > 0.2, false) AS sub_growth_hit, COALESCE(n > 1 AND delta_views / (pv + 1) > 0.5, false) AS view_growth_hit,
 n > 1 AND delta_videos > 50 AS upload_hit FROM (SELECT *, count(*) OVER (PARTITION BY channel) AS n, lag(subs) OVER w AS ps, lag(views) OVER w AS pv
 FROM full_panel WINDOW w AS ({_P}))""", "full_panel")


@query("e11_growth_limits", "SELECT channel, week, sub_growth_hit, view_growth_hit, upload_hit FROM limits", "limits")
def _(spark, sf):
    return W.growth_limits(X.full_panel(spark, sf)).select("channel", "week", "sub_growth_hit", "view_growth_hit", "upload_hit")


@query("e12_monotonic_check", f"""SELECT channel, week, COALESCE(p > 0 AND p - v > p * 0.02::DOUBLE, false) AS videos_decreased FROM (SELECT channel, week, v, lag(v) OVER ({_P}) AS p
 FROM (SELECT channel, week, CASE WHEN subs % 9 = 4 THEN videos // 2 ELSE videos END AS v FROM panel))""", "panel")
def _(spark, sf):
    rows = X.panel(spark, sf).withColumn("videos", F.expr("CASE WHEN subs % 9 = 4 THEN videos div 2 ELSE videos END"))
    return W.monotonic_check(rows).select("channel", "week", "videos_decreased")


@query("e13_jump_reset", f"""SELECT channel, week, CASE WHEN p > 0 AND v > p * 10.0::DOUBLE THEN 'spike' WHEN p > 0 AND v < p * 0.98::DOUBLE THEN 'reset' ELSE 'none' END AS views_event
 FROM (SELECT channel, week, v, lag(v) OVER ({_P}) AS p FROM (SELECT channel, week, CASE subs % 11 WHEN 4 THEN views // 2 WHEN 7 THEN views * 40 ELSE views END AS v FROM panel))""", "panel")
def _(spark, sf):
    rows = X.panel(spark, sf).withColumn("views", F.expr("CASE subs % 11 WHEN 4 THEN views div 2 WHEN 7 THEN views * 40 ELSE views END"))
    return W.jump_reset(rows).select("channel", "week", "views_event")


@query("e14_promote_latest", f"""SELECT channel, week, CASE WHEN l THEN 'FINAL_API' ELSE collection_source END AS collection_source,
 CASE WHEN l THEN 'excellent' ELSE data_quality_flag END AS data_quality_flag FROM (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY week DESC) = 1
 AND week >= DATE '2001-10-07' - 7 AS l FROM full_panel)""", "full_panel")
def _(spark, sf):
    return R.promote_latest(X.full_panel(spark, sf), "2001-10-07").select("channel", "week", "collection_source", "data_quality_flag")


@query("e15_spread_snapshots", """WITH o AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY timestamp, digest) - 1 AS pos, count(*) OVER (PARTITION BY channel) AS total
 FROM snapshot_index WHERE statuscode = '200')
SELECT channel, timestamp, original, statuscode, digest, pos FROM o WHERE total <= 10 OR list_contains([CAST(floor(i * total / 10.0::DOUBLE) AS BIGINT) FOR i IN range(10)], pos)""", "snapshot_index")
def _(spark, sf):
    return R.spread_snapshots(X.snapshot_index(spark, sf)).withColumn("pos", F.col("pos").cast("bigint"))


@query("e16_weekly_snapshots", """WITH w AS (SELECT *, CAST(date_trunc('week', strptime(timestamp, '%Y%m%d%H%M%S')) AS DATE) AS iso_week FROM snapshot_index WHERE statuscode = '200'),
f AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY channel, iso_week ORDER BY timestamp, digest) = 1)
SELECT channel, iso_week, timestamp, digest, original, statuscode FROM f""", "snapshot_index")
def _(spark, sf):
    return R.weekly_snapshots(X.snapshot_index(spark, sf))


_G = f"SELECT *, COALESCE(CASE WHEN p > 0 THEN (views - p) / p END, 0) AS growth FROM (SELECT *, lag(views) OVER ({_P}) AS p FROM panel)"


@query("e17_rolling_growth", f"""SELECT channel, week, round(growth, 6) AS growth, round(rg, 6) AS rolling_growth, COALESCE(sd > 0 AND abs(growth - m) / NULLIF(sd, 0) > 2.5, false) AS growth_outlier
 FROM (SELECT *, avg(growth) OVER ({_P} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS rg, avg(growth) OVER (PARTITION BY channel) AS m,
 stddev_pop(growth) OVER (PARTITION BY channel) AS sd FROM ({_G}))""", "panel")
def _(spark, sf):
    return r6(W.rolling_growth(X.panel(spark, sf)), "growth", "rolling_growth").select("channel", "week", "growth", "rolling_growth", "growth_outlier")


@query("e18_smooth", f"SELECT channel, week, round(avg(views) OVER ({_P} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), 4) AS views_smooth FROM panel", "panel")
def _(spark, sf):
    return W.smooth(X.panel(spark, sf)).select("channel", "week", F.round("views_smooth", 4).alias("views_smooth"))


@query("e19_fill", f"""WITH b AS (SELECT *, last_value(CASE WHEN views IS NOT NULL THEN week END IGNORE NULLS) OVER f AS bt, last_value(views IGNORE NULLS) OVER f AS bv, last_value(subs IGNORE NULLS) OVER f AS bs,
 last_value(videos IGNORE NULLS) OVER f AS bn, first_value(CASE WHEN views IS NOT NULL THEN week END IGNORE NULLS) OVER g AS nt, first_value(views IGNORE NULLS) OVER g AS av,
 first_value(subs IGNORE NULLS) OVER g AS asu, first_value(videos IGNORE NULLS) OVER g AS an FROM spine_panel
 WINDOW f AS ({_P} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), g AS ({_P} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT channel, week, CASE WHEN week - bt <= 14 THEN bv WHEN nt - week <= 14 THEN av END AS views, CASE WHEN week - bt <= 14 THEN bs WHEN nt - week <= 14 THEN asu END AS subs,
 CASE WHEN week - bt <= 14 THEN bn WHEN nt - week <= 14 THEN an END AS videos, views IS NULL AND COALESCE(week - bt <= 14 OR nt - week <= 14, false) AS filled FROM b""", "spine_panel")
def _(spark, sf):
    return series.fill(X.spine_panel(spark, sf)).select("channel", "week", "views", "subs", "videos", "filled")


cte("interpolated", """SELECT channel, obs_date + CAST(i AS INTEGER) * 7 AS obs_date, CASE WHEN i = 0 THEN upload_count
 ELSE greatest(CAST(trunc(upload_count + (v2 - upload_count) * (i / CAST(n + 1 AS DOUBLE))) AS BIGINT), upload_count) END AS upload_count, i > 0 AS interpolated,
 CASE WHEN i > 0 THEN CAST(obs_date AS VARCHAR) END AS from_snapshot, CASE WHEN i > 0 THEN CAST(i AS INTEGER) END AS step
 FROM (SELECT *, unnest(generate_series(0, n)) AS i FROM (SELECT *, CASE WHEN t2 - obs_date > 14 THEN greatest(1, (t2 - obs_date) // 7 - 1) ELSE 0 END AS n
 FROM (SELECT *, lead(obs_date) OVER w AS t2, lead(upload_count) OVER w AS v2 FROM uploads WINDOW w AS (PARTITION BY channel ORDER BY obs_date))))""", "uploads")


@query("e20_interpolate_weekly", "SELECT * FROM interpolated", "interpolated")
def _(spark, sf):
    s = F.col("interpolation_source")
    return series.interpolate_weekly(X.uploads(spark, sf)).select(
        "channel", "obs_date", "upload_count", "interpolated", s["from_snapshot"].alias("from_snapshot"), s["interpolation_step"].alias("step"))


@query("e21_extrapolate_to_current", f"""WITH l AS (SELECT u.channel, max(obs_date) AS t, arg_max(upload_count, obs_date) AS v, any_value(c) AS c FROM uploads u
 JOIN (SELECT channel, max(upload_count) + 900 AS c FROM uploads GROUP BY channel) m ON m.channel = u.channel GROUP BY u.channel),
x AS (SELECT *, DATE '{X.AS_OF}' - t AS gap FROM l WHERE DATE '{X.AS_OF}' - t > 30 AND c > v),
y AS (SELECT *, unnest(generate_series(1, (gap - 1) // 30 + 1)) AS i FROM x)
SELECT channel, CASE WHEN i <= (gap - 1) // 30 THEN t + CAST(i AS INTEGER) * 30 ELSE DATE '{X.AS_OF}' END AS obs_date,
 CASE WHEN i <= (gap - 1) // 30 THEN least(CAST(trunc(v + (c - v) / CAST(gap AS DOUBLE) * (i * 30)) AS BIGINT), c) ELSE c END AS upload_count,
 CASE WHEN i <= (gap - 1) // 30 THEN 'current_api_interpolated' ELSE 'youtube_api_current' END AS source, i <= (gap - 1) // 30 AS interpolated FROM y""", "uploads")
def _(spark, sf):
    u = X.uploads(spark, sf)
    cur = u.groupBy("channel").agg((F.max("upload_count") + 900).alias("current_count"))
    return series.extrapolate_to_current(u, cur, X.AS_OF)


@query("e22_winsorize_fence", """SELECT channel, week, delta_views AS delta_views_orig, round(CASE WHEN n >= 4 THEN least(greatest(delta_views, q1_delta_views - 1.5 * (q3_delta_views - q1_delta_views)),
 q3_delta_views + 1.5 * (q3_delta_views - q1_delta_views)) ELSE delta_views END, 4) AS delta_views FROM iqr""", "iqr")
def _(spark, sf):
    return W.winsorize(X.full_panel(spark, sf)).select("channel", "week", "delta_views_orig", F.round("delta_views", 4).alias("delta_views"))


@query("e22_winsorize_median", """SELECT channel, week, delta_views AS delta_views_orig, round(CASE WHEN delta_views_iqr_outlier THEN quantile_cont(delta_views, 0.5) OVER (PARTITION BY channel)
 ELSE CAST(delta_views AS DOUBLE) END, 4) AS delta_views FROM iqr""", "iqr")
def _(spark, sf):
    return W.winsorize(X.full_panel(spark, sf), "median").select("channel", "week", "delta_views_orig", F.round("delta_views", 4).alias("delta_views"))


@query("e23_junction_regression", f"""WITH f AS (SELECT channel, regr_slope(views, x) AS b, avg(views) AS a, avg(x) AS m FROM (SELECT *, week - DATE '1970-01-01' AS x FROM panel)
 WHERE week BETWEEN DATE '{X.J1}' - 28 AND DATE '{X.J1}' - 1 GROUP BY channel)
SELECT channel, week, actual, round(predicted, 3) AS predicted, round(CASE WHEN predicted > 0 THEN abs(actual - predicted) / predicted * 100 END, 4) AS variance_pct
 FROM (SELECT p.channel, week, views AS actual, a + b * (week - DATE '1970-01-01' - m) AS predicted FROM panel p JOIN f ON f.channel = p.channel
 WHERE week BETWEEN DATE '{X.J1}' AND DATE '{X.J1}' + 28) WHERE predicted IS NOT NULL AND NOT isnan(predicted)""", "panel")
def _(spark, sf):
    return J.junction_regression(X.panel(spark, sf), X.J1).select(
        "channel", "week", "actual", F.round("predicted", 3).alias("predicted"), F.round("variance_pct", 4).alias("variance_pct"))


@query("e25_junction_nearest", f"""SELECT channel, week, CAST(abs(week - DATE '{X.J1}') AS INTEGER) AS days_away, subs, views, videos FROM panel
 QUALIFY row_number() OVER (PARTITION BY channel ORDER BY abs(week - DATE '{X.J1}'), week) = 1""", "panel")
def _(spark, sf):
    return J.junction_nearest(X.panel(spark, sf), X.J1)


@query("e26_junction_pair_check", f"""WITH b AS (SELECT * FROM panel WHERE week <= DATE '{X.J1}' QUALIFY row_number() OVER (PARTITION BY channel ORDER BY week DESC) = 1),
a AS (SELECT p.* FROM panel p JOIN b ON b.channel = p.channel WHERE p.week >= DATE '{X.J1}' AND p.collection_source <> b.collection_source
 QUALIFY row_number() OVER (PARTITION BY p.channel ORDER BY p.week) = 1)
SELECT channel, before_week, after_week, CAST(g AS INTEGER) AS gap_days, round(sr, 6) AS subs_rate, round(vr, 6) AS views_rate, g <= 14 AND sr <= 0.05 AND vr <= 0.1 AS passed
 FROM (SELECT b.channel, b.week AS before_week, a.week AS after_week, a.week - b.week AS g, CASE WHEN b.subs > 0 THEN (a.subs - b.subs) / b.subs / greatest(a.week - b.week, 1) ELSE 0 END AS sr,
 CASE WHEN b.views > 0 THEN (a.views - b.views) / b.views / greatest(a.week - b.week, 1) ELSE 0 END AS vr FROM b JOIN a ON a.channel = b.channel)""", "panel")
def _(spark, sf):
    return r6(J.junction_pair_check(X.panel(spark, sf), X.J1), "subs_rate", "views_rate")


@query("e27_series_validity", f"""SELECT channel, points, round(mi, 6) AS mean_interval, drops, points >= 100 AND COALESCE(mi BETWEEN 6 AND 8, false) AND drops = 0 AS valid
 FROM (SELECT channel, count(*) AS points, avg(g) AS mi, CAST(count_if(subs < p * 0.9::DOUBLE) AS BIGINT) AS drops FROM (SELECT *, week - lag(week) OVER ({_P}) AS g, lag(subs) OVER ({_P}) AS p FROM panel) GROUP BY channel)""", "panel")
def _(spark, sf):
    return r6(W.series_validity(X.panel(spark, sf)), "mean_interval")


@query("e28_upload_series_validity", """SELECT *, reason = 'ok' AS valid FROM (SELECT *, CASE WHEN points > 1 AND last_count < first_count * 0.8::DOUBLE THEN 'decreased' WHEN max_count > 50000 THEN 'too_high' ELSE 'ok' END AS reason
 FROM (SELECT channel, count(*) AS points, arg_min(v, week) AS first_count, arg_max(v, week) AS last_count, max(v) AS max_count
 FROM (SELECT *, CASE WHEN CAST(substr(channel, 2) AS BIGINT) % 6 = 1 THEN 100000 - videos ELSE videos * 4 END AS v FROM panel) GROUP BY channel))""", "panel")
def _(spark, sf):
    rows = X.panel(spark, sf).withColumn("videos", F.expr("CASE WHEN CAST(substr(channel, 2) AS BIGINT) % 6 = 1 THEN 100000 - videos ELSE videos * 4 END"))
    return W.upload_series_validity(rows, max_count=50_000)


@query("e29_point_flags", f"""SELECT channel, week, concat_ws('; ', CASE WHEN subs < 0 OR views < 0 THEN 'negative_values' END, CASE WHEN abs(ds) > subs * 0.5 THEN 'large_subscriber_change' END,
 CASE WHEN abs(dv) > views * 0.5 THEN 'large_view_change' END, CASE WHEN subs = 0 AND views = 0 THEN 'zero_values' END) AS point_flags
 FROM (SELECT *, COALESCE(subs - lag(subs) OVER ({_P}), 0) AS ds, COALESCE(views - lag(views) OVER ({_P}), 0) AS dv FROM defects)""", "defects")
def _(spark, sf):
    return W.point_flags(X.defects(spark, sf)).select("channel", "week", joined("point_flags").alias("point_flags"))


@query("e29_upload_flags", """SELECT channel, obs_date, delta_uploads, concat_ws('; ', CASE WHEN interpolated THEN 'interpolated_data' END, CASE WHEN upload_count < 0 THEN 'negative_uploads' END,
 CASE WHEN abs(delta_uploads) > 1000 THEN 'large_upload_change' END, CASE WHEN delta_uploads < 0 AND interpolated THEN 'interpolated_decrease' END,
 CASE WHEN delta_uploads < 0 AND NOT interpolated THEN 'decreasing_uploads' END) AS quality_flags
 FROM (SELECT *, COALESCE(upload_count - lag(upload_count) OVER (PARTITION BY channel ORDER BY obs_date), 0) AS delta_uploads FROM interpolated)""", "interpolated")
def _(spark, sf):
    return W.upload_flags(series.interpolate_weekly(X.uploads(spark, sf))).select("channel", "obs_date", "delta_uploads", joined("quality_flags").alias("quality_flags"))


@query("e30_activity_status", f"""SELECT channel, week, CAST(wk AS INTEGER) AS weeks_since_upload, CASE WHEN l IS NULL THEN 'unknown' WHEN wk <= 1 THEN 'active' WHEN wk <= 2 THEN 'inactive' ELSE 'dormant' END AS activity
 FROM (SELECT *, (week - l) // 7 AS wk FROM (SELECT *, last_value(CASE WHEN delta_videos > 20 THEN week END IGNORE NULLS) OVER ({_P} ROWS UNBOUNDED PRECEDING) AS l FROM full_panel))""", "full_panel")
def _(spark, sf):
    rows = X.full_panel(spark, sf).withColumn("delta_videos", F.when(F.col("delta_videos") > 20, F.col("delta_videos")).otherwise(F.lit(0)))
    return W.activity_status(rows, active=1, dormant=2).select("channel", "week", "weeks_since_upload", "activity")


@query("e31_trend_deviation", f"""SELECT channel, week, round(dev, 3) AS trend_deviation, dev > 0.2 AS trend_outlier, step > 0.25 AS step_outlier FROM (SELECT channel, week,
 abs(views - (a + b * (x - m))) / NULLIF(abs(a + b * (x - m)), 0) AS dev, COALESCE(CASE WHEN p > 0 THEN abs(views - p) / p END, 0) AS step
 FROM (SELECT *, regr_slope(views, x) OVER (PARTITION BY channel) AS b, avg(views) OVER (PARTITION BY channel) AS a, avg(x) OVER (PARTITION BY channel) AS m, lag(views) OVER ({_P}) AS p
 FROM (SELECT *, week - DATE '1970-01-01' AS x FROM panel)))""", "panel")
def _(spark, sf):
    return W.trend_deviation(X.panel(spark, sf)).select("channel", "week", F.round("trend_deviation", 3).alias("trend_deviation"), "trend_outlier", "step_outlier")


for _unit in ("month", "quarter"):
    @query(f"e32_resample_{_unit}", f"""SELECT channel, CAST(date_trunc('{_unit}', week) AS DATE) AS period, week, views, subs, videos FROM panel
 QUALIFY row_number() OVER (PARTITION BY channel, date_trunc('{_unit}', week) ORDER BY week DESC) = 1""", "panel")
    def _(spark, sf, unit=_unit):
        return series.resample(X.panel(spark, sf), unit)


@query("f1_sort_panel", "SELECT channel, week, views FROM panel ORDER BY channel, week", "panel")
def _(spark, sf):
    return R.sort_panel(X.panel(spark, sf).select("channel", "week", "views"))


@query("f2_top_snapshots", f"""SELECT channel, timestamp, digest, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY s DESC, timestamp DESC, digest) AS rank
 FROM (SELECT *, {SCORE_SQL} AS s FROM snapshot_index) WHERE s > 0) WHERE rank <= 3""", "snapshot_index")
def _(spark, sf):
    return R.top_snapshots(X.snapshot_index(spark, sf), X.INDEX_END).select("channel", "timestamp", "digest", "rank")


@query("f4_sample_head", "SELECT channel, channel_name FROM entities ORDER BY channel LIMIT 7", "entities")
def _(spark, sf):
    return R.sample_head(X.entities(spark, sf), 7).select("channel", "channel_name")
