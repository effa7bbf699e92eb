"""Sections C and G: joins and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import fixtures as X
from checks.registry import ORACLES, joined, query, r6
from weekloom.operators import joins as J, projections, quantiles as Q, setops
from weekloom.session import cut_lineage
from weekloom.schema import BASE_COLUMNS


@query("a10_split_complete_incomplete", """SELECT p.channel, week, views, COALESCE(e.processing_status = 'enriched', false) AS complete
 FROM panel p LEFT JOIN enriched e ON e.channel = p.channel""", "panel", "enriched")
def _(spark, sf):
    good, rest = setops.split_complete_incomplete(X.panel(spark, sf), X.enriched(spark, sf))
    return (good.withColumn("complete", F.lit(True)).unionByName(rest.withColumn("complete", F.lit(False)))
            .select("channel", "week", "views", "complete"))


@query("c1_enrich_entities", """SELECT channel, category, channel_name, status, current_subs, current_views, current_videos, created_date, country,
 processing_status, flags FROM enriched""", "enriched")
def _(spark, sf):
    return X.enriched(spark, sf).select("channel", "category", "channel_name", "status", "current_subs", "current_views", "current_videos",
                                        "created_date", "country", "processing_status", joined("validation_flags").alias("flags"))


@query("c2_unexpected_items", "SELECT channel FROM api_items WHERE channel NOT IN (SELECT channel FROM entities)", "api_items", "entities")
def _(spark, sf):
    return J.unexpected_items(X.api_items(spark, sf), X.entities(spark, sf)).select("channel")


@query("c3_remaining", "SELECT channel, channel_name FROM entities WHERE k % 4 <> 0", "entities")
def _(spark, sf):
    return J.remaining(X.entities(spark, sf), X.done(spark, sf)).select("channel", "channel_name")


@query("c4_attach_metadata", """SELECT p.channel, week, COALESCE(i.channel_name, '') AS channel_name, COALESCE(i.country, p.category) AS category
 FROM panel p LEFT JOIN api_items i ON i.channel = p.channel""", "panel", "api_items")
def _(spark, sf):
    meta = X.api_items(spark, sf).select("channel", "channel_name", F.col("country").alias("category"))
    return J.attach_metadata(X.panel(spark, sf), meta).select("channel", "week", "channel_name", "category")


@query("c5_dense_spine", "SELECT channel, week FROM spine", "spine")
def _(spark, sf):
    return J.dense_spine(X.entities(spark, sf), *X.SPINE)


@query("c6_missing_weeks", "SELECT channel, week FROM spine_panel WHERE views IS NULL", "spine_panel")
def _(spark, sf):
    return J.missing_weeks(X.panel(spark, sf), J.dense_spine(X.entities(spark, sf), *X.SPINE))


@query("c6_missing_runs", """SELECT channel, min(week) AS gap_start, CAST(count(*) AS INTEGER) AS gap_weeks FROM (SELECT *, week - CAST(row_number() OVER (PARTITION BY channel ORDER BY week) AS INTEGER) * 7 AS island
 FROM spine_panel WHERE views IS NULL) GROUP BY channel, island""", "spine_panel")
def _(spark, sf):
    return J.missing_runs(X.panel(spark, sf), X.entities(spark, sf), *X.SPINE)


@query("c6_weeks_of_runs", "SELECT channel, week FROM spine_panel WHERE views IS NULL", "spine_panel")
def _(spark, sf):
    return J.weeks_of_runs(J.missing_runs(X.panel(spark, sf), X.entities(spark, sf), *X.SPINE))


@query("c7_asof_before", f"""SELECT channel, week, views, subs, videos FROM panel WHERE week < DATE '{X.J1}'
 QUALIFY row_number() OVER (PARTITION BY channel ORDER BY week DESC) = 1""", "panel")
def _(spark, sf):
    return J.asof_before(X.panel(spark, sf), X.J1)


# orders of an entity as the left times, the points of the panel as the right ones
_NEAR_LEFT = """(SELECT DISTINCT concat('S', lpad(CAST(o_custkey % 100 AS VARCHAR), 6, '0')) AS channel, CAST(o_orderdate AS DATE) AS t FROM orders)"""


@query("c8_nearest_join", f"""SELECT l.channel, l.t, COALESCE(CASE WHEN b.week IS NOT NULL AND l.t - b.week <= 5 AND (a.week IS NULL OR a.week - l.t > 5 OR l.t - b.week <= a.week - l.t)
  THEN b.subs WHEN a.week IS NOT NULL AND a.week - l.t <= 5 THEN a.subs END, 0) AS subs
 FROM {_NEAR_LEFT} l ASOF LEFT JOIN panel b ON b.channel = l.channel AND l.t >= b.week
 ASOF LEFT JOIN panel a ON a.channel = l.channel AND l.t <= a.week""", "panel")
def _(spark, sf):
    left = X.snapshot_index(spark, sf).select("channel", F.to_date(F.substring("timestamp", 1, 8), "yyyyMMdd").alias("t")).distinct()
    right = X.panel(spark, sf).select("channel", F.col("week").alias("t"), "subs")
    return J.nearest_join(left, right, "subs", tol_days=5)


@query("c9_asof_uploads", """WITH j AS (SELECT p.channel, p.week, p.videos, p.collection_source, u.upload_count FROM panel p
 ASOF LEFT JOIN uploads u ON u.channel = p.channel AND p.week >= u.obs_date),
v AS (SELECT channel, week, CASE WHEN collection_source = 'WAYBACK_CHARTS' AND upload_count IS NOT NULL THEN upload_count ELSE videos END AS videos,
 CASE WHEN collection_source = 'WAYBACK_CHARTS' AND upload_count IS NOT NULL THEN 'WAYBACK_UPLOADS' ELSE collection_source END AS collection_source FROM j)
SELECT *, COALESCE(videos - lag(videos) OVER (PARTITION BY channel ORDER BY week), 0) AS delta_videos FROM v""", "panel", "uploads")
def _(spark, sf):
    return J.asof_uploads(X.panel(spark, sf), X.uploads(spark, sf)).select("channel", "week", "videos", "collection_source", "delta_videos")


@query("c10_overlap_compare", """WITH o AS (SELECT channel, week, collection_source AS s, max(views) AS views, max(subs) AS subs FROM observations GROUP BY ALL)
SELECT channel, week, source_a, source_b, round(vd, 6) AS views_diff, round(sd, 6) AS subs_diff, vd > 0.15 OR sd > 0.15 AS exceeds FROM (
 SELECT a.channel, a.week, a.s AS source_a, b.s AS source_b,
  CASE WHEN a.views <> 0 THEN abs(b.views - a.views) / abs(a.views) WHEN b.views = 0 THEN 0.0 ELSE 1.0 END AS vd,
  CASE WHEN a.subs <> 0 THEN abs(b.subs - a.subs) / abs(a.subs) WHEN b.subs = 0 THEN 0.0 ELSE 1.0 END AS sd
 FROM o a JOIN o b ON a.channel = b.channel AND a.week = b.week AND a.s < b.s)""", "observations")
def _(spark, sf):
    return r6(J.overlap_compare(X.observations(spark, sf)), "views_diff", "subs_diff")


@query("c11_point_to_point_growth", f"""WITH s AS (SELECT channel, arg_max(subs, week) FILTER (week <= DATE '{X.J1}') AS a, arg_max(subs, week) AS b
 FROM panel WHERE week <= DATE '{X.J2}' GROUP BY channel)
SELECT s.channel, channel_name, category, a AS start_value, b AS end_value, round((b - a) / a, 6) AS growth
 FROM s JOIN entities e ON e.channel = s.channel WHERE a > 0 ORDER BY (b - a) / a DESC, s.channel LIMIT 100""", "panel", "entities")
def _(spark, sf):
    return r6(J.point_to_point_growth(X.panel(spark, sf).drop("category"), X.entities(spark, sf), X.J1, X.J2), "growth")


@query("c11_growth_in_category", f"""WITH s AS (SELECT channel, arg_max(subs, week) FILTER (week <= DATE '{X.J1}') AS a, arg_max(subs, week) AS b
 FROM panel WHERE week <= DATE '{X.J2}' GROUP BY channel)
SELECT s.channel, channel_name, category, a AS start_value, b AS end_value, round((b - a) / a, 6) AS growth
 FROM s JOIN entities e ON e.channel = s.channel WHERE a > 0 AND category = 'NATION_3' ORDER BY (b - a) / a DESC, s.channel LIMIT 100""", "panel", "entities")
def _(spark, sf):
    return r6(J.point_to_point_growth(X.panel(spark, sf).drop("category"), X.entities(spark, sf), X.J1, X.J2, "NATION_3"), "growth")


@query("c12_reconcile_current", """WITH e AS (SELECT channel, count(*) AS points, arg_min(subs, week) AS f, arg_max(subs, week) AS l, arg_max(views, week) AS lv FROM panel GROUP BY channel),
c AS (SELECT channel, subs * CASE k % 9 WHEN 0 THEN 20 WHEN 1 THEN 0 ELSE 1 END AS cs, views * CASE k % 9 WHEN 2 THEN 200 ELSE 1 END AS cv FROM api_items JOIN entities USING (channel)),
j AS (SELECT e.*, COALESCE(cs, 0) AS cs, COALESCE(cv, 0) AS cv FROM e LEFT JOIN c ON c.channel = e.channel)
SELECT channel, points, f AS first_subs, l AS last_subs, lv AS last_views, reason, reason = 'ok' AS valid FROM (SELECT *,
 CASE WHEN cs > 0 AND (l / cs < 0.1 OR l / cs > 10) THEN 'subs_mismatch' WHEN cv > 0 AND (lv / cv < 0.01 OR lv / cv > 100) THEN 'views_mismatch'
 WHEN f = 0 AND points > 50 THEN 'starts_with_zero' WHEN l < f THEN 'negative_growth' ELSE 'ok' END AS reason FROM j)""", "panel", "api_items", "entities")
def _(spark, sf):
    m = F.col("k") % 9
    cur = X.api_items(spark, sf).join(X.entities(spark, sf).select("channel", "k"), "channel").select(
        "channel", (F.col("subs") * F.when(m == 0, 20).when(m == 1, 0).otherwise(1)).alias("current_subs"),
        (F.col("views") * F.when(m == 2, 200).otherwise(1)).alias("current_views"))
    return J.reconcile_current(X.panel(spark, sf), cur)


@query("c13_peer_deviation", """WITH g AS (SELECT channel, category, week, CASE WHEN p > 0 THEN (views - p) / p END AS growth
 FROM (SELECT *, lag(views) OVER (PARTITION BY channel ORDER BY week) AS p FROM panel))
SELECT channel, category, week, round(growth, 6) AS growth, round(m, 6) AS peer_growth, round(growth - m, 6) AS peer_deviation
 FROM (SELECT *, quantile_cont(growth, 0.5) OVER (PARTITION BY category, week) AS m FROM g WHERE growth IS NOT NULL)""", "panel")
def _(spark, sf):
    return r6(J.peer_deviation(X.panel(spark, sf)).select("channel", "category", "week", "growth", "peer_growth", "peer_deviation"),
              "growth", "peer_growth", "peer_deviation")


@query("c13_medians_of_parts", """WITH g AS (SELECT category, week, CASE WHEN p > 0 THEN (views - p) / p END AS growth FROM (SELECT *, lag(views) OVER (PARTITION BY channel ORDER BY week) AS p FROM panel))
SELECT category, CAST(year(week) AS INTEGER) AS y, round(quantile_cont(growth, 0.5), 6) AS peer_growth, true AS near FROM g WHERE growth IS NOT NULL GROUP BY ALL""", "panel")
def _(spark, sf):
    # sketches of two parts of the rows, merged, give the quantile to some percent and the start of the exact one
    p = F.lag("views").over(Window.partitionBy("channel").orderBy("week"))
    rows = cut_lineage(X.panel(spark, sf).withColumn("p", p).filter("p > 0").select("channel", "category", F.year("week").alias("y"), ((F.col("views") - F.col("p")) / F.col("p").cast("double")).alias("growth")))
    keys = ["category", "y"]
    cells = Q.merge_cells(*[Q.quantile_cells(rows.filter(c), keys, "growth") for c in ("channel < 'S000050'", "channel >= 'S000050'")], keys=keys)
    exact = Q.exact_quantile(rows, keys, "growth", 0.5, "peer_growth", spread=["channel"], cells=cells)
    rough = Q.approx_quantile(cells, keys, 0.5, "_r")
    out = exact.join(rough, keys).withColumn("near", F.abs(F.col("_r") - F.col("peer_growth")) <= 0.1 * F.abs("peer_growth") + 0.001)
    return r6(out.drop("_r"), "peer_growth")


@query("g1_append_sources", """SELECT channel, week, views, subs, videos, category FROM panel
 UNION ALL SELECT channel, week, views, subs, NULL, NULL FROM observations""", "panel", "observations")
def _(spark, sf):
    return setops.append_sources(X.panel(spark, sf).select("channel", "week", "views", "subs", "videos", "category"),
                                 X.observations(spark, sf).select("channel", "week", "views", "subs"))


def _versions(spark, sf):
    before = X.full_panel(spark, sf)
    after = before.withColumn("views", F.when(F.col("subs") % 10 == 3, F.col("views") + 1).otherwise(F.col("views")))
    return projections.to_base_format(before, "week"), projections.to_base_format(after, "week")


@query("g2_preservation_check", """SELECT *, change FROM (
 SELECT channel, category, strftime(week, '%Y-%m-%dT00:00:00') AS datetime, views, delta_views, subs, delta_subs, videos, delta_videos, activity, 'lost' AS change, CAST(1 AS BIGINT) AS copies
 FROM full_panel WHERE subs % 10 = 3
 UNION ALL SELECT channel, category, strftime(week, '%Y-%m-%dT00:00:00'), views + 1, delta_views, subs, delta_subs, videos, delta_videos, activity, 'added', 1
 FROM full_panel WHERE subs % 10 = 3)""".replace("*, change", "*"), "full_panel")
def _(spark, sf):
    return setops.preservation_check(*_versions(spark, sf), BASE_COLUMNS)


@query("g2_preservation_by_entity", ORACLES["g2_preservation_check"])
def _(spark, sf):
    # trees of both versions are kept; only entities in ranges that differ are read again
    before, after = _versions(spark, sf)
    trees = [setops.fingerprint_tree(df, BASE_COLUMNS, ["channel"], 12) for df in (before, after)]
    changed = setops.changed_ranges(*trees).filter("level = 2")
    return setops.preservation_check(before, after, BASE_COLUMNS, ["channel"], changed, 12)


@query("g2_fingerprint", """SELECT CAST(1 AS INTEGER) AS versions, (SELECT count(*) FROM full_panel) AS rows""", "full_panel")
def _(spark, sf):
    # the same rows in another order and other files have the same fingerprint, changed ones another
    before, after = _versions(spark, sf)
    same = setops.fingerprint(before).unionByName(setops.fingerprint(before.repartition(7, "week")))
    other = setops.fingerprint(after)
    found = same.select("rows", "fingerprint").distinct()
    return found.join(other.select("fingerprint"), "fingerprint", "left_anti").agg(F.count(F.lit(1)).cast("int").alias("versions"), F.max("rows").alias("rows"))


@query("g3_distinct_entities", "SELECT DISTINCT channel FROM observations", "observations")
def _(spark, sf):
    return setops.distinct_entities(X.observations(spark, sf))


@query("g4_merge_flags", """SELECT channel, concat_ws('; ', CASE WHEN k % 2 = 0 THEN 'even' END, CASE WHEN k % 3 = 0 OR k % 5 = 0 THEN 'shared' END, CASE WHEN k % 7 = 0 THEN 'week' END) AS flags,
 concat_ws('; ', CASE WHEN k % 2 = 0 THEN 'even' END, CASE WHEN k % 3 = 0 AND k % 5 <> 0 THEN 'shared' END) AS only_a,
 concat_ws('; ', CASE WHEN k % 5 = 0 AND k % 3 <> 0 THEN 'shared' END, CASE WHEN k % 7 = 0 THEN 'week' END) AS only_b FROM entities""", "entities")
def _(spark, sf):
    def tags(*pairs):
        return F.filter(F.array(*[F.when(c, F.lit(t)) for c, t in pairs]), lambda x: x.isNotNull()).alias("validation_flags")
    e, k = X.entities(spark, sf), F.col("k")
    a = e.select("channel", tags((k % 2 == 0, "even"), (k % 3 == 0, "shared")))
    b = e.select("channel", tags((k % 5 == 0, "shared"), (k % 7 == 0, "week")))
    return setops.merge_flags(a, b).select("channel", joined("validation_flags").alias("flags"), joined("only_a").alias("only_a"),
                                           joined("only_b").alias("only_b"))
