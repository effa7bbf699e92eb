"""Section B: parsing, calendar, ratios, row checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as X
from checks.registry import cte, joined, query, r6
from weekloom.functions import scalars as S
from weekloom.operators import joins, junctions, projections as P

# texts of the parsing queries, built from line items and orders ------------------------------


def _number_texts(spark, sf):
    li = X.table(spark, sf, "lineitem")
    m = F.col("l_orderkey") % 8
    key, sup, line = F.col("l_orderkey").cast("string"), F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string")
    txt = (F.when(m == 0, key).when(m == 1, F.col("l_returnflag"))
           .when(m == 2, F.col("l_extendedprice").cast("decimal(12,2)").cast("string"))
           .when(m == 3, F.concat(sup, F.lit("."), line, F.lit("M"))).when(m == 4, F.concat(sup, F.lit("."), line, F.lit("B ")))
           .when(m == 5, F.concat(line, F.lit(","), F.lpad((F.col("l_partkey") % 1000).cast("string"), 3, "0"), F.lit(" k")))
           .when(m == 6, F.concat(F.lit("-"), sup, F.lit(".75"))))
    return li.select("l_orderkey", "l_linenumber", txt.alias("txt"))


cte("number_texts", """SELECT l_orderkey, l_linenumber, CASE l_orderkey % 8 WHEN 0 THEN CAST(l_orderkey AS VARCHAR) WHEN 1 THEN l_returnflag
 WHEN 2 THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) WHEN 3 THEN concat(l_suppkey, '.', l_linenumber, 'M')
 WHEN 4 THEN concat(l_suppkey, '.', l_linenumber, 'B ') WHEN 5 THEN concat(l_linenumber, ',', lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0'), ' k')
 WHEN 6 THEN concat('-', l_suppkey, '.75') END AS txt FROM lineitem""")


@query("b1_numeric_or_zero", """SELECT l_orderkey, l_linenumber, txt, COALESCE(CAST(trunc(TRY_CAST(trim(txt) AS DOUBLE)) AS BIGINT), 0) AS number
 FROM number_texts""", "number_texts")
def _(spark, sf):
    return _number_texts(spark, sf).withColumn("number", S.numeric_or_zero("txt"))


@query("b2_week_start_sunday", """SELECT o_orderkey, CAST(o_orderdate AS DATE) - CAST(dayofweek(CAST(o_orderdate AS DATE)) AS INTEGER) AS week
 FROM orders""")
def _(spark, sf):
    return X.table(spark, sf, "orders").select("o_orderkey", S.week_start_sunday("o_orderdate").alias("week"))


@query("b3_parse_compact_number", """SELECT l_orderkey, l_linenumber, txt, CAST(trunc(
 TRY_CAST(NULLIF(regexp_replace(u, '[^0-9.]', '', 'g'), '') AS DECIMAL(24,6)) * CASE right(u, 1) WHEN 'K' THEN 1000 WHEN 'M' THEN 1000000
 WHEN 'B' THEN 1000000000 ELSE 1 END) AS BIGINT) AS number FROM (SELECT *, upper(trim(txt)) AS u FROM number_texts)""", "number_texts")
def _(spark, sf):
    return _number_texts(spark, sf).withColumn("number", S.parse_compact_number("txt"))


@query("b4_parse_grouped_int", """SELECT l_orderkey, l_linenumber, txt, CASE WHEN n BETWEEN 0 AND 100000 THEN n END AS number
 FROM (SELECT *, TRY_CAST(regexp_replace(txt, '[^0-9]', '', 'g') AS BIGINT) AS n FROM number_texts)""", "number_texts")
def _(spark, sf):
    return _number_texts(spark, sf).withColumn("number", S.parse_grouped_int("txt", 0, 100_000))


@query("b5_clean_numeric", """SELECT l_orderkey, l_linenumber, txt,
 COALESCE(CAST(trunc(TRY_CAST(regexp_replace(txt, '[^0-9.-]', '', 'g') AS DOUBLE)) AS BIGINT), 0) AS number FROM number_texts""", "number_texts")
def _(spark, sf):
    return _number_texts(spark, sf).withColumn("number", S.clean_numeric("txt"))


@query("b6_parse_flexible_date", """WITH t AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderkey % 9 AS m FROM orders),
u AS (SELECT o_orderkey, CASE m WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%m/%d/%Y') WHEN 2 THEN strftime(d, '%d/%m/%Y')
 WHEN 3 THEN strftime(d, '%Y%m%d') WHEN 4 THEN strftime(d, '%b %d %Y') WHEN 5 THEN strftime(d, '%B %d, %Y')
 WHEN 6 THEN CAST((d - DATE '1970-01-01' + 10957) * 86400000 AS VARCHAR) WHEN 7 THEN CAST((d - DATE '1970-01-01' + 10957) * 86400 AS VARCHAR)
 ELSE 'n/a' END AS txt FROM t)
SELECT o_orderkey, txt, CAST(COALESCE(try_strptime(txt, ['%Y-%m-%d', '%m/%d/%Y', '%d/%m/%Y', '%Y%m%d', '%b %d %Y', '%B %d, %Y']),
 CASE WHEN TRY_CAST(txt AS BIGINT) > 1000000000000 THEN make_timestamp(TRY_CAST(txt AS BIGINT) * 1000)
 WHEN TRY_CAST(txt AS BIGINT) > 1000000000 THEN make_timestamp(TRY_CAST(txt AS BIGINT) * 1000000) END) AS DATE) AS parsed FROM u""")
def _(spark, sf):
    d, m = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 9
    days = F.unix_date(d).cast("bigint") + 10957
    txt = (F.when(m == 0, F.date_format(d, "yyyy-MM-dd")).when(m == 1, F.date_format(d, "MM/dd/yyyy"))
           .when(m == 2, F.date_format(d, "dd/MM/yyyy")).when(m == 3, F.date_format(d, "yyyyMMdd"))
           .when(m == 4, F.date_format(d, "MMM dd yyyy")).when(m == 5, F.date_format(d, "MMMM dd, yyyy"))
           .when(m == 6, (days * 86_400_000).cast("string")).when(m == 7, (days * 86_400).cast("string")).otherwise(F.lit("n/a")))
    return X.table(spark, sf, "orders").select("o_orderkey", txt.alias("txt"), S.parse_flexible_date(txt).alias("parsed"))


@query("b7_calendar_fields", """SELECT o_orderkey, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
 CAST(week(d) AS INTEGER) AS week_number, d - CAST(dayofweek(d) AS INTEGER) AS week_start_date
 FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def _(spark, sf):
    return P.calendar_fields(X.table(spark, sf, "orders"), "o_orderdate").select(
        "o_orderkey", "year", "quarter", "week_number", "week_start_date")


@query("b8_add_enhanced_columns", """SELECT *, CAST(0 AS BIGINT) AS total_longform_views, CAST(0 AS BIGINT) AS total_shorts_views, '' AS channel_name,
 'API' AS collection_source, 'good' AS data_quality_flag FROM (SELECT channel, week, views, subs FROM panel)""", "panel")
def _(spark, sf):
    return P.add_enhanced_columns(X.panel(spark, sf).select("channel", "week", "views", "subs"))


@query("b9_filter_range", "SELECT channel, week, views FROM panel WHERE week BETWEEN DATE '1997-09-07' AND DATE '1999-08-01'", "panel")
def _(spark, sf):
    return P.filter_range(X.panel(spark, sf), X.J1, X.J2, "week").select("channel", "week", "views")


@query("b10_normalize_handle", """SELECT s_suppkey, CASE WHEN h = '' THEN '' WHEN h LIKE '@%' THEN h ELSE concat('@', h) END AS handle
 FROM (SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN concat('@', s_name) WHEN 1 THEN concat(' ', s_name) ELSE '' END AS r FROM supplier),
 LATERAL (SELECT trim(r) AS h)""")
def _(spark, sf):
    m = F.col("s_suppkey") % 3
    raw = F.when(m == 0, F.concat(F.lit("@"), "s_name")).when(m == 1, F.concat(F.lit(" "), "s_name")).otherwise(F.lit(""))
    return X.table(spark, sf, "supplier").select("s_suppkey", S.normalize_handle(raw).alias("handle"))


@query("b11_map_status", """SELECT e.channel, CASE WHEN i.channel IS NULL THEN 'terminated' WHEN privacy = 'private' THEN 'private'
 WHEN privacy = 'unlisted' THEN 'inactive' ELSE 'active' END AS status FROM entities e LEFT JOIN api_items i ON i.channel = e.channel""",
       "entities", "api_items")
def _(spark, sf):
    got = X.api_items(spark, sf).select("channel", "privacy", F.lit(True).alias("got"))
    return X.entities(spark, sf).join(got, "channel", "left").select(
        "channel", S.map_status("privacy", F.coalesce("got", F.lit(False))).alias("status"))


@query("b12_project_api_item", """SELECT concat('P', page_id) AS channel, url AS channel_name, html AS description,
 CASE WHEN url LIKE '@%' THEN url ELSE concat('@', url) END AS handle, '' AS country, page_id * 3 AS views, CAST(0 AS BIGINT) AS subs,
 CAST(0 AS BIGINT) AS videos, DATE '2012-03-04' AS created_date, 'public' AS privacy, page_id % 5 = 0 AS parse_failed FROM pages""")
def _(spark, sf):
    pages = X.table(spark, sf, "pages")
    # list-response items as JSON text, read back with the declared schema
    from weekloom.schema import API_ITEM_TYPE
    item = F.struct(
        F.concat(F.lit("P"), F.col("page_id").cast("string")).alias("id"),
        F.struct(F.col("url").alias("title"), F.col("html").alias("description"), F.col("url").alias("customUrl"),
                 F.lit("2012-03-04T05:06:07Z").alias("publishedAt")).alias("snippet"),
        F.struct((F.col("page_id") * 3).cast("string").alias("viewCount"),
                 F.when(F.col("page_id") % 5 == 0, F.lit("n/a")).alias("subscriberCount")).alias("statistics"))
    rows = pages.select(F.from_json(F.to_json(item), API_ITEM_TYPE).alias("item"))
    return P.project_api_item(rows).select("channel", "channel_name", "description", "handle", "country", "views", "subs", "videos",
                                           "created_date", "privacy", "parse_failed")


@query("b13_derived_channel_metrics", """SELECT channel, round(CASE WHEN videos > 0 THEN views / videos ELSE 0 END, 6) AS avg_views_per_video,
 round(CASE WHEN views > 0 THEN subs / views ELSE 0 END, 6) AS subscriber_to_view_ratio FROM latest""", "latest")
def _(spark, sf):
    return r6(P.derived_channel_metrics(X.latest(spark, sf)), "avg_views_per_video", "subscriber_to_view_ratio").select(
        "channel", "avg_views_per_video", "subscriber_to_view_ratio")


@query("b14_engagement_metrics", """SELECT channel, week, round(CASE WHEN subs > 0 AND views IS NOT NULL THEN views / subs ELSE 0 END, 6) AS views_per_subscriber,
 round(CASE WHEN videos > 0 AND views IS NOT NULL THEN views / videos ELSE 0 END, 6) AS views_per_video,
 round(CASE WHEN t > 0 THEN total_shorts_views / t ELSE 0 END, 6) AS shorts_ratio, round(CASE WHEN t > 0 THEN total_longform_views / t ELSE 0 END, 6) AS longform_ratio
 FROM (SELECT *, total_longform_views + total_shorts_views AS t FROM defects)""", "defects")
def _(spark, sf):
    cols = ["views_per_subscriber", "views_per_video", "shorts_ratio", "longform_ratio"]
    return r6(P.engagement_metrics(X.defects(spark, sf)), *cols).select("channel", "week", *cols)


@query("b15_near_junction", f"""SELECT channel, week, abs(week - DATE '{X.J1}') <= 14 OR abs(week - DATE '{X.J2}') <= 14 AS near_junction FROM panel""", "panel")
def _(spark, sf):
    return P.near_junction(X.panel(spark, sf), [X.J1, X.J2], t="week").select("channel", "week", "near_junction")


@query("b16_record_issues", """SELECT channel, week, concat_ws('; ', CASE WHEN views < 0 THEN 'Negative view count' END,
 CASE WHEN subs < 0 THEN 'Negative subscriber count' END, CASE WHEN videos < 0 THEN 'Negative video count' END,
 CASE WHEN total_longform_views + total_shorts_views > 0 AND views > 0 AND total_longform_views + total_shorts_views > CAST(views AS DOUBLE) * 1.1
  THEN 'Longform + shorts views exceed total views' END,
 CASE WHEN abs(delta_views) > views THEN 'Delta views exceeds total views' END,
 CASE WHEN abs(delta_subs) > subs THEN 'Delta subs exceeds total subs' END) AS issues FROM defects""", "defects")
def _(spark, sf):
    return P.record_issues(X.defects(spark, sf)).select("channel", "week", joined("issues").alias("issues"))


@query("b17_flag_edit", """SELECT channel, week, concat_ws('; ', 'base', CASE WHEN views < 0 THEN 'negative' END) AS added,
 CASE WHEN subs = 0 THEN '' ELSE 'base' END AS removed FROM defects""", "defects")
def _(spark, sf):
    rows = X.defects(spark, sf).withColumn("f", F.array(F.lit("base")))
    neg = F.coalesce(F.col("views") < 0, F.lit(False))
    twice = S.flag_add(S.flag_add("f", "negative", neg), "negative", neg)
    return rows.select("channel", "week", joined(twice).alias("added"),
                       joined(S.flag_remove("f", "base", F.coalesce(F.col("subs") == 0, F.lit(False)))).alias("removed"))


_ENH = "channel, category, strftime(week, '%Y-%m-%dT00:00:00') AS datetime, views, delta_views, subs, delta_subs, videos, delta_videos, activity"


@query("b18_to_base_format", f"SELECT {_ENH} FROM full_panel", "full_panel")
def _(spark, sf):
    return P.to_base_format(X.full_panel(spark, sf), "week")


@query("b18_to_enhanced_format", f"SELECT {_ENH}, total_longform_views, total_shorts_views, channel_name, collection_source, data_quality_flag FROM full_panel",
       "full_panel")
def _(spark, sf):
    return P.to_enhanced_format(X.full_panel(spark, sf), "week")


SCORE_SQL = f"""round(greatest(0.0, 1.0 - abs(DATE '{X.INDEX_END}' - CAST(strptime(timestamp, '%Y%m%d%H%M%S') AS DATE)) / 365.0)
 * CASE WHEN statuscode = '200' THEN 1.2 ELSE 1.0 END * CASE WHEN timestamp < '20200101' THEN 0.7 ELSE 1.0 END, 6)"""


@query("b19_score_snapshot", f"SELECT channel, timestamp, digest, CAST({SCORE_SQL} AS DOUBLE) AS coverage_score FROM snapshot_index", "snapshot_index")
def _(spark, sf):
    return r6(P.score_snapshots(X.snapshot_index(spark, sf), X.INDEX_END), "coverage_score").select(
        "channel", "timestamp", "digest", "coverage_score")


@query("b20_detect_chart_library", """SELECT page_id, CASE WHEN h LIKE '%dygraph%' OR h LIKE '%Dygraph%' THEN 'dygraph'
 WHEN h LIKE '%highcharts%' OR h LIKE '%Highcharts%' OR h LIKE '%highstock%' THEN 'highcharts'
 WHEN h LIKE '%plotly%' OR h LIKE '%Plotly%' THEN 'plotly' WHEN h LIKE '%chartjs%' OR h LIKE '%Chart.js%' OR h LIKE '%chart.min.js%' THEN 'chartjs'
 ELSE 'unknown' END AS library FROM (SELECT page_id, concat(html, CASE page_id % 5 WHEN 0 THEN '<script src="Dygraph.js">' WHEN 1 THEN 'Highcharts.chart('
 WHEN 2 THEN 'plotly.js' WHEN 3 THEN 'chart.min.js' ELSE '' END) AS h FROM pages)""")
def _(spark, sf):
    m = F.col("page_id") % 5
    tail = (F.when(m == 0, F.lit('<script src="Dygraph.js">')).when(m == 1, F.lit("Highcharts.chart(")).when(m == 2, F.lit("plotly.js"))
            .when(m == 3, F.lit("chart.min.js")).otherwise(F.lit("")))
    return X.table(spark, sf, "pages").select("page_id", S.detect_chart_library(F.concat("html", tail)).alias("library"))


@query("b21_grade", """SELECT l_orderkey, l_linenumber, CASE WHEN s >= 0.95 THEN 'excellent' WHEN s >= 0.85 THEN 'good' WHEN s >= 0.75 THEN 'fair'
 WHEN s >= 0.6 THEN 'poor' ELSE 'missing' END AS grade FROM (SELECT l_orderkey, l_linenumber, l_quantity / 50.0 AS s FROM lineitem)""")
def _(spark, sf):
    return X.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", S.grade(F.col("l_quantity") / 50.0).alias("grade"))


@query("b22_clamp01", "SELECT l_orderkey, l_linenumber, round(least(greatest(l_quantity / 20.0 - 0.5, 0.0), 1.0), 6) AS v FROM lineitem")
def _(spark, sf):
    return r6(X.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", S.clamp01(F.col("l_quantity") / 20.0 - 0.5).alias("v")), "v")


@query("b23_fallback_name", """SELECT channel, week, CASE WHEN COALESCE(channel_name, '') = '' THEN concat('Channel_', substr(channel, 1, 8)) ELSE channel_name END AS name
 FROM defects""", "defects")
def _(spark, sf):
    return X.defects(spark, sf).select("channel", "week", S.fallback_name("channel", "channel_name").alias("name"))


@query("b24_resolve_source_key", """SELECT e.channel, COALESCE(CASE WHEN k % 3 = 0 THEN concat('L', k) END, NULLIF(e.channel, ''), substr(handle, 2)) AS source_key
 FROM entities e""", "entities")
def _(spark, sf):
    e = X.entities(spark, sf)
    legacy = e.filter(F.col("k") % 3 == 0).select("channel", F.concat(F.lit("L"), F.col("k").cast("string")).alias("legacy_key"))
    return joins.resolve_source_key(e, legacy).select("channel", "source_key")


@query("b25_breakdown_check", """SELECT channel, week, CASE WHEN views > 1000000000 THEN 'views_too_high' WHEN subs > 500000000 THEN 'subs_too_high'
 WHEN total_longform_views > 0 AND total_shorts_views > 0 AND views > 0 AND abs(total_longform_views + total_shorts_views - views) > views * 0.05
 THEN 'breakdown_mismatch' ELSE 'ok' END AS breakdown_status FROM defects""", "defects")
def _(spark, sf):
    return P.breakdown_check(X.defects(spark, sf), tol=0.05, max_views=1_000_000_000).select("channel", "week", "breakdown_status")


@query("b26_ratio_check", """SELECT channel, week, round(CASE WHEN subs > 0 THEN views / subs END, 6) AS views_per_sub,
 COALESCE(CASE WHEN subs > 0 THEN NOT (views / subs BETWEEN 10 AND 4000000) END, false) AS ratio_out_of_range FROM defects""", "defects")
def _(spark, sf):
    return r6(P.ratio_check(X.defects(spark, sf), hi=4_000_000.0), "views_per_sub").select("channel", "week", "views_per_sub", "ratio_out_of_range")


@query("b27_stable_week", """SELECT o_orderkey, CASE WHEN dayofweek(d) >= 3 THEN d - CAST(dayofweek(d) AS INTEGER)
 ELSE d - CAST(dayofweek(d) AS INTEGER) - 7 END AS stable_week FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def _(spark, sf):
    return X.table(spark, sf, "orders").select("o_orderkey", S.stable_week("o_orderdate").alias("stable_week"))


@query("e24_junction_tier", """SELECT l_orderkey, l_linenumber, CASE WHEN v < 5 THEN 'excellent' WHEN v < 10 THEN 'good' WHEN v <= 15 THEN 'fair' ELSE 'poor' END AS first_tier,
 CASE WHEN v < 3 THEN 'excellent' WHEN v < 7 THEN 'good' WHEN v <= 10 THEN 'fair' ELSE 'poor' END AS second_tier
 FROM (SELECT l_orderkey, l_linenumber, l_quantity / 2.0 AS v FROM lineitem)""")
def _(spark, sf):
    v = F.col("l_quantity") / 2.0
    return X.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", junctions.junction_tier(v).alias("first_tier"),
                                                 junctions.junction_tier(v, junctions.SECOND_CUTS).alias("second_tier"))
