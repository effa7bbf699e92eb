"""Section H on pages rendered from the panel: what is extracted must be the panel again."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as X
from checks.registry import cte, query
from weekloom.operators import extract as E
from weekloom.session import cut_lineage

STAMP = "20011231000000"


def _series(spark, sf):
    """Per entity its points in order: array<struct<week, views, subs, videos>> (one per week)."""
    return X.panel(spark, sf).groupBy("channel").agg(
        F.sort_array(F.collect_list(F.struct("week", "views", "subs", "videos"))).alias("p"))


def _page(rows, html):
    return rows.select("channel", F.lit(STAMP).alias("snapshot_ts"), F.concat(F.lit("http://stored/"), "channel").alias("url"), html.alias("html"))


def _list(f, sep=","):
    return F.array_join(F.transform("p", f), sep)


def _ms(d):
    return (F.unix_date(d).cast("bigint") * 86_400_000)


def dygraph_html():
    subs = _list(lambda x: F.format_string("[%d, %d]", _ms(x["week"]), x["subs"]))
    # the view series is taken three days later than the subscriber series
    views = _list(lambda x: F.format_string("[%d,%d]", _ms(F.date_add(x["week"], 3)), x["views"]))
    return F.concat(F.lit('<script src="dygraph.js"></script><script>new Dygraph(a, {data: ['), subs, F.lit(",]}); new Dygraph(b, {\n data : ["),
                    views, F.lit("] });</script>"))


def highcharts_html():
    return F.concat(F.lit("<script>Highcharts.chart('c', {xAxis: {categories: ["), _list(lambda x: F.concat(F.lit("'"), F.date_format(x["week"], "MMMM dd, yyyy"), F.lit("'"))),
                    F.lit("]}, series: [{name: 'Subs', data: ["), _list(lambda x: x["subs"].cast("string")), F.lit("]}, {name: 'Views', data: ["),
                    _list(lambda x: x["views"].cast("string"), ", "), F.lit("]}]});</script>"))


def plotly_html():
    return F.concat(F.lit("<script>Plotly.newPlot('p', {x: ["), _list(lambda x: F.concat(F.lit('"'), F.date_format(x["week"], "yyyy-MM-dd"), F.lit('"'))),
                    F.lit("], y: ["), _list(lambda x: x["subs"].cast("string")), F.lit("]});</script>"))


def chartjs_html():
    blob = F.to_json(F.struct(
        F.transform("p", lambda x: F.date_format(x["week"], "MM/dd/yyyy")).alias("labels"),
        F.array(F.struct(F.lit("Subscribers").alias("label"), F.transform("p", lambda x: x["subs"]).alias("data")),
                F.struct(F.lit("Total Views").alias("label"), F.transform("p", lambda x: x["views"]).alias("data")),
                F.struct(F.lit("Shorts").alias("label"), F.transform("p", lambda x: x["videos"]).alias("data"))).alias("datasets")))
    return F.concat(F.lit("<script src='chart.min.js'></script><script>const chartData = "), blob, F.lit(";</script>"))


def table_html():
    rows = _list(lambda x: F.concat(F.lit("<tr><td>"), F.date_format(x["week"], "yyyy-MM-dd"), F.lit("</td>\n<td>"), F.format_number(x["subs"], 0), F.lit("</td><td> <b>"),
                                    F.format_number(x["views"], 0), F.lit("</b> </td><td>"), F.format_number(x["videos"], 0), F.lit("</td></tr>")), "\n")
    return F.concat(F.lit('<table class="data-table"><thead><tr><th>Date</th><th>Subscribers</th><th>Video Views</th><th>Uploads</th></tr></thead>'), rows, F.lit("</table>"))


def attr_html():
    blob = F.to_json(F.transform("p", lambda x: F.struct(x["week"].cast("string").alias("date"), x["subs"].alias("subs"))))
    return F.concat(F.lit("<canvas id=\"c\" data-subs='"), blob, F.lit("'></canvas>"))


cte("arrays", f"""SELECT channel, '{STAMP}' AS snapshot_ts, 0 AS array_no, row_number() OVER w - 1 AS pos, CAST((week - DATE '1970-01-01') * 86400000 AS BIGINT) AS epoch_ms, CAST(subs AS DOUBLE) AS value FROM panel WINDOW w AS (PARTITION BY channel ORDER BY week)
 UNION ALL SELECT channel, '{STAMP}', 1, row_number() OVER w - 1, CAST((week - DATE '1970-01-01' + 3) * 86400000 AS BIGINT), CAST(views AS DOUBLE) FROM panel WINDOW w AS (PARTITION BY channel ORDER BY week)""", "panel")


def _dygraph(spark, sf):
    return E.extract_dygraph(_page(_series(spark, sf), dygraph_html()))


@query("h1_extract_dygraph", "SELECT channel, snapshot_ts, CAST(array_no AS INTEGER) AS array_no, CAST(pos AS INTEGER) AS pos, epoch_ms, value FROM arrays", "arrays")
def _(spark, sf):
    return _dygraph(spark, sf)


cte("profile", """SELECT *, ls > fs AS is_increasing, avg_value < 50000000 AND max_value < 100000000 AS likely_subscribers, avg_value > 1000000 OR max_value > 100000000 AS likely_views,
 min_value > 0 AND ls > fs AND max_value > min_value * 1.1::DOUBLE AS realistic_growth FROM (SELECT channel, snapshot_ts, CAST(array_no AS INTEGER) AS array_no, count(*) AS n, min(value) AS min_value, max(value) AS max_value, avg(value) AS avg_value,
 arg_min(value, pos) AS fs, arg_max(value, pos) AS ls, CAST((max(epoch_ms) - min(epoch_ms)) // 86400000 AS INTEGER) AS span_days FROM arrays GROUP BY 1, 2, 3)""", "arrays")


@query("h2_series_profile", "SELECT * EXCLUDE (fs, ls) REPLACE (round(avg_value, 3) AS avg_value) FROM profile", "profile")
def _(spark, sf):
    return E.series_profile(_dygraph(spark, sf)).withColumn("avg_value", F.round("avg_value", 3))


_SHARED = "realistic_growth::INTEGER * 5 + (min_value <> 0)::INTEGER * 3 + (n > 100)::INTEGER * 2 + is_increasing::INTEGER * 2 + (span_days > 600)::INTEGER * 3"
cte("picked", f"""WITH s AS (SELECT *, CASE WHEN max_value <= 100000000 AND avg_value <= 50000000 THEN likely_subscribers::INTEGER * 10 + CASE WHEN avg_value BETWEEN 100000 AND 50000000 THEN 20 WHEN avg_value < 10000000 THEN 5 WHEN avg_value < 25000000 THEN 3 ELSE 0 END + {_SHARED} ELSE 0 END AS ss,
 likely_views::INTEGER * 10 + CASE WHEN avg_value > 500000000 THEN 25 WHEN avg_value > 100000000 THEN 20 WHEN avg_value > 10000000 THEN 15 WHEN avg_value > 1000000 THEN 10 ELSE 0 END + {_SHARED} AS vs FROM profile),
b AS (SELECT channel, snapshot_ts, array_no AS subs_array FROM s WHERE ss > 0 QUALIFY row_number() OVER (PARTITION BY channel, snapshot_ts ORDER BY ss DESC, array_no) = 1),
v AS (SELECT s.channel, s.snapshot_ts, array_no AS views_array FROM s LEFT JOIN b ON b.channel = s.channel WHERE vs > 0 AND array_no IS DISTINCT FROM subs_array QUALIFY row_number() OVER (PARTITION BY s.channel ORDER BY vs DESC, array_no) = 1)
SELECT DISTINCT s.channel, s.snapshot_ts, subs_array, views_array FROM s LEFT JOIN b ON b.channel = s.channel LEFT JOIN v ON v.channel = s.channel""", "profile")


@query("h3_pick_series", "SELECT * FROM picked", "picked")
def _(spark, sf):
    return E.pick_series(E.series_profile(_dygraph(spark, sf)))


cte("combined", """WITH s AS (SELECT a.channel, a.snapshot_ts, epoch_ms AS t, CAST(value AS BIGINT) AS subs FROM arrays a JOIN picked p ON p.channel = a.channel AND a.array_no = subs_array),
v AS (SELECT a.channel, epoch_ms AS t, CAST(value AS BIGINT) AS views, subs_array FROM arrays a JOIN picked p ON p.channel = a.channel AND a.array_no = views_array),
j AS (SELECT s.*, b.t AS bt, b.views AS bv, a.t AS nt, a.views AS av FROM s ASOF LEFT JOIN v b ON b.channel = s.channel AND s.t >= b.t ASOF LEFT JOIN v a ON a.channel = s.channel AND s.t <= a.t)
SELECT channel, snapshot_ts, t, subs, COALESCE(CASE WHEN t - bt <= 2419200000 AND (nt IS NULL OR nt - t > 2419200000 OR t - bt <= nt - t) THEN bv WHEN nt - t <= 2419200000 THEN av END, 0) AS views FROM j
 UNION ALL SELECT channel, '20011231000000', t, 0, views FROM v WHERE subs_array IS NULL""", "arrays", "picked")


@query("h4_combine_series", "SELECT channel, snapshot_ts, CAST(DATE '1970-01-01' + CAST(t // 86400000 AS INTEGER) AS VARCHAR) AS date_text, subs, views, 'dygraph' AS extraction_method FROM combined", "combined")
def _(spark, sf):
    points = cut_lineage(_dygraph(spark, sf))       # used three times
    return E.combine_series(points, E.pick_series(E.series_profile(points)))


@query("h5_extract_highcharts", f"SELECT channel, '{STAMP}' AS snapshot_ts, strftime(week, '%B %d, %Y') AS date_text, subs, views, 'highcharts' AS extraction_method FROM panel", "panel")
def _(spark, sf):
    return E.extract_highcharts(_page(_series(spark, sf), highcharts_html()))


@query("h6_extract_plotly", f"SELECT channel, '{STAMP}' AS snapshot_ts, strftime(week, '%Y-%m-%d') AS date_text, subs, CAST(0 AS BIGINT) AS views, 'plotly' AS extraction_method FROM panel", "panel")
def _(spark, sf):
    return E.extract_plotly(_page(_series(spark, sf), plotly_html()))


@query("h7_extract_chartjs", f"""SELECT channel, '{STAMP}' AS snapshot_ts, strftime(week, '%m/%d/%Y') AS date_text, subs, views, CAST(0 AS BIGINT) AS longform_views, videos AS shorts_views,
 'chartjs' AS extraction_method FROM panel""", "panel")
def _(spark, sf):
    return E.extract_chartjs(_page(_series(spark, sf), chartjs_html()))


@query("h8_standardize", f"""SELECT channel, '{STAMP}' AS snapshot_ts, week AS obs_date, week, subs, views, 'highcharts' AS extraction_method, 'WAYBACK_CHARTS' AS collection_source FROM panel""", "panel")
def _(spark, sf):
    return E.standardize(E.extract_highcharts(_page(_series(spark, sf), highcharts_html())))


def _counter_page(spark, sf):
    """Pages in five layouts that state the upload count."""
    k = F.substring("channel", 2, 20).cast("bigint") % 6
    n, raw = F.format_number("videos", 0), F.col("videos").cast("string")
    html = (F.when(k == 0, F.concat(F.lit('<div><span id="youtube-stats-header-uploads">'), n, F.lit("</span></div>")))
            .when(k == 1, F.concat(F.lit('<p class="big upload-count"><b>'), n, F.lit("</b></p>")))
            .when(k == 2, F.concat(F.lit("<strong>Uploads</strong><br> "), n, F.lit("<i>")))
            .when(k == 3, F.concat(F.lit("<p>"), n, F.lit(" videos</p>")))
            .when(k == 4, F.concat(F.lit('<script type="application/ld+json">{"numberOfVideos": '), raw, F.lit("}</script>")))
            .otherwise(F.lit("<p>404 video not found</p>")))
    return _page(X.latest(spark, sf), html)


@query("h9_extract_upload_count", f"""SELECT channel, '{STAMP}' AS snapshot_ts, videos AS upload_count, videos <= 100000 AS in_range FROM latest WHERE CAST(substr(channel, 2) AS BIGINT) % 6 <> 5
 UNION ALL SELECT channel, '{STAMP}', 404, true FROM latest WHERE CAST(substr(channel, 2) AS BIGINT) % 6 = 5""", "latest")
def _(spark, sf):
    return E.extract_upload_count(_counter_page(spark, sf))


def _metric_page(spark, sf):
    k = F.substring("channel", 2, 20).cast("bigint") % 4
    v, s = F.format_number("views", 0), F.format_number("subs", 0)
    html = (F.when(k == 0, F.concat(F.lit('<div class="stats-key">Total Views</div> <div class="value">'), v, F.lit('</div><div class="stats-key">Subscribers</div> <div class="value">'), s, F.lit("</div>")))
            .when(k == 1, F.concat(F.lit('<i data-metric="total views" data-value="'), v, F.lit('"></i><i data-metric="subscribers" data-value="'), s, F.lit('"></i>')))
            .when(k == 2, F.concat(F.lit('<script type="application/ld+json">{"viewCount": "'), F.col("views").cast("string"), F.lit('", "subscriberCount": '), F.col("subs").cast("string"), F.lit("}</script>")))
            .otherwise(F.lit("<p>nothing to see</p>")))
    return _page(X.latest(spark, sf), html)


@query("h10_extract_current_metrics", f"""SELECT channel, '{STAMP}' AS snapshot_ts, views AS total_views, subs AS subscriber_count, CAST(NULL AS BIGINT) AS longform_views, CAST(NULL AS BIGINT) AS shorts_views
 FROM latest WHERE CAST(substr(channel, 2) AS BIGINT) % 4 <> 3""", "latest")
def _(spark, sf):
    return E.extract_current_metrics(_metric_page(spark, sf))


@query("h11_extract_json_ld", f"""SELECT channel, '{STAMP}' AS snapshot_ts, views AS total_views, subs AS subscriber_count FROM latest WHERE CAST(substr(channel, 2) AS BIGINT) % 4 <> 3""", "latest")
def _(spark, sf):
    k = F.substring("channel", 2, 20).cast("bigint") % 4
    v, s = F.col("views").cast("string"), F.col("subs").cast("string")
    html = (F.when(k == 0, F.concat(F.lit('<script type="application/ld+json">{"viewCount": '), v, F.lit(', "subscriberCount": "'), s, F.lit('"}</script>')))
            .when(k == 1, F.concat(F.lit('<script type="application/ld+json">{"interactionStatistic": [{"@type": "ViewAction", "userInteractionCount": '), v,
                                   F.lit('}, {"@type": "SubscribeAction", "userInteractionCount": "'), s, F.lit('"}]}</script>')))
            .when(k == 2, F.concat(F.lit('<script>window.data = {"viewCount": '), v, F.lit(', "subscriberCount": '), s, F.lit("};</script>")))
            .otherwise(F.lit("<script>var x = 1;</script>")))
    return E.extract_json_ld(_page(X.latest(spark, sf), html))


@query("h12_extract_history_table", f"SELECT channel, '{STAMP}' AS snapshot_ts, strftime(week, '%Y-%m-%d') AS date_text, subs, views, videos, 'table' AS extraction_method FROM panel", "panel")
def _(spark, sf):
    return E.extract_history_table(_page(_series(spark, sf), table_html()))


@query("h13_extract_data_attr", f"SELECT channel, '{STAMP}' AS snapshot_ts, strftime(week, '%Y-%m-%d') AS date_text, subs, 'data_attr' AS extraction_method FROM panel", "panel")
def _(spark, sf):
    return E.extract_data_attr(_page(_series(spark, sf), attr_html()))


@query("h14_extract_errors", "SELECT concat('P', page_id) AS channel, '20200101000000' AS snapshot_ts, url, 'unknown' AS library FROM pages")
def _(spark, sf):
    pages = X.table(spark, sf, "pages").select(F.concat(F.lit("P"), F.col("page_id").cast("string")).alias("channel"),
                                               F.lit("20200101000000").alias("snapshot_ts"), "url", "html")
    return E.extract_errors(pages, E.extract_points(pages))


def mixed_pages(spark, sf):
    """Every entity's page, the chart library by entity number, at one of its indexed stamps."""
    k = F.substring("channel", 2, 20).cast("bigint") % 5
    html = (F.when(k == 0, dygraph_html()).when(k == 1, highcharts_html()).when(k == 2, plotly_html()).when(k == 3, chartjs_html()).otherwise(table_html()))
    stamps = X.snapshot_index(spark, sf).filter(F.col("statuscode") == "200").groupBy("channel").agg(F.max("timestamp").alias("snapshot_ts"))
    return _page(_series(spark, sf), html).drop("snapshot_ts").join(stamps, "channel")
