"""Hand-written stored pages in the layouts the extraction jobs know."""

import json
from datetime import date

import pytest

from weekloom.operators import extract as E, windows

COUNTERS = """<html><head><title>Harbour Kites, numbers</title></head><body><p>Uploads: <b id="youtube-stats-header-uploads">3,207</b></p>
<p>Readers: <b id="readers">912</b></p></body></html>"""
TABLE = """<table><tr><th>Date</th><th>Subscribers</th><th>Views in total</th></tr>
<tr><td>2021-03-08</td><td>6.4M</td><td>1,234,567,890</td></tr><tr><td>soon</td><td>7</td><td>8</td></tr></table>"""
ATTR = """<div class="spark" data-subs='[{"date": "2018-05-06", "subs": 310000}, {"date": "2018-05-13", "subs": 312500}]'></div>"""
BLOCKED = "<html><head><title>Just a moment...</title></head><body>Error 503. Checking your browser.</body></html>"


def pages(spark, *htmls):
    rows = [(f"c{i}", "20230101000000", "http://stored/x", h) for i, h in enumerate(htmls)]
    return spark.createDataFrame(rows, "channel string, snapshot_ts string, url string, html string")


@pytest.mark.parametrize("html,want", [
    (COUNTERS, 3207), ('<div class="x stats-uploads y">2,000</div>', 2000), ("<b>1,234</b> <i>12 videos</i>", 12),
    ('<meta name="d" content="has 77 uploads"><p>', 77), ("<title>88 videos here</title>", 88),
    ('<script type="application/ld+json">{"numberOfVideos": 55}</script><p>video', 55), ("<p>999,999,999 videos</p>", 999_999_999), ("<p>250,000 uploads</p>", 250_000), (BLOCKED, None)])
def test_upload_count(spark, html, want):
    got = E.extract_upload_count(pages(spark, html)).collect()
    assert [(r.upload_count, r.in_range) for r in got] == ([] if want is None else [(want, want <= 100_000)])


def test_history_table(spark):
    got = E.extract_history_table(pages(spark, TABLE)).collect()
    assert [(r.date_text, r.subs, r.views, r.videos) for r in got] == [("2021-03-08", 6_400_000, 1_234_567_890, None)]


def test_data_attribute(spark):
    got = E.extract_data_attr(pages(spark, ATTR)).orderBy("date_text").collect()
    assert [(r.date_text, r.subs) for r in got] == [("2018-05-06", 310_000), ("2018-05-13", 312_500)]


def test_current_metrics_and_override(spark):
    plain = '<div class="stats-key">Total Views</div> <div class="value">4.16B</div><p><strong>17.8M</strong> subscribers</p>'
    over = plain + '<script type="application/ld+json">{"subscriberCount": "18,000,000"}</script>'
    got = {r.channel: r for r in E.extract_current_metrics(pages(spark, plain, over, BLOCKED)).collect()}
    assert (got["c0"].total_views, got["c0"].subscriber_count) == (4_160_000_000, 17_800_000)
    assert got["c1"].subscriber_count == 18_000_000 and "c2" not in got


def test_trailing_commas_and_bad_points(spark):
    html = "<script>dygraph</script> data: [[1567296000000, 10], [oops, 3], [1567900800000, 12],]"
    got = E.extract_dygraph(pages(spark, html)).orderBy("pos").collect()
    assert [(r.epoch_ms, r.value) for r in got] == [(1567296000000, 10.0), (1567900800000, 12.0)]


def test_plotly_shorter_list(spark):
    html = "Plotly {x: ['2020-01-05', '2020-01-12', '2020-01-19'], y: [5, 6]}"
    assert E.extract_plotly(pages(spark, html)).count() == 2


def test_unreadable_pages_are_listed(spark):
    p = pages(spark, COUNTERS, TABLE, BLOCKED)
    points = E.extract_points(p)
    assert {r.channel for r in E.extract_errors(p, points).collect()} == {"c0", "c2"}
    obs = E.standardize(points).collect()
    assert [(r.obs_date, r.week, r.subs) for r in obs] == [(date(2021, 3, 8), date(2021, 3, 7), 6_400_000)]


def rows_of(df):
    return sorted((r.date_text, r.subs, r.views) for r in df.collect())


def test_positional_dygraph(spark):
    html = 'var g = new Dygraph(document.getElementById("d"), [[1567296000000, 10], [1567900800000, 12]], {labels: ["t", "n"]});'
    got = E.extract_dygraph(pages(spark, html)).orderBy("pos").collect()
    assert [(r.epoch_ms, r.value) for r in got] == [(1567296000000, 10.0), (1567900800000, 12.0)]


def test_highcharts_keeps_places(spark):
    head = "Highcharts.chart('c', {xAxis: {categories: ['2020-01-05', '2020-01-12']}, series: ["
    gap = head + "{name: 'a', data: [5, null]}, {name: 'b', data: [700, 800]}]})"
    assert rows_of(E.extract_highcharts(pages(spark, gap))) == [("2020-01-05", 5, 700), ("2020-01-12", None, 800)]
    empty = head + "{name: 'a', data: [null, null]}, {name: 'b', data: [700, 800]}]})"
    assert rows_of(E.extract_highcharts(pages(spark, empty))) == [("2020-01-05", None, 700), ("2020-01-12", None, 800)]
    pairs = "Highcharts.chart('c', {series: [{data: [[1567296000000, 10], [1567900800000, null]]}, {data: [[1567296000000, 70], [1567900800000, 80]]}]})"
    assert rows_of(E.extract_highcharts(pages(spark, pairs))) == [("1567296000000", 10, 70), ("1567900800000", None, 80)]


@pytest.mark.parametrize("html", [
    'chartData = {"labels": ["2020-01-05"], "note": "a; b", "datasets": [{"label": "Subscribers", "data": [5]}, {"label": "Total Views", "data": [6]}]};',
    'var chartData = {"labels": []}; var graphData = {"labels": ["2020-01-05"], "datasets": [{"label": "Subscribers", "data": [5]}, {"label": "Total views", "data": [6]}]}; more()',
    'new Chart(c, {type: "line", data: {labels: ["2020-01-05"], datasets: [{label: "Subscribers", data: [5]}, {label: "total views", data: [6]}]}, options: {}})',
    '<script>__NEXT_DATA__ = {"props": {"x": 1, "chartData": {"labels": ["2020-01-05"], "datasets": [{"label": "Subscribers", "data": [5]}, {"label": "Total views", "data": [6]}]}}}</script>'])
def test_chartjs_forms(spark, html):
    assert rows_of(E.extract_chartjs(pages(spark, html))) == [("2020-01-05", 5, 6)]


def test_fallback_to_attribute_and_table(spark):
    named = "<script src='highcharts.js'></script>"
    got = {r.channel: (r.extraction_method, r.low_quality) for r in E.extract_points(pages(spark, named + TABLE, named + ATTR, ATTR + TABLE, named)).collect()}
    assert got == {"c0": ("table", True), "c1": ("data_attr", True), "c2": ("data_attr", True)}


NEXT = '{"props": {"pageProps": {"page": {"options": {"a": {"b": 1}}, "labels": ["2020-01-05", "2020-01-12"], "datasets": [{"label": "Subscribers", "tip": {"x": {}}, "data": [5, null]}, {"label": "Total views", "data": [6, 7]}]}}}}'


@pytest.mark.parametrize("html,want", [
    # a script of JSON, under a name of its own
    (f'<script id="__NEXT_DATA__" type="application/json">{NEXT}</script>', [("2020-01-05", 5, 6), ("2020-01-12", None, 7)]),
    # the same pushed as text, in two pieces
    ("<script>self.__next_f.push([1,%s])</script><script>self.__next_f.push([1,%s])</script>" % (json.dumps(NEXT[:70]), json.dumps(NEXT[70:])), [("2020-01-05", 5, 6), ("2020-01-12", None, 7)]),
    # no library named; comments, other quotes, unquoted names, a trailing comma
    ("<p>It's quiet</p><script>/* chart */ const c = {labels: ['2020-01-05',], // one\n datasets: [{label: 'Total views', data: [6]}, {label: `Subscribers`, data: [5],}]}</script>", [("2020-01-05", 5, 6)]),
    ("<script>draw({xAxis: {categories: ['January 5, 2020']}, series: [{name: 'it\\'s [one]', data: [5]}, {data: [6]}]})</script>", [("January 5, 2020", 5, 6)]),
    ("<script>draw({series: [{data: [{x: Date.UTC(2020, 0, 5), y: 5}, {x: new Date(2020, 0, 12), y: undefined}]}]})</script>", [("1578182400000", 5, 0), ("1578787200000", None, 0)]),
    ("<script>var t = {x: ['2020-01-05'], y: [5]}</script>", [("2020-01-05", 5, 0)]),
    ("<script>window.seriesData = [[1578182400000, 5], [1578787200000, null]];</script>", [("1578182400000", 5, 0), ("1578787200000", None, 0)]),
    ('<script>seriesData: [{"date": "2020-01-05", "subscribers": 5, "views": 6}]</script>', [("2020-01-05", 5, 6)]),
    # a named library without a chart of its own, and a chart of another kind
    ("<script src='highcharts.js'></script><script>x = {labels: ['2020-01-05'], datasets: [{label: 'subscribers', data: [5]}]}</script>", [("2020-01-05", 5, 0)]),
    # names of charts in prose, and empty ones
    ("<p>data: none, labels: [] and series: []</p>", []), ("<script>data = []; labels: []; series: [{}]; x: []</script>", []),
])
def test_any_readable_literal_counts(spark, html, want):
    points = E.extract_points(pages(spark, html))
    assert sorted(rows_of(points)) == want
    assert E.extract_errors(pages(spark, html), points).count() == (not want)


def test_nulls_are_no_zeros(spark):
    html = "<script>Highcharts.chart({xAxis: {categories: ['2020-01-05', '2020-01-12', '2020-01-19']}, series: [{data: [null, 0, 7]}, {data: [null, 0, null]}]})</script>"
    obs = windows.point_flags(E.standardize(E.extract_points(pages(spark, html))), "channel", "week").orderBy("obs_date").collect()
    assert [(r.subs, r.views) for r in obs] == [(None, None), (0, 0), (7, None)]
    assert ["zero_values" in r.point_flags for r in obs] == [False, True, False]


def test_every_column_of_a_row_is_a_series(spark):
    html = "new Dygraph(e, [[1567296000000, 10, 500], [1567900800000, null, 510], [1568505600000, 12]]); data: [[1567296000000, 9]]"
    got = sorted((r.array_no, r.pos, r.value) for r in E.extract_dygraph(pages(spark, html)).collect())
    assert got == [(0, 0, 9.0), (1, 0, 10.0), (1, 2, 12.0), (2, 0, 500.0), (2, 1, 510.0)]


@pytest.mark.parametrize("text,want", [
    ("{a: 'it\\'s \"x\"', b: [1,,2,], c: undefined, d: NaN}", {"a": "it's \"x\"", "b": [1, None, 2], "c": None, "d": None}),
    ("{'a': `m`, \"b\": -1.5e3, 7: true, // x\n u: 'http://h/?a=1,2]', /* } */ e: []}", {"a": "m", "b": -1500.0, "7": True, "u": "http://h/?a=1,2]", "e": []}),
    ("{a: new Date(2020, 1, 1), b: Date.UTC(2020, 0, 5), c: new Date('2020-01-05'), d: new Date(5), e: new Date()}", {"a": 1580515200000, "b": 1578182400000, "c": "2020-01-05", "d": 5, "e": None}),
    ("{a: [[1, 2], [3, 4.5], [5, x]], b: {c: {d: [,1]}}}", {"a": [[1, 2], [3, 4.5], [5, None]], "b": {"c": {"d": [None, 1]}}}),
])
def test_literals_become_json(spark, text, want):
    from weekloom.functions.literals import literal_json
    got = spark.createDataFrame([(text,)], "t string").select(literal_json(E.F.col("t")).alias("j")).first().j
    assert json.loads(got) == want


def test_long_charts_take_no_stack(spark):
    n = 20000
    days = [str(date.fromordinal(700000 + i)) for i in range(n)]
    charts = ["x = {datasets: [{label: 'Subscribers', data: [%s]}], labels: [%s]}" % (",".join(map(str, range(n))), ",".join(f"'{d}'" for d in days)),
              "data: [%s]" % ",".join(f"[{1500000000000 + i * 86400000}, {i}]" for i in range(n)), "Highcharts {xAxis: {categories: [%s]}, series: [{data: [%s]}]}" % (",".join(f'"{d}"' for d in days), ",".join(["null, 1"] * (n // 2)))]
    got = E.extract_points(pages(spark, *(f"<script>{c}</script>" for c in charts))).groupBy("channel").count().collect()
    assert {r.channel: r["count"] for r in got} == {"c0": n, "c1": n, "c2": n}
