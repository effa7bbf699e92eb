"""Jobs over stored pages (entity, snapshot stamp, url, html): typed rows out of page text.

Every extractor is a set of SQL functions on the html column. A page it cannot read yields no
rows and shows up in ``extract_errors``. Pages that lack the keyword of an extractor are
skipped by a plain substring test before any pattern runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions import literals as L, scalars as S
from weekloom.operators.ranking import first_per_week

PAGE_KEY = ["channel", "snapshot_ts"]
_NUM = "double"


def _all(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _one(text: Column, pattern: str, group: int = 1) -> Column:
    """First match of the group, null when absent."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _hold(value: Column) -> Column:
    """Generator of exactly ``value``.

    A filter on the result stays above the generator. On a plain column it would move below the
    projection and run the patterns a second time.
    """
    return F.explode(F.array(value))


def _has(html: Column, word: str) -> Column:
    return F.lower(html).contains(word)


# --- chart points ----------------------------------------------------------------------------
#
# Two steps per library. ``*_text`` cuts the chart's literals out of the page's scripts as
# array<string>; the page itself is not needed after that. The second step reads those texts as
# JSON. Arrays are zipped before they are transformed: indexing one array from a lambda over
# another would parse it again per element. A null in a series stays null; a series that is not
# there counts as 0.

_POINT = "array<struct<date_text:string,subs:bigint,views:bigint,longform_views:bigint,shorts_views:bigint>>"
#: An object that has labels of its own: between its bracket and the name stand whole values only. All loops are
#: possessive, so they take no stack.
_STRING = r'"(?:[^"\\]|\\.)*+"'
_NESTED = rf'\{{(?:[^{{}}"]++|{_STRING}|\{{(?:[^{{}}"]++|{_STRING}|\{{(?:[^{{}}"]++|{_STRING})*+\}})*+\}})*+\}}'
_LABELLED = rf'(?=\{{(?:[^{{}}"]++|(?!"labels":\[){_STRING}|{_NESTED})*+"labels":\[)'


def _dygraph_text(js: Column) -> Column:
    return F.when(js.contains('"data":[') | js.contains("Dygraph("), F.concat(
        L.behind(js, r'"data":', r"\[\["), L.behind(js, r"Dygraph\([^,\[]*,", r"\[\[")))


def _highcharts_text(js: Column) -> Column:
    """Categories and series of the first chart; the series is cut off where the next one begins."""
    return F.when(js.contains('"series":['), F.array(L.first_behind(js, '"categories":'), L.first_behind(js, '"series":')))


def _plotly_text(js: Column) -> Column:
    return F.when(js.contains('"x":['), F.array(L.first_behind(js, '"x":'), L.first_behind(js, '"y":')))


def _chartjs_text(js: Column) -> Column:
    """Every object with labels of its own, whatever its name."""
    parts = F.split(js, _LABELLED, -1)
    return F.when(js.contains('"labels":['), F.filter(parts, lambda t: t.startswith("{") & t.contains('"labels":[')))


def _series_text(js: Column) -> Column:
    return F.when(js.contains('"seriesData":['), L.behind(js, '"seriesData":', r"\["))


def _table_text(html: Column) -> Column:
    return F.when(_has(html, "<tr"), _all(html, r"(?si)<tr[^>]*>(.*?)</tr>"))


#: Texts from the page's literals, in the order in which a page without a library's name is tried.
_TEXT = {"dygraph": _dygraph_text, "highcharts": _highcharts_text, "plotly": _plotly_text, "chartjs": _chartjs_text, "series": _series_text}


def _zip(dates: Column, subs: Column, views: Column | None = None, longform: Column | None = None,
         shorts: Column | None = None) -> Column:
    """Points of zipped lists; positions without a date are left out later. Nulls of a series stay; a series that is
    absent, or ends before the dates do, counts as 0."""
    lists = {"d": F.coalesce(dates, F.array().cast("array<string>"))}
    for n, c in (("s", subs), ("v", views), ("l", longform), ("h", shorts)):
        given = F.array().cast("array<double>") if c is None else F.coalesce(c, F.array().cast("array<double>"))
        # each value in a struct, so that a null of the series and the end of the series differ
        lists[n] = F.transform(given, lambda x: F.struct(x.alias("x")))

    def num(v: Column) -> Column:
        return F.when(v.isNull(), F.lit(0).cast("bigint")).otherwise(v["x"].cast("bigint"))

    return F.transform(F.arrays_zip(*[c.alias(n) for n, c in lists.items()]), lambda z: F.struct(
        z["d"].alias("date_text"), num(z["s"]).alias("subs"), num(z["v"]).alias("views"), num(z["l"]).alias("longform_views"),
        num(z["h"]).alias("shorts_views"))).cast(_POINT)


def _text_at(a: Column, i: int) -> Column:
    return F.try_element_at(a, F.lit(i))


def _items(text: Column, path: str = "$") -> Column:
    """The values of a JSON list at ``path`` as VARIANTs; null where there is no list."""
    return F.try_variant_get(F.try_parse_json(text), path, "array<variant>")


def _value(v: Column) -> Column:
    """The number of a point that is a number, a pair or an object with ``y``, ``value`` or ``subs``."""
    return F.coalesce(F.try_variant_get(v, "$[1]", _NUM), *[F.try_variant_get(v, f"$.{n}", _NUM) for n in ("y", "value", "subs", "subscribers")], F.try_variant_get(v, "$", _NUM))


def _moment(v: Column) -> Column:
    """The time of a point that is a pair or an object, as text."""
    return F.coalesce(F.try_variant_get(v, "$[0]", "string"), *[F.try_variant_get(v, f"$.{n}", "string") for n in ("x", "date", "time", "timestamp")])


def _highcharts_points(a: Column) -> Column:
    """Dates are the categories or, if the points carry their own, the first series' times."""
    first, second = _items(_text_at(a, 2), "$[0].data"), _items(_text_at(a, 2), "$[1].data")
    named = F.transform(_items(_text_at(a, 1)), lambda c: F.try_variant_get(c, "$", "string"))
    timed = F.transform(first, _moment)
    dates = F.when(F.exists(timed, lambda t: t.isNotNull()), timed).otherwise(named)
    return _zip(dates, F.transform(first, _value), F.transform(second, _value))


def _plotly_points(a: Column) -> Column:
    """Dates and values up to the shorter list; the value is the subscriber count."""
    dates, values = F.transform(_items(_text_at(a, 1)), lambda c: F.try_variant_get(c, "$", "string")), F.transform(_items(_text_at(a, 2)), _value)
    n = F.greatest(F.least(F.size(dates), F.size(values)), F.lit(0))
    return F.slice(_zip(dates, values), F.lit(1), n)


def _chartjs_points(a: Column) -> Column:
    charts = F.transform(a, lambda t: F.try_variant_get(F.try_parse_json(t), "$", "struct<labels:array<string>,datasets:array<variant>>"))
    chart = F.try_element_at(F.filter(charts, lambda c: (F.size(c["labels"]) > 0) & (F.size(c["datasets"]) > 0)), F.lit(1))

    def kind(dataset: Column) -> Column:
        name = F.lower(F.coalesce(F.try_variant_get(dataset, "$.label", "string"), F.lit("")))
        return (F.when(name.contains("subscriber"), F.lit("subs"))
                .when(name.contains("total") & name.contains("view"), F.lit("views"))
                .when(name.contains("long"), F.lit("longform")).when(name.contains("short"), F.lit("shorts"))
                .otherwise(F.lit("other")))

    def last_of(name: str) -> Column:
        chosen = F.try_element_at(F.filter(chart["datasets"], lambda d: kind(d) == name), F.lit(-1))
        return F.transform(F.try_variant_get(chosen, "$.data", "array<variant>"), _value)

    return _zip(chart["labels"], last_of("subs"), last_of("views"), last_of("longform"), last_of("shorts"))


def _series_points(a: Column) -> Column:
    """Points of the first list whose items carry a time; an object may state subscribers, views and their parts by name."""
    lists = F.transform(a, lambda t: F.coalesce(_items(t, "$[0].data"), _items(t)))
    points = F.try_element_at(F.filter(lists, lambda x: F.exists(x, lambda p: _moment(p).isNotNull())), F.lit(1))

    def named(*names: str) -> Column:
        found = F.transform(points, lambda p: F.coalesce(*[F.try_variant_get(p, f"$.{n}", _NUM) for n in names]))
        return F.when(F.exists(found, lambda x: x.isNotNull()), found)            # no point has it: the series is absent
    return _zip(F.transform(points, _moment), F.transform(points, _value), named("views", "total_views", "totalViews"), named("longform_views", "longform"), named("shorts_views", "shorts"))


_POINTS = {"highcharts": _highcharts_points, "plotly": _plotly_points, "chartjs": _chartjs_points, "series": _series_points}


def _cut(pages: DataFrame, html: str, library: str) -> DataFrame:
    if library == "unknown":
        rows = pages.select(*PAGE_KEY, _hold(_table_text(F.col(html))).alias("_a"))
    else:
        rows = pages.select(*PAGE_KEY, _hold(L.page_literals(F.col(html))).alias("_js")).select(*PAGE_KEY, _hold(_TEXT[library](F.col("_js"))).alias("_a"))
    return rows.filter(F.size("_a") > 0).withColumn("library", F.lit(library))


def _explode_points(rows: DataFrame, points: Column) -> DataFrame:
    out = rows.select(*PAGE_KEY, "library", F.explode(points).alias("_p")).filter(F.col("_p.date_text").isNotNull())
    return out.select(*PAGE_KEY, "_p.*", F.col("library").alias("extraction_method"))


def _dygraph_series(a: Column) -> Column:
    """All series of a page: of an array of rows every column behind the time is one, in order."""
    def columns(text: Column) -> Column:
        return F.transform(_items(text), lambda r: F.try_variant_get(r, "$", "array<variant>"))

    def series(rows: Column) -> Column:
        width = F.coalesce(F.array_max(F.transform(rows, lambda r: F.size(r))), F.lit(0))
        return F.transform(F.when(width > 1, F.sequence(F.lit(1), width - 1)).otherwise(F.array().cast("array<int>")), lambda j: F.transform(rows, lambda r: F.struct(
            F.try_variant_get(F.get(r, F.lit(0)), "$", _NUM).cast("bigint").alias("t"), F.try_variant_get(F.get(r, j), "$", _NUM).alias("v"))))
    return F.flatten(F.transform(F.filter(F.transform(a, columns), lambda rows: rows.isNotNull()), series))


def _dygraph_rows(rows: DataFrame) -> DataFrame:
    rows = rows.select(*PAGE_KEY, F.posexplode(_dygraph_series(F.col("_a"))).alias("array_no", "_s"))
    rows = rows.select(*PAGE_KEY, "array_no", F.posexplode("_s").alias("pos", "_e"))
    out = rows.select(*PAGE_KEY, "array_no", "pos", F.col("_e.t").alias("epoch_ms"), F.col("_e.v").alias("value"))
    return out.filter(F.col("epoch_ms").isNotNull() & F.col("value").isNotNull())


def extract_dygraph(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every ``data: [[t, v, ...], ...]`` array: key, array number, position, epoch_ms, value; each column behind the time has a number."""
    return _dygraph_rows(_cut(pages, html, "dygraph"))


def series_profile(points: DataFrame) -> DataFrame:
    """Shape of each array: size, range, mean, direction, span, likely meaning."""
    out = points.groupBy(*PAGE_KEY, "array_no").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("min_value"), F.max("value").alias("max_value"),
        F.avg("value").alias("avg_value"), F.min_by("value", "pos").alias("_first"), F.max_by("value", "pos").alias("_last"),
        F.floor((F.max("epoch_ms") - F.min("epoch_ms")) / F.lit(86_400_000)).cast("int").alias("span_days"))
    return out.withColumns({
        "is_increasing": F.col("_last") > F.col("_first"),
        "likely_subscribers": (F.col("avg_value") < 50_000_000) & (F.col("max_value") < 100_000_000),
        "likely_views": (F.col("avg_value") > 1_000_000) | (F.col("max_value") > 100_000_000),
    }).withColumn("realistic_growth", (F.col("min_value") > 0) & F.col("is_increasing")
                  & (F.col("max_value") > F.col("min_value") * F.lit(1.1))).drop("_first", "_last")


def _points(cond: Column, n: int) -> Column:
    return F.when(cond, n).otherwise(0)


def _shared_score() -> Column:
    return (_points(F.col("realistic_growth"), 5) + _points(F.col("min_value") != 0, 3) + _points(F.col("n") > 100, 2)
            + _points(F.col("is_increasing"), 2) + _points(F.col("span_days") > 600, 3))


def pick_series(profile: DataFrame) -> DataFrame:
    """Per page the arrays that best look like subscribers and like views (first best wins)."""
    avg = F.col("avg_value")
    subs_range = (F.when(avg.between(100_000, 50_000_000), 20).when(avg < 10_000_000, 5)
                  .when(avg < 25_000_000, 3).otherwise(0))
    views_range = (F.when(avg > 500_000_000, 25).when(avg > 100_000_000, 20).when(avg > 10_000_000, 15)
                   .when(avg > 1_000_000, 10).otherwise(0))
    rows = profile.withColumns({
        "_s": F.when((F.col("max_value") <= 100_000_000) & (avg <= 50_000_000),
                     _points(F.col("likely_subscribers"), 10) + subs_range + _shared_score()).otherwise(F.lit(0)),
        "_v": _points(F.col("likely_views"), 10) + views_range + _shared_score()})
    page = Window.partitionBy(*PAGE_KEY)
    best = F.max(F.when(F.col("_s") > 0, F.struct(F.col("_s").alias("s"), (-F.col("array_no")).alias("a")))).over(page)
    rows = rows.withColumn("_subs", -best["a"])
    free = (F.col("_v") > 0) & (F.col("_subs").isNull() | (F.col("array_no") != F.col("_subs")))
    return rows.groupBy(*PAGE_KEY).agg(
        F.max("_subs").cast("int").alias("subs_array"),
        (-F.max(F.when(free, F.struct(F.col("_v").alias("s"), (-F.col("array_no")).alias("a"))))["a"]).cast("int").alias("views_array"))


def combine_series(points: DataFrame, picked: DataFrame, tol_days: int = 28) -> DataFrame:
    """Subs points with the nearest view count (tie: earlier); a missing side counts as zero.

    Both series stay in one frame: of each page's points, which came out of one row, every subs point looks at the view
    points before and after it. Points and picks meet in one exchange each, and nothing is joined again.
    """
    is_subs, is_views = F.col("array_no") == F.col("subs_array"), F.col("array_no") == F.col("views_array")
    rows = points.join(picked, PAGE_KEY).filter(F.coalesce(is_subs, F.lit(False)) | F.coalesce(is_views, F.lit(False)))
    t, span = F.col("epoch_ms"), tol_days * 86_400_000
    value = F.col("value").cast("bigint")
    page = Window.partitionBy(*PAGE_KEY)
    # of several view counts at one time the largest; frames reach to the rows of the same time
    before = F.max(F.when(is_views, F.struct(t.alias("t"), value.alias("v")))).over(page.orderBy("epoch_ms").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.max(F.when(is_views, F.struct((-t).alias("t"), value.alias("v")))).over(page.orderBy(t.desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumns({"_before": before, "_after": after})
    back, ahead = t - F.col("_before.t"), -F.col("_after.t") - t
    near_back, near_ahead = F.when(back <= span, back), F.when(ahead <= span, ahead)
    found = F.when(near_back.isNotNull() & (near_ahead.isNull() | (near_back <= near_ahead)), F.col("_before.v")).when(near_ahead.isNotNull(), F.col("_after.v"))
    zero = F.lit(0).cast("bigint")
    rows = rows.filter(F.coalesce(is_subs, F.lit(False)) | F.col("subs_array").isNull())
    return rows.select(*PAGE_KEY, F.timestamp_millis("epoch_ms").cast("date").cast("string").alias("date_text"), F.when(F.col("subs_array").isNull(), zero).otherwise(value).alias("subs"),
                       F.when(F.col("subs_array").isNull(), value).otherwise(F.coalesce(found, zero)).alias("views"), F.lit("dygraph").alias("extraction_method"))


def extract_highcharts(pages: DataFrame, html: str = "html") -> DataFrame:
    """Categories with the first series as subs and the second as views, one row per date."""
    return _explode_points(_cut(pages, html, "highcharts"), _highcharts_points(F.col("_a"))).drop("longform_views", "shorts_views")


def extract_plotly(pages: DataFrame, html: str = "html") -> DataFrame:
    """Dates and values zipped up to the shorter list; the value is the subscriber count."""
    return _explode_points(_cut(pages, html, "plotly"), _plotly_points(F.col("_a"))).drop("longform_views", "shorts_views")


def extract_chartjs(pages: DataFrame, html: str = "html") -> DataFrame:
    """Labelled datasets of an embedded chart object; absent series count as 0."""
    return _explode_points(_cut(pages, html, "chartjs"), _chartjs_points(F.col("_a")))


def extract_series(pages: DataFrame, html: str = "html") -> DataFrame:
    """Points of ``seriesData`` lists: pairs, or objects with a time and a value."""
    return _explode_points(_cut(pages, html, "series"), _series_points(F.col("_a")))


def _cells(row: Column) -> Column:
    return F.transform(_all(row, r"(?si)<t[dh][^>]*>(.*?)</t[dh]>"), lambda c: F.trim(F.regexp_replace(c, r"(?s)<[^>]*>", "")))


def extract_history_table(pages: DataFrame, html: str = "html") -> DataFrame:
    """Rows of an HTML table headed Date / Subscribers / Views / Videos, columns found by header."""
    return _table_rows(_cut(pages, html, "unknown"))


def _table_rows(rows: DataFrame) -> DataFrame:
    rows = rows.select(*PAGE_KEY, F.col("_a").alias("_rows"))
    head = F.try_element_at(F.filter("_rows", lambda r: r.rlike(r"(?si)<t[dh][^>]*>\s*date\s*<")), F.lit(1))
    names = F.transform(_cells(head), lambda c: F.lower(c))
    # the header is its own column below the explode, else it would be found again for every row
    rows = rows.withColumn("_h", names).filter(F.size("_h") > 0)
    rows = rows.select(*PAGE_KEY, "_h", F.explode("_rows").alias("_r"))
    rows = rows.select(*PAGE_KEY, "_h", F.explode(F.array(_cells(F.col("_r")))).alias("_v"))

    def cell(*words: str) -> Column:
        at = F.array_position(F.transform("_h", lambda c: F.greatest(*[c.contains(w) for w in words], F.lit(False))), True).cast("int")
        return F.when(at > 0, F.try_element_at("_v", at))

    # the explode of one struct keeps each cell a computed column: parsing refers to it many times
    picked = F.struct(cell("date").alias("date_text"), cell("subscriber").alias("s"), cell("view").alias("v"),
                      cell("upload", "videos").alias("n"))
    rows = rows.select(*PAGE_KEY, F.explode(F.array(picked)).alias("_p")).filter(S.parse_flexible_date(F.col("_p.date_text")).isNotNull())
    zero = F.lit(0).cast("bigint")
    return rows.select(
        *PAGE_KEY, F.col("_p.date_text").alias("date_text"), F.coalesce(S.parse_compact_number(F.col("_p.s")), zero).alias("subs"),
        F.coalesce(S.parse_compact_number(F.col("_p.v")), zero).alias("views"),
        S.parse_compact_number(F.col("_p.n")).alias("videos"), F.lit("table").alias("extraction_method"))


def extract_data_attr(pages: DataFrame, attr: str = "data-subs", field: str = "subs", html: str = "html") -> DataFrame:
    """JSON list of (date, value) stored in an HTML attribute."""
    text = F.col(html)
    return _attr_rows(pages.filter(text.contains(attr)).select(*PAGE_KEY, _hold(_attr_text(text, attr)).alias("_t")), field)


def _attr_text(html: Column, attr: str) -> Column:
    return F.when(html.contains(attr), _one(html, rf"(?s){attr}\s*=\s*'([^']*)'"))


def _attr_rows(rows: DataFrame, field: str) -> DataFrame:
    items = F.from_json("_t", f"array<struct<date string, {field} double>>")
    rows = rows.select(*PAGE_KEY, F.explode(items).alias("_p"))
    return rows.filter(F.col("_p.date").isNotNull()).select(
        *PAGE_KEY, F.col("_p.date").alias("date_text"), F.col(f"_p.{field}").cast("bigint").alias(field),
        F.lit("data_attr").alias("extraction_method"))


def standardize(points: DataFrame, source: str = "WAYBACK_CHARTS") -> DataFrame:
    """Typed weekly observations: parsed date, Sunday week, whole counts, first point per week and snapshot."""
    rows = points.withColumn("obs_date", S.parse_flexible_date("date_text")).filter(F.col("obs_date").isNotNull())
    numbers = [c for c in ("subs", "views", "videos", "longform_views", "shorts_views") if c in points.columns]
    missing = [c for c in ("subs", "views") if c not in points.columns]
    # a point without a number stays without one
    rows = rows.withColumns({**{c: F.when(F.col(c).isNotNull(), S.clean_numeric(F.col(c).cast("string"))) for c in numbers},
                             **{c: F.lit(0).cast("bigint") for c in missing}})
    rows = rows.drop("date_text").withColumn("_page", F.struct(*PAGE_KEY))
    return (first_per_week(rows, key="_page").drop("_page")
            .withColumn("collection_source", F.lit(source)))


# --- single counters -------------------------------------------------------------------------

# fixed values: element names that carry the upload count, in order
UPLOAD_ELEMENTS = [("class", "youtube-stats-header-uploads"), ("id", "youtube-stats-header-uploads"), ("class", "stats-uploads"),
                   ("class", "upload-count"), ("class", "video-count")]
# fixed values: patterns of the upload count, in order
UPLOAD_PATTERNS = [
    r'class="youtube-stats-header-uploads"[^>]*>\s*([0-9,]+)',
    r"<strong[^>]*>Uploads</strong>[^<]*<br[^>]*>\s*([0-9,]+)",
    r'id="youtube-stats-header-uploads"[^>]*>\s*([0-9,]+)',
    r"uploads?[\"'][^>]*>\s*([0-9,]+)",
    r"video[s]?[\"'][^>]*>\s*([0-9,]+)",
    r"(\d+(?:,\d{3})*)\s*(?:uploads?|videos?)",
    r'<meta property="og:description" content="[^"]*(\d+(?:,\d{3})*)\s*(?:uploads?|videos?)',
    r"<title>[^<]*?(\d+(?:,\d{3})*)\s*(?:uploads?|videos?)",
    r'"videoCount":\s*"?(\d+)"?',
    r'"uploads":\s*"?(\d+)"?',
]


def _first_hit(html: Column, pattern: str, parse) -> Column:
    """First match of a pattern that parses to a positive number."""
    values = F.transform(_all(html, "(?i)" + pattern), lambda v: parse(v))
    return F.try_element_at(F.filter(values, lambda v: v > 0), F.lit(1))


def ld_json(html: Column) -> Column:
    """Bodies of the JSON-LD scripts of a page."""
    return _all(html, r"(?si)<script[^>]*type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>")


def upload_count(html: Column) -> Column:
    """Upload count by the cascade: marked elements, patterns, JSON-LD, meta and title text."""
    steps = []
    for attr, name in UPLOAD_ELEMENTS:
        text = _one(html, rf"(?si)<[a-z0-9]+[^>]*\b{attr}\s*=\s*[\"'](?:[^\"']*\s)?{name}(?:\s[^\"']*)?[\"'][^>]*>(.*?)</")
        steps.append(S.parse_grouped_int(F.regexp_replace(text, r"(?s)<[^>]*>", "")))
    steps += [_first_hit(html, p, S.parse_grouped_int) for p in UPLOAD_PATTERNS]
    keys = F.transform(ld_json(html), lambda j: S.parse_grouped_int(F.coalesce(
        F.get_json_object(j, "$.videoCount"), F.get_json_object(j, "$.uploads"), F.get_json_object(j, "$.numberOfVideos"))))
    steps.append(F.try_element_at(F.filter(keys, lambda v: v > 0), F.lit(1)))
    for texts in (_all(html, r"(?si)<meta[^>]*content=[\"']([^\"']*(?:upload|video)[^\"']*)[\"']"),
                  _all(html, r"(?si)<title[^>]*>([^<]*(?:upload|video)[^<]*)</title>")):
        found = F.flatten(F.transform(texts, lambda t: _all(t, r"(\d+(?:,\d{3})*)")))
        values = F.transform(found, lambda v: S.parse_grouped_int(v))
        steps.append(F.try_element_at(F.filter(values, lambda v: v > 0), F.lit(1)))
    return F.coalesce(*steps)


def page_upload_count(pages: DataFrame, html: str = "html", plausible: int = 100_000) -> DataFrame:
    """Every page (its key, url) with the upload count it states, or null; ``in_range`` is false above ``plausible``."""
    text = F.col(html)
    count = F.when(_has(text, "upload") | _has(text, "video"), upload_count(text))
    rows = pages.select(*PAGE_KEY, "url", _hold(count).alias("upload_count"))
    return rows.withColumn("in_range", F.col("upload_count") <= plausible)


def extract_upload_count(pages: DataFrame, html: str = "html", plausible: int = 100_000) -> DataFrame:
    """One row per page that states an upload count; ``in_range`` is false above ``plausible``."""
    return page_upload_count(pages, html, plausible).filter(F.col("upload_count").isNotNull()).drop("url")


# fixed values: patterns of the current counters, in order
CURRENT_PATTERNS = {
    "total_views": [
        r'<div[^>]*class="[^"]*stats-key[^"]*"[^>]*>Total Views</div>[^<]*<[^>]*class="[^"]*value[^"]*"[^>]*>([0-9,KMB.]+)',
        r'<div[^>]*class="[^"]*stats-key[^"]*"[^>]*>Views</div>[^<]*<[^>]*>([0-9,KMB.]+)</[^>]*>',
        r"stats-key[^>]*>(?:Total )?Views</div>[^<]*<[^>]*>([0-9,KMB.]+)",
        r'data-metric="total.views"[^>]*data-value="([0-9,KMB.]+)"',
        r'data-value="([0-9,KMB.]+)"[^>]*data-metric="total.views"',
        r"<strong[^>]*>([0-9,KMB.]+)</strong>[^<]*(?:total\s+)?views?",
        r"(?:total\s+)?views?[^<]*<strong[^>]*>([0-9,KMB.]+)</strong>",
        r"([0-9,]+(?:\.[0-9]+)?[KMB]?)\s*(?:total\s+)?views?",
        r"(?:total\s+)?views?[^\w]*([0-9,]+(?:\.[0-9]+)?[KMB]?)",
    ],
    "subscriber_count": [
        r'<div[^>]*class="[^"]*stats-key[^"]*"[^>]*>Subscribers</div>[^<]*<[^>]*class="[^"]*value[^"]*"[^>]*>([0-9,KMB.]+)',
        r"stats-key[^>]*>Subscribers</div>[^<]*<[^>]*>([0-9,KMB.]+)</[^>]*>",
        r'data-metric="subscribers?"[^>]*data-value="([0-9,KMB.]+)"',
        r'data-value="([0-9,KMB.]+)"[^>]*data-metric="subscribers?"',
        r"<strong[^>]*>([0-9,KMB.]+)</strong>[^<]*subscribers?",
        r"subscribers?[^<]*<strong[^>]*>([0-9,KMB.]+)</strong>",
        r"([0-9,]+(?:\.[0-9]+)?[KMB]?)\s*(?:subscribers?|subs?)",
        r"(?:subscribers?|subs?)[^\w]*([0-9,]+(?:\.[0-9]+)?[KMB]?)",
        r"([0-9.]+[KMB])[^a-zA-Z]*subscribers?",
        r"subscribers?[^a-zA-Z]*([0-9.]+[KMB])",
    ],
    "longform_views": [
        r'<div[^>]*class="[^"]*stats-key[^"]*"[^>]*>(?:Longform|Long[- ]?form) Views</div>[^<]*<[^>]*class="[^"]*value[^"]*"[^>]*>([0-9,KMB.]+)',
        r"stats-key[^>]*>(?:Longform|Long[- ]?form)[^<]*</div>[^<]*<[^>]*>([0-9,KMB.]+)",
        r'data-metric="longform"[^>]*data-value="([0-9,KMB.]+)"',
        r"<strong[^>]*>([0-9,KMB.]+)</strong>[^<]*longform",
        r"longform[^<]*<strong[^>]*>([0-9,KMB.]+)</strong>",
        r"([0-9,]+(?:\.[0-9]+)?[KMB]?)[^<]*longform",
    ],
    "shorts_views": [
        r'<div[^>]*class="[^"]*stats-key[^"]*"[^>]*>Shorts Views</div>[^<]*<[^>]*class="[^"]*value[^"]*"[^>]*>([0-9,KMB.]+)',
        r'<div[^>]*class="[^"]*stats-key[^"]*"[^>]*>Shorts</div>[^<]*<[^>]*class="[^"]*value[^"]*"[^>]*>([0-9,KMB.]+)',
        r"stats-key[^>]*>Shorts[^<]*</div>[^<]*<[^>]*>([0-9,KMB.]+)",
        r'data-metric="shorts"[^>]*data-value="([0-9,KMB.]+)"',
        r"<strong[^>]*>([0-9,KMB.]+)</strong>[^<]*shorts?",
        r"shorts?[^<]*<strong[^>]*>([0-9,KMB.]+)</strong>",
        r"([0-9,]+(?:\.[0-9]+)?[KMB]?)[^<]*shorts?",
    ],
}
_CURRENT_WORD = {"total_views": "view", "subscriber_count": "sub", "longform_views": "form", "shorts_views": "short"}

# fixed values: script variables that hold a JSON object
SCRIPT_OBJECTS = [
    r"(?s)window\.__INITIAL_DATA__\s*=\s*(\{.*?\});",
    r"(?s)var\s+data\s*=\s*(\{.*?\});",
    r"(?s)window\.data\s*=\s*(\{.*?\});",
    r"(?s)__DATA__\s*=\s*(\{.*?\});",
]
_LD_TYPE = ("viewCount string, subscriberCount string, "
            "interactionStatistic array<struct<`@type` string, userInteractionCount string>>")


def json_object(html: Column) -> Column:
    """First JSON-LD body or script object of a page that carries a known counter."""
    bodies = F.concat(ld_json(html), F.array(*[_one(html, p) for p in SCRIPT_OBJECTS]))
    objs = F.filter(F.transform(F.filter(bodies, lambda b: b.isNotNull()), lambda b: F.from_json(b, _LD_TYPE)),
                    lambda o: o["viewCount"].isNotNull() | o["subscriberCount"].isNotNull() | o["interactionStatistic"].isNotNull())
    return F.when(_has(html, "<script"), F.try_element_at(objs, F.lit(1)))


def _object_metrics(obj: Column) -> dict[str, Column]:
    """Counters of a parsed object; direct properties before interaction statistics."""
    def stat(word: str) -> Column:
        hits = F.filter(F.coalesce(obj["interactionStatistic"], F.array().cast("array<struct<`@type`:string,userInteractionCount:string>>")),
                        lambda s: F.lower(s["@type"]).contains(word))
        counts = F.filter(F.transform(hits, lambda s: S.parse_compact_number(s["userInteractionCount"])), lambda v: v > 0)
        return F.try_element_at(counts, F.lit(-1))

    return {"total_views": F.coalesce(F.nullif(S.parse_compact_number(obj["viewCount"]), F.lit(0)), stat("view")),
            "subscriber_count": F.coalesce(F.nullif(S.parse_compact_number(obj["subscriberCount"]), F.lit(0)), stat("subscribe"))}


def _any_counter(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("total_views").isNotNull() | F.col("subscriber_count").isNotNull())


def extract_json_ld(pages: DataFrame, html: str = "html") -> DataFrame:
    """Counters from structured data; pages without any drop out."""
    text = F.col(html)
    rows = pages.filter(_has(text, "<script")).select(*PAGE_KEY, _hold(json_object(text)).alias("_o"))
    return _any_counter(rows.filter(F.col("_o").isNotNull()).select(*PAGE_KEY, *[c.alias(n) for n, c in _object_metrics(F.col("_o")).items()]))


def extract_current_metrics(pages: DataFrame, html: str = "html") -> DataFrame:
    """Current counters: pattern cascades, overridden by structured data; needs views or subs."""
    text = F.col(html)
    found = {name: F.when(_has(text, _CURRENT_WORD[name]), F.coalesce(*[_first_hit(text, p, S.parse_compact_number) for p in patterns]))
             for name, patterns in CURRENT_PATTERNS.items()}
    parts = F.struct(json_object(text).alias("o"), *[c.alias(n) for n, c in found.items()])
    rows = pages.select(*PAGE_KEY, _hold(parts).alias("_m"))
    stated = _object_metrics(F.col("_m.o"))
    return _any_counter(rows.select(
        *PAGE_KEY, *[F.coalesce(stated[n], F.col(f"_m.{n}")).alias(n) if n in stated else F.col(f"_m.{n}").alias(n) for n in CURRENT_PATTERNS]))


def chart_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """One pass over the pages: library and chart text; the html column ends here.

    The library that the page names is tried first, then every other one: what can be read counts, named or not. A page
    without a readable chart falls back to its data attribute, then to its history table.
    """
    text, js = F.col(html), F.col("_js")
    rows = pages.select(*PAGE_KEY, html, _hold(F.struct(S.detect_chart_library(html).alias("named"), L.page_literals(text).alias("js"))).alias("_n"))
    rows = rows.select(*PAGE_KEY, html, F.col("_n.named").alias("named"), F.col("_n.js").alias("_js"))
    none = F.array().cast("array<string>")
    cut = F.array(*[F.struct(F.lit(name).alias("library"), F.coalesce(fn(js), none).alias("_a")) for name, fn in _TEXT.items()])
    own = F.concat(F.filter(cut, lambda c: c["library"] == F.col("named")), F.filter(cut, lambda c: c["library"] != F.col("named")))
    found = F.when(js.isNotNull(), F.filter(own, lambda c: F.size(c["_a"]) > 0))
    attr = F.filter(F.array(_attr_text(text, "data-subs")), lambda t: t.isNotNull())
    spare = F.array(F.struct(F.lit("data_attr").alias("library"), attr.alias("_a")), F.struct(F.lit("unknown").alias("library"), F.coalesce(_table_text(text), none).alias("_a")))
    listed = F.concat(F.coalesce(found, F.slice(cut, 1, 0)), F.filter(spare, lambda c: F.size(c["_a"]) > 0))

    def readable(c: Column) -> Column:
        ok = F.when(c["library"] == "dygraph", F.exists(_dygraph_series(c["_a"]), lambda s: F.exists(s, lambda p: p["t"].isNotNull() & p["v"].isNotNull())))
        for name, points in _POINTS.items():
            ok = ok.when(c["library"] == name, F.exists(points(c["_a"]), lambda p: p["date_text"].isNotNull()))
        return F.coalesce(ok.otherwise(F.lit(True)), F.lit(False))
    rows = rows.select(*PAGE_KEY, _hold(listed).alias("_c"))
    return rows.select(*PAGE_KEY, _hold(F.get(F.filter("_c", readable), F.lit(0))).alias("_c")).filter("_c IS NOT NULL").select(*PAGE_KEY, "_c.library", "_c._a")


def extract_points(pages: DataFrame, html: str = "html", materialize: bool = False) -> DataFrame:
    """All chart and table points of all pages, by the library each page uses.

    A page without a readable chart falls back to its data attribute or history table; such points
    have ``low_quality`` set. ``materialize`` writes the
    chart texts to the checkpoint folder, so the pages are scanned once whatever is done next.
    """
    rows = chart_text(pages, html)
    if materialize:
        from weekloom.session import cut_lineage
        rows = cut_lineage(rows)
    lib = F.col("library")
    points = None
    for name, fn in _POINTS.items():
        points = F.when(lib == name, fn(F.col("_a"))) if points is None else points.when(lib == name, fn(F.col("_a")))
    raw = _dygraph_rows(rows.filter(lib == "dygraph"))
    if materialize:
        raw = cut_lineage(raw)
    zipped = _explode_points(rows.filter(lib.isin(list(_POINTS))), points)
    dygraph = combine_series(raw, pick_series(series_profile(raw)))
    table = _table_rows(rows.filter(lib == "unknown"))
    listed = _attr_rows(rows.filter(lib == "data_attr").select(*PAGE_KEY, F.try_element_at("_a", F.lit(1)).alias("_t")), "subs")
    out = zipped
    for part in (dygraph, table, listed.withColumn("subs", F.coalesce("subs", F.lit(0).cast("bigint"))).withColumn("views", F.lit(0).cast("bigint"))):
        out = out.unionByName(part, allowMissingColumns=True)
    return out.withColumn("low_quality", F.col("extraction_method").isin("table", "data_attr"))


def extract_errors(pages: DataFrame, points: DataFrame) -> DataFrame:
    """Pages that yielded no row, with the library that was detected."""
    return (pages.select(*PAGE_KEY, "url", S.detect_chart_library("html").alias("library"))
            .join(points.select(*PAGE_KEY).distinct(), PAGE_KEY, "left_anti"))
