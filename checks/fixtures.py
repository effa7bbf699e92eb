"""Panels, observations, entities, indexes and pages derived from the given tables.

Each function has a CTE of the same name that yields the same rows in SQL.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.registry import cte
from weekloom.functions import scalars as S
from weekloom.operators.junctions import Junction
from weekloom.operators.windows import deltas

J1, J2 = date(1997, 9, 7), date(1999, 8, 1)
JUNCTIONS = [Junction("first", J1, 15.0), Junction("second", J2, 10.0)]
AS_OF = date(2002, 6, 30)
SPINE = (date(1995, 1, 1), date(2002, 3, 31))
INDEX_END = date(2001, 12, 31)
#: Line items whose weeks one task orders at most, whatever the size of the table (entities are not cut).
ITEMS_A_TASK = 1 << 19


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _channel(key):
    return F.concat(F.lit("S"), F.lpad(key.cast("string"), 6, "0"))


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly running totals per supplier, with planted level shifts at the two junctions."""
    li = table(spark, sf, "lineitem")
    weekly = li.groupBy(_channel(F.col("l_suppkey")).alias("channel"), S.week_start_sunday("l_shipdate").alias("week")).agg(
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("dv"), F.count(F.lit(1)).alias("ds"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("dn"))
    # all windows behind it work on these parts, so their number follows the table's rows (counted from the footers)
    weekly = weekly.repartition(-(-li.count() // ITEMS_A_TASK) or 1, "channel")
    w = Window.partitionBy("channel").orderBy("week").rowsBetween(Window.unboundedPreceding, 0)
    k = F.substring("channel", 2, 20).cast("bigint")
    first = (k % 7 == 0) & (F.col("week") >= F.lit(J1))
    second = (k % 5 == 0) & (F.col("week") >= F.lit(J2))
    rows = weekly.select(
        "channel", "week",
        (F.sum("dv").over(w) * F.when(first, 2).when(second, 3).otherwise(1)).alias("views"),
        (F.sum("ds").over(w) * F.when(first, 2).otherwise(1)).alias("subs"),
        (F.sum("dn").over(w) * F.when(first, 2).otherwise(1)).alias("videos"))
    # joined on the window key, so the rows keep their partitioning for the operators behind
    dim = supplier_nation(spark, sf).select("channel", "category")
    return rows.join(dim, "channel").select(
        "channel", "category", "week", "views", "subs", "videos",
        F.when(F.col("week") < F.lit(J1), F.lit("API")).when(F.col("week") < F.lit(J2), F.lit("WAYBACK_CHARTS"))
        .otherwise(F.lit("VIEWSTATS")).alias("collection_source"))


def supplier_nation(spark: SparkSession, sf: str) -> DataFrame:
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey").alias("k"), _channel(F.col("s_suppkey")).alias("channel"), F.col("s_name").alias("channel_name"),
        F.col("n_name").alias("category"))


cte("lw", """SELECT concat('S', lpad(CAST(l_suppkey AS VARCHAR), 6, '0')) AS channel, l_suppkey AS k,
 CAST(l_shipdate AS DATE) - CAST(dayofweek(CAST(l_shipdate AS DATE)) AS INTEGER) AS week,
 CAST(SUM(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS dv, COUNT(*) AS ds,
 CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS dn FROM lineitem GROUP BY ALL""")
cte("lc", """SELECT channel, k, week, CAST(SUM(dv) OVER w AS BIGINT) AS v, CAST(SUM(ds) OVER w AS BIGINT) AS s,
 CAST(SUM(dn) OVER w AS BIGINT) AS n FROM lw WINDOW w AS (PARTITION BY k ORDER BY week ROWS UNBOUNDED PRECEDING)""", "lw")
cte("panel", f"""SELECT channel, n_name AS category, week,
 v * CASE WHEN k % 7 = 0 AND week >= DATE '{J1}' THEN 2 WHEN k % 5 = 0 AND week >= DATE '{J2}' THEN 3 ELSE 1 END AS views,
 s * CASE WHEN k % 7 = 0 AND week >= DATE '{J1}' THEN 2 ELSE 1 END AS subs,
 n * CASE WHEN k % 7 = 0 AND week >= DATE '{J1}' THEN 2 ELSE 1 END AS videos,
 CASE WHEN week < DATE '{J1}' THEN 'API' WHEN week < DATE '{J2}' THEN 'WAYBACK_CHARTS' ELSE 'VIEWSTATS' END AS collection_source
 FROM lc JOIN supplier ON s_suppkey = k JOIN nation ON n_nationkey = s_nationkey""", "lc")


def full_panel(spark: SparkSession, sf: str) -> DataFrame:
    """The panel with all enhanced columns."""
    rows = deltas(panel(spark, sf))
    longform = F.expr("views * 7 div 10")
    return rows.withColumns({
        "activity": F.lit("active"), "total_longform_views": longform, "total_shorts_views": F.col("views") - longform,
        "channel_name": F.concat(F.lit("Name "), "channel"), "data_quality_flag": F.lit("good")})


cte("full_panel", """SELECT *, COALESCE(views - lag(views) OVER w, 0) AS delta_views, COALESCE(subs - lag(subs) OVER w, 0) AS delta_subs,
 COALESCE(videos - lag(videos) OVER w, 0) AS delta_videos, 'active' AS activity, views * 7 // 10 AS total_longform_views,
 views - views * 7 // 10 AS total_shorts_views, concat('Name ', channel) AS channel_name, 'good' AS data_quality_flag
 FROM panel WINDOW w AS (PARTITION BY channel ORDER BY week)""", "panel")


def defects(spark: SparkSession, sf: str) -> DataFrame:
    """The full panel with planted nulls, negatives, wrong splits and mixed flags."""
    p = full_panel(spark, sf)
    m = F.pmod(F.col("videos") + F.dayofmonth("week"), F.lit(23))
    return p.withColumns({
        "views": F.when(m == 1, F.lit(None)).when(m == 2, -F.col("views")).otherwise(F.col("views")).cast("bigint"),
        "subs": F.when(m == 3, F.lit(None)).when(m == 4, F.lit(0)).otherwise(F.col("subs")).cast("bigint"),
        "category": F.when(m == 5, F.lit(None)).otherwise(F.col("category")),
        "total_shorts_views": F.when(m == 6, F.col("total_shorts_views") * 3).otherwise(F.col("total_shorts_views")),
        "delta_subs": F.when(m == 7, F.col("subs") * 2).otherwise(F.col("delta_subs")),
        "channel_name": F.when(m == 8, F.lit("")).when(m == 9, F.lit(None)).otherwise(F.col("channel_name")),
        "data_quality_flag": F.when(m < 5, F.lit("excellent")).when(m < 14, F.lit("good")).when(m < 19, F.lit("fair"))
        .when(m < 22, F.lit("poor")).otherwise(F.lit("missing"))})


cte("defects", """SELECT channel, CASE WHEN m = 5 THEN NULL ELSE category END AS category, week,
 CASE WHEN m = 1 THEN NULL WHEN m = 2 THEN -views ELSE views END AS views,
 CASE WHEN m = 3 THEN NULL WHEN m = 4 THEN 0 ELSE subs END AS subs, videos, collection_source, delta_views,
 CASE WHEN m = 7 THEN subs * 2 ELSE delta_subs END AS delta_subs, delta_videos, activity, total_longform_views,
 CASE WHEN m = 6 THEN total_shorts_views * 3 ELSE total_shorts_views END AS total_shorts_views,
 CASE WHEN m = 8 THEN '' WHEN m = 9 THEN NULL ELSE channel_name END AS channel_name,
 CASE WHEN m < 5 THEN 'excellent' WHEN m < 14 THEN 'good' WHEN m < 19 THEN 'fair' WHEN m < 22 THEN 'poor' ELSE 'missing' END AS data_quality_flag
 FROM (SELECT *, (videos + day(week)) % 23 AS m FROM full_panel)""", "full_panel")


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """One row per line item: several per week and per source."""
    return as_observations(table(spark, sf, "lineitem"))


def as_observations(li: DataFrame, *more: str) -> DataFrame:
    flag = F.col("l_orderkey") % 5
    return li.select(
        *more,
        _channel(F.col("l_suppkey")).alias("channel"), F.col("l_shipdate").cast("date").alias("obs_date"),
        S.week_start_sunday("l_shipdate").alias("week"), (F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("views"),
        F.col("l_quantity").cast("bigint").alias("subs"),
        F.when(F.col("l_returnflag") == "A", F.lit("API")).when(F.col("l_returnflag") == "N", F.lit("VIEWSTATS"))
        .otherwise(F.lit("WAYBACK_CHARTS")).alias("collection_source"),
        F.when(flag == 0, F.lit("excellent")).when(flag == 1, F.lit("good")).when(flag == 2, F.lit("fair"))
        .when(flag == 3, F.lit("poor")).otherwise(F.lit("missing")).alias("data_quality_flag"))


cte("observations", """SELECT concat('S', lpad(CAST(l_suppkey AS VARCHAR), 6, '0')) AS channel, CAST(l_shipdate AS DATE) AS obs_date,
 CAST(l_shipdate AS DATE) - CAST(dayofweek(CAST(l_shipdate AS DATE)) AS INTEGER) AS week, l_orderkey * 1000 + l_linenumber AS views,
 CAST(l_quantity AS BIGINT) AS subs,
 CASE l_returnflag WHEN 'A' THEN 'API' WHEN 'N' THEN 'VIEWSTATS' ELSE 'WAYBACK_CHARTS' END AS collection_source,
 CASE l_orderkey % 5 WHEN 0 THEN 'excellent' WHEN 1 THEN 'good' WHEN 2 THEN 'fair' WHEN 3 THEN 'poor' ELSE 'missing' END AS data_quality_flag
 FROM lineitem""")


def latest(spark: SparkSession, sf: str) -> DataFrame:
    """Latest panel row of each entity."""
    return panel(spark, sf).groupBy("channel").agg(
        F.max(F.struct("week", "views", "subs", "videos")).alias("r")).select("channel", "r.*")


cte("latest", "SELECT * EXCLUDE (category, collection_source) FROM panel QUALIFY row_number() OVER (PARTITION BY channel ORDER BY week DESC) = 1", "panel")


def entities(spark: SparkSession, sf: str) -> DataFrame:
    return supplier_nation(spark, sf).select(
        "channel", "channel_name", "category", F.lit("unknown").alias("status"), F.concat(F.lit("@"), F.lower("channel_name")).alias("handle"),
        "k")


cte("entities", """SELECT concat('S', lpad(CAST(s_suppkey AS VARCHAR), 6, '0')) AS channel, s_name AS channel_name, n_name AS category,
 'unknown' AS status, concat('@', lower(s_name)) AS handle, s_suppkey AS k FROM supplier JOIN nation ON n_nationkey = s_nationkey""")


def api_items(spark: SparkSession, sf: str) -> DataFrame:
    """Flat returned items: a tenth of the entities is missing, every hundredth or so unknown."""
    e = entities(spark, sf).filter(F.col("k") % 10 != 3).join(latest(spark, sf), "channel", "left")
    privacy = F.when(F.col("k") % 11 == 0, F.lit("private")).when(F.col("k") % 13 == 0, F.lit("unlisted")).otherwise(F.lit("public"))
    known = e.select("channel", F.concat(F.lit("Api "), "channel_name").alias("channel_name"), F.lit("text").alias("description"),
                     F.lit("US").alias("country"), F.date_add(F.lit("2005-01-01").cast("date"), (F.col("k") % 1000).cast("int")).alias("created_date"),
                     "subs", "views", "videos", privacy.alias("privacy"), (F.col("k") % 17 == 5).alias("parse_failed"))
    stray = entities(spark, sf).filter(F.col("k") % 10 == 3).select(
        F.concat(F.lit("X"), F.substring("channel", 2, 20)).alias("channel"), F.lit("stray").alias("channel_name"),
        F.lit("").alias("description"), F.lit("").alias("country"), F.lit(None).cast("date").alias("created_date"),
        F.lit(0).cast("bigint").alias("subs"), F.lit(0).cast("bigint").alias("views"), F.lit(0).cast("bigint").alias("videos"),
        F.lit("public").alias("privacy"), F.lit(False).alias("parse_failed"))
    return known.unionByName(stray)


cte("api_items", """SELECT e.channel, concat('Api ', channel_name) AS channel_name, 'text' AS description, 'US' AS country,
 DATE '2005-01-01' + CAST(k % 1000 AS INTEGER) AS created_date, subs, views, videos,
 CASE WHEN k % 11 = 0 THEN 'private' WHEN k % 13 = 0 THEN 'unlisted' ELSE 'public' END AS privacy, k % 17 = 5 AS parse_failed
 FROM entities e LEFT JOIN latest l ON l.channel = e.channel WHERE k % 10 <> 3
 UNION ALL SELECT concat('X', substr(channel, 2)), 'stray', '', '', NULL, 0, 0, 0, 'public', false FROM entities WHERE k % 10 = 3""",
    "entities", "latest")


def done(spark: SparkSession, sf: str) -> DataFrame:
    return entities(spark, sf).filter(F.col("k") % 4 == 0).select("channel")


cte("done", "SELECT channel FROM entities WHERE k % 4 = 0", "entities")


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    from weekloom.operators.joins import enrich_entities
    return enrich_entities(entities(spark, sf), api_items(spark, sf))


cte("enriched", """SELECT e.channel, e.category, e.k,
 CASE WHEN i.channel IS NOT NULL AND NOT parse_failed THEN i.channel_name ELSE e.channel_name END AS channel_name,
 CASE WHEN i.channel IS NULL THEN 'terminated' WHEN parse_failed THEN e.status WHEN privacy = 'private' THEN 'private'
  WHEN privacy = 'unlisted' THEN 'inactive' ELSE 'active' END AS status,
 CASE WHEN NOT parse_failed THEN subs END AS current_subs, CASE WHEN NOT parse_failed THEN views END AS current_views,
 CASE WHEN NOT parse_failed THEN videos END AS current_videos, created_date, i.country,
 CASE WHEN i.channel IS NULL THEN 'not_found' WHEN parse_failed THEN 'failed' ELSE 'enriched' END AS processing_status,
 CASE WHEN i.channel IS NULL THEN 'youtube_api_not_found' WHEN parse_failed THEN 'youtube_api_processing_error' ELSE '' END AS flags
 FROM entities e LEFT JOIN api_items i ON i.channel = e.channel""", "entities", "api_items")


def snapshot_index(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select(_channel(F.col("o_custkey") % 100).alias("channel"),
                    F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyyMMddHHmmss").alias("timestamp"),
                    F.concat(F.lit("http://pages/"), F.col("o_custkey").cast("string")).alias("original"),
                    F.when(F.col("o_orderpriority") == "5-LOW", F.lit("404")).otherwise(F.lit("200")).alias("statuscode"),
                    F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("digest"))


cte("snapshot_index", """SELECT concat('S', lpad(CAST(o_custkey % 100 AS VARCHAR), 6, '0')) AS channel,
 strftime(o_orderdate, '%Y%m%d%H%M%S') AS timestamp, concat('http://pages/', o_custkey) AS original,
 CASE WHEN o_orderpriority = '5-LOW' THEN '404' ELSE '200' END AS statuscode, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS digest
 FROM orders""")


def spine_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Every entity and Sunday, metrics null where the panel has no row."""
    from weekloom.operators.joins import dense_spine
    spine = dense_spine(entities(spark, sf), *SPINE)
    return (spine.join(panel(spark, sf).select("channel", "week", "views", "subs", "videos"), ["channel", "week"], "left")
            .join(entities(spark, sf).select("channel", "category"), "channel"))


cte("weeks", f"SELECT CAST(unnest(generate_series(DATE '{SPINE[0]}', DATE '{SPINE[1]}', INTERVAL 7 DAY)) AS DATE) AS week")
cte("spine", "SELECT channel, category, week FROM entities CROSS JOIN weeks", "entities", "weeks")
cte("spine_panel", """SELECT s.channel, s.category, s.week, p.views, p.subs, p.videos FROM spine s
 LEFT JOIN panel p ON p.channel = s.channel AND p.week = s.week""", "spine", "panel")


def uploads(spark: SparkSession, sf: str) -> DataFrame:
    """One upload count per entity and order day: a growing count seen on some days only."""
    o = table(spark, sf, "orders")
    day = F.col("o_orderdate").cast("date")
    seen = o.groupBy(
        _channel(F.col("o_custkey") % 100).alias("channel"), day.alias("obs_date")).agg(F.max(F.col("o_orderkey") % 50).alias("m"))
    return seen.select("channel", "obs_date", (F.col("m") + F.datediff("obs_date", F.lit("1990-01-01").cast("date"))).alias("upload_count"))


cte("uploads", """SELECT concat('S', lpad(CAST(o_custkey % 100 AS VARCHAR), 6, '0')) AS channel, CAST(o_orderdate AS DATE) AS obs_date,
 max(o_orderkey % 50) + max(CAST(o_orderdate AS DATE) - DATE '1990-01-01') AS upload_count FROM orders GROUP BY 1, 2""")


def collector_events(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select(F.col("event_type").alias("collector"), F.col("user_id").alias("entity"), "ts",
                    (F.col("event_type") != "error").alias("success"), F.col("value").alias("wait"),
                    (F.col("event_id") % 7).alias("data_points"), (F.col("event_id") % 3).alias("weeks"))


cte("collector_events", """SELECT event_type AS collector, user_id AS entity, ts, event_type <> 'error' AS success, value AS wait,
 event_id % 7 AS data_points, event_id % 3 AS weeks FROM events""")
