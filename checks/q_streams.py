"""Section J: each stream runs to completion over the tables and must equal the batch SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from checks import fixtures as X
from checks.q_windows import _P
from checks.registry import cte, joined, query, r6
from checks.scratch import scratch
from weekloom.operators.ranking import pick_best
from weekloom.streaming import observations as SO
from weekloom.streaming.backfill import merge_observations, read_merged, run_backfill
from weekloom.session import cut_lineage
from weekloom.streaming.stateful import delta_state, latest_revision, stream_deltas


def _once(arrivals=()):
    return arrivals or [lambda: None]


def _append(df, name, arrivals=(), path=None):
    """Run an append stream into a parquet sink, once after each arrival, and read the result.

    Every run goes on from the checkpoint of the one before, so state and watermark are handed over.
    """
    spark = df.sparkSession
    path = path or scratch(spark, name)
    for arrive in _once(arrivals):
        arrive()
        q = (df.writeStream.format("parquet").option("checkpointLocation", f"{path}-ckpt").outputMode("append")
             .trigger(availableNow=True).start(path))
        q.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def _update(df, name, keys, arrivals=()):
    """Run an update stream; each batch lands in its own folder and the newest row per key counts."""
    spark = df.sparkSession
    path = scratch(spark, name)
    for arrive in _once(arrivals):
        arrive()
        q = (df.writeStream.foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{path}/batch={i}"))
             .option("checkpointLocation", f"{path}-ckpt").outputMode("update").trigger(availableNow=True).start())
        q.awaitTermination()
    return pick_best(spark.read.parquet(path), keys, [F.col("batch")]).drop("batch")


#: Days (no Sundays) at which the next arrival begins, so weeks are cut.
CUTS = [date(1997, 1, 8), date(1998, 7, 9), date(2000, 1, 7)]
_ARRIVAL = " + ".join(f"CAST(obs_date >= DATE '{c}' AS INTEGER)" for c in CUTS)
#: Rows of the ten days before a cut that come an arrival later.
_SLOW = "CAST((" + " OR ".join(f"obs_date BETWEEN DATE '{c}' - 10 AND DATE '{c}' - 1" for c in CUTS) + ") AND views // 1000 % 3 = 1 AS INTEGER)"
cte("slow_rows", f"SELECT *, {_ARRIVAL} AS cut, {_SLOW} AS slow FROM observations", "observations")
# newest: the latest day seen before a slow row arrives; the watermark lies three days before it
cte("coming", """SELECT o.*, o.cut + slow AS arrival, newest FROM slow_rows o LEFT JOIN (SELECT c.cut, max(obs_date) AS newest FROM slow_rows s JOIN (SELECT DISTINCT cut FROM slow_rows) c ON s.cut + s.slow <= c.cut GROUP BY 1) n
 ON n.cut = o.cut AND o.slow = 1""", "slow_rows")


def _stream(spark, sf, name):
    """The stream of ``lineitem`` and its four arrivals; some rows come an arrival late."""
    path = scratch(spark, f"{name}-in")
    rows = spark.read.parquet(f"{sf}/lineitem.parquet")
    seen = X.as_observations(rows, *rows.columns)
    arrival = F.expr(f"{_ARRIVAL} + {_SLOW}".replace("//", "div"))
    rows = cut_lineage(seen.withColumn("arrival", arrival).select(*rows.columns, "arrival"))

    def arrive(i):
        return lambda: rows.filter(F.col("arrival") == i).write.mode("append").parquet(path)
    arrive(0)()
    stream = X.as_observations(SO.stream_observations(spark, path, rows.schema, "l_shipdate"), "event_time", "arrival")
    return stream, [lambda: None, *(arrive(i) for i in range(1, 4))]


@query("j1_stream_observations", "SELECT * EXCLUDE (cut, slow, newest) FROM coming", "coming")
def _(spark, sf):
    stream, arrivals = _stream(spark, sf, "j1")
    return _append(stream.drop("event_time"), "j1", arrivals)


@query("j2_stream_dedup", """SELECT channel, week, collection_source, min(arrival) AS arrival FROM coming WHERE slow = 0 OR obs_date > newest - 3 GROUP BY ALL""", "coming")
def _(spark, sf):
    # which of several equal keys of an arrival is kept is open, but it is a whole row of the first arrival
    stream, arrivals = _stream(spark, sf, "j2")
    kept = _append(SO.stream_dedup(stream).drop("event_time"), "j2", arrivals)
    given = X.observations(spark, sf)
    return kept.join(given.distinct(), given.columns, "left_semi").select("channel", "week", "collection_source", "arrival")


@query("j3_stream_weekly", """WITH o AS (SELECT * FROM coming WHERE slow = 0 OR week + 7 > newest - 3)
SELECT channel, week, count(*) OVER (PARTITION BY channel, week) AS points, views, subs FROM o
 QUALIFY row_number() OVER (PARTITION BY channel, week ORDER BY obs_date DESC, views DESC, subs DESC) = 1""", "coming")
def _(spark, sf):
    stream, arrivals = _stream(spark, sf, "j3")
    return _update(SO.stream_weekly(stream), "j3", ["channel", "week"], arrivals)


#: Panel rows of the four weeks before a cut may come an arrival later.
_DELAYED = "(" + " OR ".join(f"week BETWEEN DATE '{c}' - 28 AND DATE '{c}'" for c in CUTS) + ") AND subs % 4 = 1"
cte("arriving", f"""SELECT *, {' + '.join(f"CAST(week >= DATE '{c}' AS INTEGER)" for c in CUTS)} AS cut, {_DELAYED} AS delayed FROM full_panel""", "full_panel")
cte("arrived", """SELECT *, cut + CAST(delayed AS INTEGER) AS arrival FROM arriving""", "arriving")
# late: after its arrival's turn, a later week of the entity was out
cte("late_rows", """SELECT d.channel, d.week FROM arrived d JOIN arrived x ON x.channel = d.channel AND x.week > d.week AND x.arrival <= d.cut
 JOIN (SELECT a.cut, max(week) AS newest FROM arrived JOIN (SELECT DISTINCT cut FROM arrived) a ON arrival <= a.cut GROUP BY 1) n ON n.cut = d.cut AND x.week < n.newest - 3
 WHERE d.delayed GROUP BY ALL""", "arrived")


def _panel_stream(spark, sf, name):
    """The stream of panel rows and its five arrivals; the last one moves the time past all weeks."""
    path = scratch(spark, f"{name}-in")
    rows = X.panel(spark, sf).select("channel", "week", "views", "subs")
    cut = sum((F.col("week") >= F.lit(c)).cast("int") for c in CUTS)
    delayed = F.expr(_DELAYED)
    rows = cut_lineage(rows.withColumn("arrival", cut + delayed.cast("int")))
    closing = spark.range(1).select(F.lit("END").alias("channel"), F.lit(date(2100, 1, 3)).alias("week"), F.lit(0).cast("bigint").alias("views"), F.lit(0).cast("bigint").alias("subs"))

    def arrival(i):
        return lambda: (rows.filter(F.col("arrival") == i).drop("arrival") if i < 4 else closing).write.mode("append").parquet(path)
    arrival(0)()
    stream = SO.stream_observations(spark, path, closing.schema, "week", "60 days")
    return stream, [lambda: None, *(arrival(i) for i in range(1, 5))]


@query("j4_stream_deltas", f"""SELECT channel, week, views, subs, delta_views, delta_subs, CAST(g AS INTEGER) AS gap_days, COALESCE(g < 4 OR g > 10, false) AS off_rhythm,
 COALESCE(delta_subs / (ps + 1) > 0.2, false) AS sub_growth_hit, COALESCE(delta_views / (pv + 1) > 0.5, false) AS view_growth_hit, l.channel IS NOT NULL AS late
 FROM (SELECT *, week - lag(week) OVER ({_P}) AS g, lag(subs) OVER ({_P}) AS ps, lag(views) OVER ({_P}) AS pv FROM full_panel) LEFT JOIN late_rows l USING (channel, week)""", "full_panel", "late_rows")
def _(spark, sf):
    stream, arrivals = _panel_stream(spark, sf, "j4")
    return latest_revision(_append(stream_deltas(stream), "j4", arrivals)).drop("revision")


@query("j4_stream_state", "SELECT channel, week, views, subs, true AS released FROM latest UNION ALL SELECT 'END', DATE '2100-01-03', 0, 0, false", "latest")
def _(spark, sf):
    # once the time is past all weeks, an entity's history is its latest week
    stream, arrivals = _panel_stream(spark, sf, "j4-state")
    path = scratch(spark, "j4-state")
    _append(stream_deltas(stream), "j4-state", arrivals, path)
    return delta_state(spark, f"{path}-ckpt").drop("revision")


@query("j5_stream_rules", f"""SELECT channel, week, concat_ws('; ', CASE WHEN views < 0 THEN 'Negative view count' END, CASE WHEN subs < 0 THEN 'Negative subscriber count' END,
 CASE WHEN videos < 0 THEN 'Negative video count' END, CASE WHEN total_longform_views + total_shorts_views > 0 AND views > 0 AND total_longform_views + total_shorts_views > CAST(views AS DOUBLE) * 1.1
 THEN 'Longform + shorts views exceed total views' END, CASE WHEN abs(delta_views) > views THEN 'Delta views exceeds total views' END, CASE WHEN abs(delta_subs) > subs THEN 'Delta subs exceeds total subs' END) AS issues,
 abs(week - DATE '{X.J1}') <= 14 AS near_junction, CASE WHEN total_longform_views > 0 AND total_shorts_views > 0 AND views > 0 AND abs(total_longform_views + total_shorts_views - views) > views * 0.5
 THEN 'breakdown_mismatch' ELSE 'ok' END AS breakdown_status, COALESCE(CASE WHEN subs > 0 THEN NOT (views / subs BETWEEN 10 AND 10000) END, false) AS ratio_out_of_range FROM defects""", "defects")
def _(spark, sf):
    path = scratch(spark, "j5-in")
    X.defects(spark, sf).write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    out = SO.stream_rules(stream, [X.J1]).select("channel", "week", joined("issues").alias("issues"), "near_junction", "breakdown_status", "ratio_out_of_range")
    return _append(out, "j5")


@query("j6_stream_error_rate", """SELECT CAST(w AS TIMESTAMP) AS window_start, count(*) AS events, round(CAST(count_if(NOT success) / count(*) AS DOUBLE), 6) AS error_rate, count_if(NOT success) / count(*) > 0.3 AS alert
 FROM (SELECT success, date_trunc('minute', ts) - INTERVAL 1 MINUTE * unnest(generate_series(0, 9)) AS w FROM collector_events) GROUP BY w""", "collector_events")
def _(spark, sf):
    ev = spark.readStream.schema(spark.read.parquet(f"{sf}/events.parquet").schema).parquet(f"{sf}/events.parquet*")
    ev = ev.select("ts", (F.col("event_type") != "error").alias("success"))
    out = _update(SO.stream_error_rate(ev), "j6", ["window_start"])
    return r6(out, "error_rate").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("j7_stream_late", """WITH o AS (SELECT channel, obs_date, views, collection_source, obs_date <= DATE '2000-01-01' AND views // 1000 % 10 <> 0 AS first FROM observations)
SELECT channel, obs_date, views, collection_source, NOT first AND obs_date < (SELECT max(obs_date) FROM o WHERE first) - 3 AS late FROM o""", "observations")
def _(spark, sf):
    base = scratch(spark, "j7")
    rows = X.observations(spark, sf).select("channel", "obs_date", "views", "collection_source")
    first = (F.col("obs_date") <= F.lit(date(2000, 1, 1))) & (F.expr("views div 1000") % 10 != 0)
    # two arrivals: the second brings rows older than the newest of the first
    rows.filter(first).write.parquet(f"{base}/in")
    schema = rows.schema
    stream = spark.readStream.schema(schema).parquet(f"{base}/in")
    SO.stream_late(stream, f"{base}/good", f"{base}/late", f"{base}/ckpt").awaitTermination()
    rows.filter(~first).write.mode("append").parquet(f"{base}/in")
    SO.stream_late(stream, f"{base}/good", f"{base}/late", f"{base}/ckpt").awaitTermination()
    good = spark.read.schema(schema).parquet(f"{base}/good/data").withColumn("late", F.lit(False))
    return good.unionByName(spark.read.schema(schema).parquet(f"{base}/late").withColumn("late", F.lit(True))).drop("batch")


@query("j7_backfill", """WITH w AS (SELECT channel, week, obs_date, views, subs FROM observations QUALIFY row_number() OVER (PARTITION BY channel, week ORDER BY obs_date DESC, views DESC, subs DESC) = 1)
SELECT *, COALESCE(views - lag(views) OVER p, 0) AS delta_views, COALESCE(subs - lag(subs) OVER p, 0) AS delta_subs FROM w WINDOW p AS (PARTITION BY channel ORDER BY week)""", "observations")
def _(spark, sf):
    base = scratch(spark, "backfill")
    stream, arrivals = _stream(spark, sf, "backfill")
    kinds = "channel string, obs_date date, views bigint, subs bigint"
    # the on-time rows make the panel, the late ones are merged into it after each arrival
    for i, arrive in enumerate(arrivals):
        arrive()
        SO.stream_late(stream.select("channel", "obs_date", "views", "subs"), f"{base}/good", f"{base}/late", f"{base}/ckpt").awaitTermination()
        good = spark.read.schema(f"{kinds}, batch bigint").parquet(f"{base}/good/data")
        last = good.agg(F.max("batch")).first()[0]
        panel = merge_observations(spark, f"{base}/panel", good.filter(F.col("batch") == last), buckets=8)
        run_backfill(spark, f"{base}/panel", f"{base}/late", kinds)
    return read_merged(spark, f"{base}/panel", panel).drop("bucket", "year")


@query("j8_stream_freshness", """SELECT source, last_event, rows, (DATE '2001-11-06' - last_event) * 24.0::DOUBLE AS age_hours,
 CASE WHEN source = 'WAYBACK_CHARTS' THEN 'historical' WHEN (DATE '2001-11-06' - last_event) * 24 <= CASE source WHEN 'API' THEN 24 ELSE 72 END THEN 'fresh' WHEN (DATE '2001-11-06' - last_event) * 24 > 48 THEN 'poor' ELSE 'stale' END AS status
 FROM (SELECT collection_source AS source, max(obs_date) AS last_event, count(*) AS rows FROM observations GROUP BY 1)""", "observations")
def _(spark, sf):
    stream, arrivals = _stream(spark, sf, "j8")
    return _update(SO.stream_freshness(stream, date(2001, 11, 6)), "j8", ["source"], arrivals)
