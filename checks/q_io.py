"""Section A: write the panel and lists in each format and read them back."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from checks import fixtures as X
from checks.q_reports import QRANK
from checks.registry import joined, query, r6
from checks.scratch import scratch
from weekloom import sources as IO
from weekloom.functions import scalars as S
from weekloom.operators.aggregates import entity_coverage
from weekloom.operators.projections import project_api_item
from weekloom.sources import entity_records

_PANEL = """SELECT channel, week, views, delta_views, subs, collection_source, data_quality_flag FROM full_panel"""


def _dated(spark, sf):
    return X.full_panel(spark, sf).withColumn("datetime", F.col("week").cast("timestamp")).drop("week")


def _back(df):
    return df.select("channel", F.col("datetime").cast("date").alias("week"), "views", "delta_views", "subs", "collection_source", "data_quality_flag")


@query("a1_read_panel_tsv", """SELECT channel, CASE WHEN subs % 13 = 2 THEN NULL ELSE week END AS week, CASE WHEN subs % 7 = 3 THEN 0 ELSE views END AS views, delta_views, subs,
 'API' AS collection_source, 'good' AS data_quality_flag FROM full_panel""", "full_panel")
def _(spark, sf):
    path = scratch(spark, "tsv")
    bad = X.full_panel(spark, sf).select(
        "channel", "category", F.when(F.col("subs") % 13 == 2, F.lit("soon")).otherwise(F.col("week").cast("string")).alias("datetime"),
        F.when(F.col("subs") % 7 == 3, F.lit("n/a")).otherwise(F.col("views").cast("string")).alias("views"), "delta_views", "subs", "delta_subs",
        "videos", "delta_videos", "activity")
    IO.write_panel(bad, path, "tsv", partition_by=None)
    return _back(IO.read_panel(spark, path))


@query("a1_read_panel_parquet_range", _PANEL + " WHERE week BETWEEN DATE '1997-09-07' AND DATE '1999-08-01'", "full_panel")
def _(spark, sf):
    path = scratch(spark, "parquet")
    IO.write_panel(_dated(spark, sf), path)
    return _back(IO.read_panel(spark, path, "parquet", X.J1, X.J2))


@query("a2_read_entities_csv", "SELECT channel AS channel_id, channel_name, 'unknown' AS status FROM entities WHERE k % 5 <> 2", "entities")
def _(spark, sf):
    path = scratch(spark, "csv")
    e = X.entities(spark, sf).select(F.when(F.col("k") % 5 == 2, F.lit(" ")).otherwise(F.col("channel")).alias("id"), "channel_name")
    e.write.option("header", True).csv(path)
    return IO.read_entities(spark, path)


@query("a2_read_entities_txt", "SELECT channel AS channel_id, '' AS channel_name, 'unknown' AS status FROM entities", "entities")
def _(spark, sf):
    path = scratch(spark, "txt")
    X.entities(spark, sf).select("channel").write.text(path)
    return IO.read_entities(spark, path, "txt")


_COVER = f"""SELECT channel, CAST(min(week) AS VARCHAR) AS first_data_point, CAST(max(week) AS VARCHAR) AS last_data_point, count(*) AS total_data_points, round(least(count(*) / 300.0, 1.0)::DOUBLE, 6) AS data_coverage_percentage,
 string_agg(DISTINCT collection_source, '; ' ORDER BY collection_source) AS collection_sources_used, round(avg({QRANK}), 6) AS quality_score FROM defects GROUP BY channel"""
_RECORD = f"""SELECT e.channel AS channel_id, CASE WHEN COALESCE(channel_name, '') = '' THEN concat('Channel_', substr(e.channel, 1, 8)) ELSE channel_name END AS channel_name, concat('@', lower(s_name)) AS channel_handle, e.category, COALESCE(country, '') AS country,
 '' AS language, status, CAST(created_date AS VARCHAR) AS created_date, COALESCE(current_subs, 0) AS subscriber_count, COALESCE(current_views, 0) AS total_view_count, COALESCE(current_videos, 0) AS video_count, first_data_point, last_data_point, COALESCE(total_data_points, 0) AS total_data_points,
 COALESCE(data_coverage_percentage, 0) AS data_coverage_percentage, COALESCE(collection_sources_used, '') AS collection_sources_used, COALESCE(quality_score, 0) AS quality_score, flags AS validation_flags, processing_status,
 CAST(e.k % 3 AS BIGINT) AS rank_in_list, concat('n"[', e.k, ']}}') AS note, CAST(e.k AS BIGINT) AS seen FROM enriched e JOIN supplier ON s_suppkey = e.k LEFT JOIN ({_COVER}) c ON c.channel = e.channel"""


def _records(spark, sf):
    """Nested records with three fields that no schema names, one of them inside a nested record."""
    e = X.enriched(spark, sf)
    handles = X.entities(spark, sf).select("channel", F.col("handle").alias("h"))
    e = (e.drop("handle").join(handles, "channel").withColumnRenamed("h", "handle"))
    cover = entity_coverage(X.defects(spark, sf), 300)
    other = F.to_json(F.struct((F.col("k") % 3).alias("rank_in_list"), F.struct(F.concat(F.lit('n"['), "k", F.lit("]}")).alias("note")).alias("collection_metadata"),
                               F.struct(F.col("k").alias("seen")).alias("history")))
    return entity_records(e.withColumn("record", F.parse_json(other)), cover)


def _flat_records(back):
    m, h = F.col("current_metrics"), F.col("history")
    return r6(back.select(
        "channel_id", "channel_name", "channel_handle", "category", "country", "language", "status", "created_date", *[m[c].alias(c) for c in ("subscriber_count", "total_view_count", "video_count")],
        *[h[c].alias(c) for c in ("first_data_point", "last_data_point", "total_data_points", "data_coverage_percentage", "quality_score")], joined(h["collection_sources_used"]).alias("collection_sources_used"),
        joined("validation_flags").alias("validation_flags"), "processing_status", F.variant_get("record", "$.rank_in_list", "bigint").alias("rank_in_list"),
        F.variant_get("record", "$.collection_metadata.note", "string").alias("note"), F.variant_get("record", "$.history.seen", "bigint").alias("seen")), "data_coverage_percentage", "quality_score")


@query("a2_read_entities_json", _RECORD, "enriched", "defects")
def _(spark, sf):
    path = scratch(spark, "entities")
    # id instead of channel_id on every other record
    rows = _records(spark, sf)
    k = F.substring("channel_id", 2, 20).cast("bigint")
    IO.write_entities(rows.withColumns({"id": F.col("channel_id"), "channel_id": F.when(k % 2 == 0, F.col("channel_id"))}), path, "phase1", fmt="array")
    return _flat_records(IO.read_entities(spark, f"{path}/phase1", "json"))


@query("a8_write_entities", _RECORD, "enriched", "defects")
def _(spark, sf):
    path = scratch(spark, "entities")
    IO.write_entities(_records(spark, sf), path, "phase1")
    # read, written and read again: nothing of a record is lost on the way
    IO.write_entities(IO.read_entities(spark, f"{path}/phase1", "json"), path, "phase2")
    return _flat_records(IO.read_entities(spark, f"{path}/phase2", "json"))


def _payloads(spark, sf, path, form):
    """List responses of five items, every seventh an error payload, with fields that no schema names."""
    item = F.struct(F.col("channel").alias("id"), F.struct(F.col("channel_name").alias("title"), F.col("country").alias("country")).alias("snippet"),
                    F.struct(F.col("views").cast("string").alias("viewCount"), F.col("subs").cast("string").alias("subscriberCount")).alias("statistics"),
                    F.struct(F.col("privacy").alias("privacyStatus")).alias("status"), F.struct((F.col("subs") % 5).alias("madeFor")).alias("audience"))
    k = F.substring("channel", 2, 20).cast("bigint")
    pages = X.api_items(spark, sf).filter(F.col("channel").startswith("S")).groupBy(F.floor(k / 5).alias("b")).agg(F.collect_list(item).alias("items"))
    bad = F.col("b") % 7 == 3
    error = F.struct(F.lit(403).alias("code"), F.concat(F.lit("quota }{ "), "b").alias("message"), F.array(F.struct(F.lit("quotaExceeded").alias("reason"))).alias("errors"), F.col("b").alias("batch"))
    rows = pages.select(F.when(~bad, F.col("items")).alias("items"), F.when(bad, error).alias("error"))
    IO.write_entities(rows, path, "phase", fmt=form)
    return f"{path}/phase"


_BATCH = "CAST(substr(channel, 2) AS BIGINT) // 5"

for _form in ("lines", "array"):
    @query(f"a3_read_api_payloads_{_form}", f"""SELECT channel, channel_name, country, views, subs, privacy, CAST(subs % 5 AS BIGINT) AS made_for FROM api_items WHERE channel LIKE 'S%' AND {_BATCH} % 7 <> 3""", "api_items")
    def _(spark, sf, form=_form):
        found = IO.read_api_payloads(spark, _payloads(spark, sf, scratch(spark, "payloads"), form))
        more = found.select(F.col("item.id").alias("channel"), F.variant_get("record", "$.audience.madeFor", "bigint").alias("made_for"))
        return project_api_item(found).select("channel", "channel_name", "country", "views", "subs", "privacy").join(more, "channel")

    @query(f"a3_read_api_errors_{_form}", f"SELECT 403::INTEGER AS code, concat('quota }}{{ ', b) AS message, 'quotaExceeded' AS reason, b AS batch FROM (SELECT DISTINCT {_BATCH} AS b FROM api_items WHERE channel LIKE 'S%') WHERE b % 7 = 3", "api_items")
    def _(spark, sf, form=_form):
        found = IO.read_api_errors(spark, _payloads(spark, sf, scratch(spark, "payloads"), form))
        return found.select("code", "message", "reason", F.variant_get("record", "$.error.batch", "bigint").alias("batch"))


def _listed(batches):
    """Lines of one array of arrays, batch by batch: its header, the rows, its end; none without rows."""
    begun = False
    for batch in batches:
        lines = ["," + v for v in batch.column(0).to_pylist()]
        if lines:
            yield pa.RecordBatch.from_pydict({"value": lines if begun else ['[["digest", "timestamp", "original", "statuscode"]', *lines]})
            begun = True
    if begun:
        yield pa.RecordBatch.from_pydict({"value": ["]"]})


@query("a4_read_snapshot_index_json", "SELECT timestamp, original, statuscode, digest FROM snapshot_index", "snapshot_index")
def _(spark, sf):
    path = scratch(spark, "index")
    # one array of arrays for each of a few files, its header first
    rows = X.snapshot_index(spark, sf).select(F.to_json(F.array("digest", "timestamp", "original", "statuscode")).alias("value")).repartition(3)

    rows.mapInArrow(_listed, "value string").write.text(path)
    return IO.read_snapshot_index(spark, path)


@query("a4_read_snapshot_index_jsonl", "SELECT timestamp, original, statuscode, digest FROM snapshot_index", "snapshot_index")
def _(spark, sf):
    path = scratch(spark, "index")
    idx = X.snapshot_index(spark, sf)
    # index documents of at most a thousand rows (digests count up): a header row and its rows
    row = F.array("digest", "timestamp", "original", "statuscode")
    docs = idx.groupBy("channel", F.substring("digest", 1, 9)).agg(F.collect_list(row).alias("r"))
    head = F.array(F.array(F.lit("digest"), F.lit("timestamp"), F.lit("original"), F.lit("statuscode")))
    docs.select(F.to_json(F.concat(head, "r")).alias("value")).write.text(path)
    return IO.read_snapshot_index(spark, path, "jsonl")


@query("a4_read_snapshot_index_text", "SELECT timestamp, original, statuscode, digest FROM snapshot_index", "snapshot_index")
def _(spark, sf):
    path = scratch(spark, "index")
    X.snapshot_index(spark, sf).select(F.concat_ws(" ", F.lit("com,pages)/"), "timestamp", "original", F.lit("text/html"), "statuscode", "digest",
                                                   F.lit("-"), F.lit("100"))).write.text(path)
    return IO.read_snapshot_index(spark, path, "text")


@query("a5_read_page_snapshots", """SELECT concat('P', page_id) AS channel, url, html, CASE WHEN page_id % 4 <> 1 THEN TIMESTAMP '2019-09-01 12:00:00' END AS snapshot_at FROM pages""")
def _(spark, sf):
    path = scratch(spark, "pages")
    X.table(spark, sf, "pages").select(
        F.concat(F.lit("P"), F.col("page_id").cast("string")).alias("channel"), "url", "html",
        F.when(F.col("page_id") % 4 == 1, F.lit("20191301")).otherwise(F.lit("20190901120000")).alias("snapshot_ts")).write.parquet(path)
    return IO.read_page_snapshots(spark, path).select("channel", "url", "html", F.col("snapshot_at").cast("timestamp_ntz").alias("snapshot_at"))


@query("a6_write_panel_tsv", _PANEL, "full_panel")
def _(spark, sf):
    path = scratch(spark, "tsv")
    IO.write_panel(_dated(spark, sf), path, "tsv", compression="gzip")
    raw = spark.read.option("sep", "\t").option("header", True).csv(path)
    return _back(raw.withColumns({c: S.numeric_or_zero(c) for c in ("views", "delta_views", "subs")}))


@query("a6_write_panel_json", _PANEL, "full_panel")
def _(spark, sf):
    path = scratch(spark, "json")
    IO.write_panel(_dated(spark, sf), path, "json")
    return _back(IO.read_panel(spark, path, "json"))


@query("a7_write_summary", "SELECT count(*) AS total_records, count(DISTINCT channel) AS unique_channels, CAST(min(week) AS VARCHAR) AS start_date, CAST(max(week) AS VARCHAR) AS end_date FROM full_panel", "full_panel")
def _(spark, sf):
    path = scratch(spark, "summary")
    IO.write_summary(X.full_panel(spark, sf), path, "week")
    return spark.read.json(path).select("total_records", "unique_channels", "start_date", "end_date")
