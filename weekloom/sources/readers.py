"""Readers: panels, entity lists, API payloads, snapshot indexes, stored pages."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.functions import scalars as S
from weekloom.operators.projections import add_enhanced_columns
from weekloom.schema import API_ITEM_TYPE, BASE_COLUMNS, ENTITY_FIELDS, nested, value_or
from weekloom.sources.json_records import json_elements, read_json_records, records_of


class Source(Protocol):
    """A pluggable origin of observations: anything that can give a DataFrame in their schema."""

    name: str

    def read(self, spark: SparkSession) -> DataFrame: ...


#: Typed columns of a JSON panel; counts and the datetime are read as text and parsed as in TSV.
_PANEL_KINDS = {"total_longform_views": "bigint", "total_shorts_views": "bigint", "year": "int"}


def _fields_of_first(spark: SparkSession, path: str) -> list[str]:
    """Field names of the first JSON line; reads no more than that."""
    first = spark.read.text(path).filter(F.trim("value") != "").select(F.json_object_keys("value").alias("k")).limit(1).collect()
    return list(first[0].k or []) if first else []


def read_panel(spark: SparkSession, path: str, fmt: str = "tsv", start=None, end=None) -> DataFrame:
    """Read a base panel, type it and add the enhanced defaults.

    TSV and JSON are read as text: bad numbers become 0, bad datetimes null. JSON lines have the
    fields of the first record, so no scan is spent on a schema. Parquet may be partitioned by year;
    date bounds then also prune partitions.
    """
    if fmt == "tsv":
        raw = spark.read.option("sep", "\t").option("header", True).csv(path)
    elif fmt == "json":
        names = _fields_of_first(spark, path)
        raw = spark.read.schema(", ".join(f"`{n}` {_PANEL_KINDS.get(n, 'string')}" for n in names)).json(path) if names else spark.createDataFrame([], ", ".join(f"{c} string" for c in BASE_COLUMNS))
    elif fmt == "parquet":
        raw = spark.read.parquet(path)
    else:
        raise ValueError("fmt must be tsv, json or parquet")
    missing = [c for c in BASE_COLUMNS if c not in raw.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    for bound, op in ((start, "ge"), (end, "le")):
        if bound is not None:
            day = F.lit(bound).cast("date")
            if "year" in raw.columns:
                raw = raw.filter(F.col("year") >= F.year(day) if op == "ge" else F.col("year") <= F.year(day))
            if fmt == "parquet":
                raw = raw.filter(F.col("datetime") >= day if op == "ge" else F.col("datetime") < F.date_add(day, 1))
    if fmt != "parquet":
        counts = [c for c in BASE_COLUMNS if c.startswith("delta_") or c in ("views", "subs", "videos")]
        raw = raw.withColumns({c: S.numeric_or_zero(c) for c in counts})
        stamp = F.coalesce(F.col("datetime").try_cast("timestamp"), S.parse_flexible_date("datetime").cast("timestamp"))
        raw = raw.withColumn("datetime", stamp)
        if start is not None:
            raw = raw.filter(F.col("datetime") >= F.lit(start).cast("date"))
        if end is not None:
            raw = raw.filter(F.col("datetime") < F.date_add(F.lit(end).cast("date"), 1))
    if "data_quality_flag" in raw.columns:
        return raw
    return add_enhanced_columns(raw)


def read_entities(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Entity list from CSV, nested JSON records or one id per text line.

    ``json`` is an array or a record per file or a record per line, read in splits; it gives every field of the nested
    record, absent ones with their defaults, and in ``record`` (VARIANT) the record as it was, with all other fields.
    Items that are no objects, or have neither ``channel_id`` nor ``id``, drop out.
    """
    if fmt in ("json", "jsonl"):
        rows = read_json_records(spark, path).filter(F.schema_of_variant("record").startswith("OBJECT"))
        return typed_entities(rows).filter(F.coalesce(F.col("channel_id"), F.lit("")) != "")
    if fmt == "csv":
        raw = spark.read.option("header", True).csv(path)
        ids = [F.nullif(F.trim(F.col(c)), F.lit("")) for c in ("channel_id", "id") if c in raw.columns]
        names = [F.col(c) for c in ("channel_name", "name") if c in raw.columns]
        out = raw.select(F.coalesce(*ids).alias("channel_id"),
                         F.coalesce(*names, F.lit("")).alias("channel_name"), F.lit("unknown").alias("status"))
    elif fmt == "txt":
        out = spark.read.text(path).select(F.trim("value").alias("channel_id"), F.lit("").alias("channel_name"),
                                           F.lit("unknown").alias("status"))
    else:
        raise ValueError("fmt must be csv, json, jsonl or txt")
    return out.filter(F.coalesce(F.col("channel_id"), F.lit("")) != "")


def typed_entities(records: DataFrame, record: str = "record") -> DataFrame:
    """The nested entity record of each VARIANT in ``record``, which stays beside it."""
    fields = {}
    for name, (kind, default) in ENTITY_FIELDS.items():
        value = F.try_variant_get(record, f"$.{name}", kind)
        fields[name] = value if default is None else F.coalesce(value, value_or(kind, default))
    given = [F.nullif(F.trim(F.try_variant_get(record, f"$.{n}", "string")), F.lit("")) for n in ("channel_id", "id")]
    fields["channel_id"] = F.coalesce(*given)
    fields["channel_name"] = S.fallback_name(fields["channel_id"], fields["channel_name"])
    return records.select(*nested(fields), F.col(record).alias("record"))


def read_api_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per returned item: typed (``item``) and as it came (``record``, VARIANT); empty and error payloads give none.

    Payloads are objects per file or line, or arrays of them; files are read in splits.
    """
    items = F.try_variant_get("record", "$.items", "array<variant>")
    rows = read_json_records(spark, path).select(F.explode(items).alias("record"))
    return rows.select(F.from_json(F.to_json("record"), API_ITEM_TYPE).alias("item"), "record")


def read_api_errors(spark: SparkSession, path: str) -> DataFrame:
    """One row per error payload with its code and first reason, and the payload as it came."""
    def got(name: str, kind: str):
        return F.try_variant_get("record", f"$.error{name}", kind)
    rows = read_json_records(spark, path).filter(F.schema_of_variant(got("", "variant")).startswith("OBJECT"))
    return rows.select(got(".code", "int").alias("code"), got(".message", "string").alias("message"), got(".errors[0].reason", "string").alias("reason"), "record")


def read_snapshot_index(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Index rows (timestamp, original, statuscode, digest).

    ``json``: one array of arrays per file, first row the header, read in splits; ``jsonl``: one such array per
    line. ``text``: space separated urlkey, timestamp, original, mime, status, digest.
    """
    columns = ("timestamp", "original", "statuscode", "digest")
    if fmt == "json":
        rows = records_of(json_elements(spark, path, sep="]"))
        head = F.from_json("opening", "array<string>")
        rows = rows.select(F.try_variant_get("record", "$", "array<string>").alias("_v"), head.alias("_h")).filter(F.col("_v").isNotNull() & ~F.col("_v").eqNullSafe(F.col("_h")))
    elif fmt == "jsonl":
        rows = (spark.read.text(path).select(F.from_json("value", "array<array<string>>").alias("r"))
                .select(F.col("r")[0].alias("_h"), F.posexplode("r").alias("_i", "_v")).filter(F.col("_i") > 0))
    elif fmt == "text":
        parts = F.split(F.trim("value"), r"\s+")
        rows = spark.read.text(path).select(parts.alias("p")).filter(F.size("p") >= 6)
        return rows.select(F.col("p")[1].alias("timestamp"), F.col("p")[2].alias("original"), F.col("p")[4].alias("statuscode"),
                           F.col("p")[5].alias("digest"))
    else:
        raise ValueError("fmt must be json, jsonl or text")
    return rows.select(*[F.try_element_at("_v", F.nullif(F.array_position("_h", c), F.lit(0)).cast("int")).alias(c) for c in columns])


def read_page_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages (channel, snapshot_ts, url, html) with the parsed stamp in ``snapshot_at``."""
    pages = spark.read.parquet(path)
    missing = [c for c in ("channel", "snapshot_ts", "url", "html") if c not in pages.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return pages.withColumn("snapshot_at", S.parse_snapshot_ts("snapshot_ts"))
