"""Writers: panels, summaries, entity records, flat reports."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.operators.aggregates import dataset_summary
from weekloom.schema import ENTITY_FIELDS, nested, value_or
from weekloom.sources.json_records import merged_json


def write_panel(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = "year", key: str = "channel",
                t: str = "datetime", compression: str | None = None, mode: str = "errorifexists") -> None:
    """Write a panel: Parquet partitioned by year for analytics, globally sorted TSV, or JSON.

    Parquet rows are first put in ranges of (year, entity), so a task writes one file, or two where
    a year ends; sorting inside the files gives tight row-group statistics.
    """
    if fmt == "parquet":
        out = df
        if partition_by == "year" and "year" not in df.columns:
            out = df.withColumn("year", F.year(t))
        if partition_by:
            out = out.repartitionByRange(partition_by, key, t).sortWithinPartitions(partition_by, key, t)
        else:
            out = out.sortWithinPartitions(key, t)
        writer = out.write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.option("compression", compression or "zstd").parquet(path)
    elif fmt == "tsv":
        text = df
        if dict(df.dtypes).get(t) in ("timestamp", "date", "timestamp_ntz"):
            text = df.orderBy(key, t).withColumn(t, F.date_format(F.col(t).cast("timestamp"), "yyyy-MM-dd HH:mm:ss"))
        else:
            text = df.orderBy(key, t)
        writer = text.write.mode(mode).option("sep", "\t").option("header", True)
        (writer.option("compression", compression) if compression else writer).csv(path)
    elif fmt == "json":
        writer = df.write.mode(mode)
        (writer.option("compression", compression) if compression else writer).json(path)
    else:
        raise ValueError("fmt must be parquet, tsv or json")


def read_written(panel: DataFrame, path: str, fmt: str = "parquet", t: str = "datetime") -> DataFrame:
    """What ``write_panel`` wrote of ``panel``, with the panel's types."""
    spark = panel.sparkSession
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "json":
        return spark.read.schema(panel.schema).json(path)
    kinds = dict(panel.dtypes)
    texts = ", ".join(f"`{c}` {'string' if c == t else kinds[c]}" for c in panel.columns)
    return spark.read.schema(texts).option("sep", "\t").option("header", True).csv(path).withColumn(t, F.col(t).cast(kinds[t]))


def write_summary(df: DataFrame, path: str, t: str = "datetime", mode: str = "errorifexists") -> None:
    """The one-row dataset summary as a JSON object."""
    dataset_summary(df, t=t).coalesce(1).write.mode(mode).json(path)


def entity_records(entities: DataFrame, coverage: DataFrame | None = None, key: str = "channel", phase: str = "") -> DataFrame:
    """Nested entity records from a flat frame (C1, B13) and the coverage of their series (D4).

    Fields without a column are taken from ``record`` (VARIANT) if there, else get their default; ``record`` is carried along
    for its other fields.
    """
    rows = entities if coverage is None else entities.join(coverage, key, "left")
    has = set(rows.columns)
    # where the fields of the record come from
    sources = {
        "channel_id": key, "channel_handle": "handle", "current_metrics.subscriber_count": "current_subs", "current_metrics.total_view_count": "current_views",
        "current_metrics.video_count": "current_videos", "current_metrics.total_longform_views": "longform_views", "current_metrics.total_shorts_views": "shorts_views",
        "current_metrics.average_views_per_video": "avg_views_per_video", "current_metrics.subscriber_to_view_ratio": "subscriber_to_view_ratio",
        "history.first_data_point": "first_date", "history.last_data_point": "last_date", "history.total_data_points": "points",
        "history.data_coverage_percentage": "coverage", "history.collection_sources_used": "sources", "history.quality_score": "mean_grade",
        "validation_flags": "flags", "current_metrics.last_updated": "metrics_updated"}
    fields = {}
    for name, (kind, default) in ENTITY_FIELDS.items():
        column = next((c for c in (sources.get(name), name) if c in has), None)
        stated = F.try_variant_get("record", f"$.{name}", kind) if "record" in has else F.lit(None).cast(kind)
        value = stated if column is None else F.coalesce(F.col(column).cast(kind), stated)
        fields[name] = value if default is None else F.coalesce(value, value_or(kind, default))
    if "flags" in has and dict(rows.dtypes)["flags"] == "string":
        raise ValueError("flags must be an array")
    if phase:
        fields["processing_notes"] = F.lit(phase)
    return rows.select(*nested(fields), *(["record"] if "record" in has else []))


def _as_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of one JSON array: its records, a comma after each but the last."""
    def rows(lines: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
    held: list[str] = []
    yield rows(["["])
    for batch in batches:
        held += batch.column(0).to_pylist()
        if len(held) > 1:
            yield rows([line + "," for line in held[:-1]])
            held = held[-1:]
    yield rows([*held, "]"])


def write_entities(entities: DataFrame, path: str, phase: str, mode: str = "errorifexists", fmt: str = "lines") -> None:
    """Entity records as JSON, one file set per phase: a record per ``lines`` or an ``array`` per file.

    All columns are written, null ones too. A column ``record`` (VARIANT, as ``read_entities`` gives it) is not a field
    itself: its fields that are no columns are written as they were, so nothing of a record that was read is lost.
    """
    if fmt not in ("lines", "array"):
        raise ValueError("fmt must be lines or array")
    fields = [f for f in entities.schema.fields if f.name != "record"]
    if "record" in entities.columns:
        # nested records keep their other fields too
        parts = [F.parse_json(merged_json(F.try_variant_get("record", f"$['{f.name}']", "variant"), F.col(f"`{f.name}`"))).alias(f.name)
                 if f.dataType.typeName() == "struct" else F.col(f"`{f.name}`") for f in fields]
        text = merged_json(F.col("record"), F.struct(*parts))
    else:
        text = F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in fields]), {"ignoreNullFields": "false"})
    lines = entities.select(text.alias("value"))
    if fmt == "array":
        lines = lines.mapInArrow(_as_array, "value string")
    lines.write.mode(mode).text(f"{path.rstrip('/')}/{phase}")


def flatten_report(report: DataFrame) -> DataFrame:
    """Nested report rows to (Category, Metric, Value); top-level scalars are ``General``.

    All fields go through one explode, so the report is computed once.
    """
    def text(c, kind: str):
        return F.to_json(c) if kind in ("struct", "array", "map") else c.cast("string")

    def row(category: str, metric, value):
        return F.struct(F.lit(category).alias("Category"), metric.alias("Metric"), value.alias("Value"))

    def entries(name: str, c, kind: str):
        return F.transform(F.map_entries(c), lambda e: row(name, e["key"].cast("string"), text(e["value"], kind)))

    parts = []
    for f in report.schema.fields:
        c, kind = F.col(f.name), f.dataType.typeName()
        if kind == "struct":
            parts.append(F.array(*[row(f.name, F.lit(s.name), text(c[s.name], s.dataType.typeName())) for s in f.dataType.fields]))
        elif kind == "map":
            parts.append(entries(f.name, c, f.dataType.valueType.typeName()))
        else:
            parts.append(F.array(row("General", F.lit(f.name), text(c, kind))))
    return report.select(F.explode(F.concat(*parts)).alias("r")).select("r.*")
