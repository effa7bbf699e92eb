"""Schemas, enumerations and fixed ranks of the weekly panel."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: column names of the two panel layouts -------------------------------
BASE_COLUMNS = [
    "channel", "category", "datetime", "views", "delta_views", "subs", "delta_subs",
    "videos", "delta_videos", "activity",
]
ENHANCED_COLUMNS = BASE_COLUMNS + [
    "total_longform_views", "total_shorts_views", "channel_name", "collection_source",
    "data_quality_flag",
]

# --- fixed values: enumerations stored as text -------------------------------------------
QUALITY_FLAGS = ["excellent", "good", "fair", "poor", "missing"]
SOURCES = ["API", "WAYBACK_CHARTS", "WAYBACK_UPLOADS", "VIEWSTATS", "FINAL_API"]
ACTIVITIES = ["active", "inactive", "dormant", "unknown"]
ENTITY_STATUSES = ["active", "inactive", "terminated", "private", "unknown"]
SEVERITIES = ["critical", "high", "medium", "low"]

# --- fixed values: ranks --------------------------------------------------------------
QUALITY_RANK = {"excellent": 5, "good": 4, "fair": 3, "poor": 2, "missing": 1}
SOURCE_RANK = {"FINAL_API": 5, "API": 4, "VIEWSTATS": 3, "WAYBACK_UPLOADS": 2, "WAYBACK_CHARTS": 1}
SOURCE_WEIGHT = {"FINAL_API": 4.0, "API": 4.0, "VIEWSTATS": 3.0, "WAYBACK_UPLOADS": 2.0,
                 "WAYBACK_CHARTS": 2.0}
INTERPOLATED_WEIGHT = 1.0

METRICS = ["views", "subs", "videos"]

_string, _long, _date, _ts = T.StringType(), T.LongType(), T.DateType(), T.TimestampType()

OBSERVATION_SCHEMA = T.StructType([
    T.StructField("channel", _string),
    T.StructField("obs_date", _date),
    T.StructField("week", _date),
    T.StructField("views", _long),
    T.StructField("subs", _long),
    T.StructField("collection_source", _string),
    T.StructField("data_quality_flag", _string),
])

# --- fixed values: fields of a nested entity record, with the value of an absent one ----------------
ENTITY_FIELDS = {
    "channel_id": ("string", None), "channel_name": ("string", ""), "channel_handle": ("string", ""), "category": ("string", "Other"),
    "country": ("string", ""), "language": ("string", ""), "status": ("string", "unknown"), "created_date": ("string", None),
    "description": ("string", ""), "keywords": ("array<string>", []),
    "current_metrics.subscriber_count": ("bigint", 0), "current_metrics.total_view_count": ("bigint", 0), "current_metrics.video_count": ("bigint", 0),
    "current_metrics.total_longform_views": ("bigint", 0), "current_metrics.total_shorts_views": ("bigint", 0),
    "current_metrics.average_views_per_video": ("double", 0.0), "current_metrics.subscriber_to_view_ratio": ("double", 0.0),
    "current_metrics.last_updated": ("string", None),
    "history.first_data_point": ("string", None), "history.last_data_point": ("string", None), "history.total_data_points": ("bigint", 0),
    "history.data_coverage_percentage": ("double", 0.0), "history.junction_points_validated": ("array<string>", []),
    "history.collection_sources_used": ("array<string>", []), "history.quality_score": ("double", 0.0),
    "collection_metadata": ("variant", {}), "data_quality_score": ("double", 0.0), "validation_flags": ("array<string>", []),
    "last_validated": ("string", None), "processing_status": ("string", "pending"), "processing_notes": ("string", ""), "last_updated": ("string", None),
}

API_ITEM_TYPE = T.StructType([
    T.StructField("id", _string),
    T.StructField("snippet", T.StructType([
        T.StructField("title", _string),
        T.StructField("description", _string),
        T.StructField("customUrl", _string),
        T.StructField("publishedAt", _string),
        T.StructField("country", _string),
        T.StructField("defaultLanguage", _string),
        T.StructField("categoryId", _string),
        T.StructField("thumbnails", T.MapType(_string, T.StructType([T.StructField("url", _string)]))),
    ])),
    T.StructField("statistics", T.StructType([
        T.StructField("viewCount", _string),
        T.StructField("subscriberCount", _string),
        T.StructField("videoCount", _string),
        T.StructField("hiddenSubscriberCount", T.BooleanType()),
    ])),
    T.StructField("status", T.StructType([T.StructField("privacyStatus", _string)])),
    T.StructField("brandingSettings", T.StructType([
        T.StructField("channel", T.StructType([T.StructField("keywords", _string)])),
    ])),
])

def value_or(kind: str, default) -> Column:
    """The literal for an absent field of a record."""
    if kind == "variant":
        return F.parse_json(F.lit("{}"))
    return F.array().cast(kind) if kind.startswith("array") else F.lit(default).cast(kind)


def nested(fields: dict[str, Column]) -> list[Column]:
    """Columns of dotted names, one level deep, as columns and structs in their order."""
    groups: dict[str, list[Column]] = {}
    for name, value in fields.items():
        head, _, tail = name.partition(".")
        groups.setdefault(head, []).append(value.alias(tail) if tail else value.alias(head))
    return [F.struct(*cols).alias(head) if any(n.startswith(head + ".") for n in fields) else cols[0] for head, cols in groups.items()]


def rank_of(col: Column | str, ranks: dict[str, float], default: float = 0) -> Column:
    """Map a text column to its fixed rank with one CASE expression."""
    col = F.col(col) if isinstance(col, str) else col
    out = None
    for value, rank in ranks.items():
        out = F.when(col == value, F.lit(rank)) if out is None else out.when(col == value, F.lit(rank))
    return out.otherwise(F.lit(default))
