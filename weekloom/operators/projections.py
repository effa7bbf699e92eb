"""Row-wise operators: calendar columns, derived ratios, layouts, arrival rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.functions import scalars as S
from weekloom.schema import BASE_COLUMNS, ENHANCED_COLUMNS


def calendar_fields(df: DataFrame, t: str = "datetime") -> DataFrame:
    """Add year, quarter, ISO week number and the Sunday the week starts on."""
    day = F.col(t).cast("date")
    return df.withColumns({
        "year": F.year(day), "quarter": F.quarter(day), "week_number": F.weekofyear(day),
        "week_start_date": S.week_start_sunday(day),
    })


def add_enhanced_columns(df: DataFrame, source: str = "API") -> DataFrame:
    """Defaults for the columns the base layout lacks."""
    zero = F.lit(0).cast("bigint")
    return df.withColumns({
        "total_longform_views": zero, "total_shorts_views": zero, "channel_name": F.lit(""),
        "collection_source": F.lit(source), "data_quality_flag": F.lit("good"),
    })


def filter_range(df: DataFrame, start, end, t: str = "datetime") -> DataFrame:
    """Rows inside the inclusive date range; a plain comparison, so it reaches the scan."""
    return df.filter((F.col(t) >= F.lit(start).cast("date")) & (F.col(t) <= F.lit(end).cast("date")))


def derived_channel_metrics(df: DataFrame, views="views", subs="subs", videos="videos") -> DataFrame:
    return df.withColumns({
        "avg_views_per_video": S.ratio(views, videos),
        "subscriber_to_view_ratio": S.ratio(subs, views),
    })


def engagement_metrics(df: DataFrame) -> DataFrame:
    """Views per subscriber and per video, and the split of the short/long view counts."""
    total = F.col("total_longform_views") + F.col("total_shorts_views")
    return df.withColumns({
        "views_per_subscriber": S.ratio("views", "subs"),
        "views_per_video": S.ratio("views", "videos"),
        "shorts_ratio": S.ratio("total_shorts_views", total),
        "longform_ratio": S.ratio("total_longform_views", total),
    })


def near_junction(df: DataFrame, dates, days: int = 14, t: str = "datetime") -> DataFrame:
    return df.withColumn("near_junction", S.near_any(t, dates, days))


def record_issue_array() -> Column:
    longform, shorts, views = F.col("total_longform_views"), F.col("total_shorts_views"), F.col("views")
    split = longform + shorts
    return S.messages(
        (views < 0, "Negative view count"),
        (F.col("subs") < 0, "Negative subscriber count"),
        (F.col("videos") < 0, "Negative video count"),
        ((split > 0) & (views > 0) & (split > views * F.lit(1.1)),
         "Longform + shorts views exceed total views"),
        (F.abs(F.col("delta_views")) > views, "Delta views exceeds total views"),
        (F.abs(F.col("delta_subs")) > F.col("subs"), "Delta subs exceeds total subs"),
    )


def record_issues(df: DataFrame) -> DataFrame:
    """Array of the consistency messages that apply to the row."""
    return df.withColumn("issues", record_issue_array())


def _iso(t: str) -> Column:
    return F.date_format(F.col(t).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")


def to_base_format(df: DataFrame, t: str = "datetime") -> DataFrame:
    """The ten base columns, datetime as ISO text."""
    return df.select(*[_iso(t).alias("datetime") if c == "datetime" else F.col(c) for c in BASE_COLUMNS])


def to_enhanced_format(df: DataFrame, t: str = "datetime") -> DataFrame:
    """The fifteen enhanced columns, datetime as ISO text."""
    return df.select(*[_iso(t).alias("datetime") if c == "datetime" else F.col(c) for c in ENHANCED_COLUMNS])


def score_snapshots(idx: DataFrame, end, stamp="timestamp", status="statuscode") -> DataFrame:
    return idx.withColumn("coverage_score", S.score_snapshot(stamp, status, end))


def project_api_item(items: DataFrame, item: str = "item", description_chars: int | None = None) -> DataFrame:
    """Flatten one list-response item: names, description (cut only if asked to), counters default 0."""
    it = F.col(item)
    published = it["snippet"]["publishedAt"]
    description = F.coalesce(it["snippet"]["description"], F.lit(""))
    if description_chars is not None:
        description = F.substring(description, 1, description_chars)

    def counter(name: str) -> Column:
        return F.coalesce(it["statistics"][name].try_cast("bigint"), F.lit(0).cast("bigint"))

    return items.select(
        it["id"].alias("channel"),
        it["snippet"]["title"].alias("channel_name"),
        description.alias("description"),
        S.normalize_handle(it["snippet"]["customUrl"]).alias("handle"),
        F.coalesce(it["snippet"]["country"], F.lit("")).alias("country"),
        it["snippet"]["defaultLanguage"].alias("language"),
        it["snippet"]["categoryId"].alias("category_id"),
        F.coalesce(F.try_element_at(it["snippet"]["thumbnails"], F.lit("high"))["url"],
                   F.try_element_at(it["snippet"]["thumbnails"], F.lit("default"))["url"],
                   F.lit("")).alias("thumbnail"),
        F.when(published.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"),
               F.substring(published, 1, 10)).try_cast("date").alias("created_date"),
        counter("subscriberCount").alias("subs"),
        counter("viewCount").alias("views"),
        counter("videoCount").alias("videos"),
        it["statistics"]["hiddenSubscriberCount"].alias("subscriber_count_hidden"),
        F.coalesce(it["status"]["privacyStatus"], F.lit("public")).alias("privacy"),
        # a counter that is present but no number is a processing failure
        (_bad(it["statistics"]["subscriberCount"]) | _bad(it["statistics"]["viewCount"])
         | _bad(it["statistics"]["videoCount"])).alias("parse_failed"),
    )


def _bad(counter: Column) -> Column:
    return counter.isNotNull() & counter.try_cast("bigint").isNull()


def breakdown_check(df: DataFrame, tol: float = 0.5, max_views: int = 100_000_000_000,
                    max_subs: int = 500_000_000) -> DataFrame:
    """First failing plausibility reason of the view split and the hard caps, else ``ok``."""
    longform, shorts, views = F.col("total_longform_views"), F.col("total_shorts_views"), F.col("views")
    return df.withColumn("breakdown_status",
        F.when(views > max_views, F.lit("views_too_high"))
        .when(F.col("subs") > max_subs, F.lit("subs_too_high"))
        .when((longform > 0) & (shorts > 0) & (views > 0)
              & (F.abs(longform + shorts - views) > views * F.lit(float(tol))), F.lit("breakdown_mismatch"))
        .otherwise(F.lit("ok")))


def ratio_check(df: DataFrame, lo: float = 10.0, hi: float = 10_000.0) -> DataFrame:
    """Views per subscriber and whether it leaves [lo, hi]; without subscribers it is not judged."""
    value = F.when(F.col("subs") > 0, F.col("views").cast("double") / F.col("subs"))
    return df.withColumns({
        "views_per_sub": value,
        "ratio_out_of_range": F.coalesce(~value.between(lo, hi), F.lit(False)),
    })
