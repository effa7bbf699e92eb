"""Arrival of observations: source, dedup, weekly windows, stateless rules, late rows, rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom.functions import scalars as S
from weekloom.operators.projections import record_issue_array
from weekloom.operators.quality import FRESH_HOURS, POOR_HOURS
from weekloom.schema import rank_of

LATENESS = "3 days"


def stream_observations(spark: SparkSession, path: str, schema: T.StructType, t: str = "obs_date", lateness: str = LATENESS,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream of observations with an event time column ``event_time`` and a watermark.

    The time column is cast because a watermark needs a timestamp with time zone.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path).withColumn("event_time", F.col(t).cast("timestamp")).withWatermark("event_time", lateness)


def stream_dedup(stream: DataFrame, key: str = "channel", week: str = "week", source: str = "collection_source") -> DataFrame:
    """First arrival per entity, week and source inside the watermark."""
    return stream.dropDuplicatesWithinWatermark([key, week, source])


def stream_weekly(stream: DataFrame, key: str = "channel", metrics=("views", "subs")) -> DataFrame:
    """Tumbling Sunday weeks: rows and the last observation's metrics per entity."""
    week = F.window("event_time", "7 days", "7 days", "3 days")
    out = stream.groupBy(week.alias("_w"), key).agg(
        F.count(F.lit(1)).alias("points"), F.max(F.struct("event_time", *metrics)).alias("_l"))
    return out.select(key, F.col("_w.start").cast("date").alias("week"), "points", *[F.col(f"_l.{m}").alias(m) for m in metrics])


def stream_rules(stream: DataFrame, junction_dates=(), days: int = 14, t: str = "week") -> DataFrame:
    """Stateless checks at arrival: issues, nearness to a junction, view split, views per subscriber."""
    from weekloom.operators.projections import breakdown_check, ratio_check

    rows = stream.withColumn("issues", record_issue_array()).withColumn("near_junction", S.near_any(t, junction_dates, days))
    return ratio_check(breakdown_check(rows))


def stream_error_rate(events: DataFrame, ts: str = "ts", length: str = "10 minutes", slide: str = "1 minute",
                      lateness: str = "10 minutes", threshold: float = 0.3, success: str = "success") -> DataFrame:
    """Share of failed events per sliding window; ``alert`` above the threshold.

    Works on a stream and, without the watermark, on a batch.
    """
    rows = events.withColumn("_ts", F.col(ts).cast("timestamp"))
    if events.isStreaming:
        rows = rows.withWatermark("_ts", lateness)
    n = F.count(F.lit(1))
    rate = F.count_if(~F.col(success)) / n.cast("double")
    out = rows.groupBy(F.window("_ts", length, slide).alias("_w")).agg(n.alias("events"), rate.alias("error_rate"))
    return out.select(F.col("_w.start").alias("window_start"), "events", "error_rate", (F.col("error_rate") > threshold).alias("alert"))


def stream_freshness(stream: DataFrame, as_of, t: str = "obs_date", source: str = "collection_source") -> DataFrame:
    """Newest event per source against its limit; run in update or complete mode.

    A handful of sources: each partial aggregate sends one row per source.
    """
    last = stream.groupBy(F.col(source).alias("source")).agg(F.max(t).alias("last_event"), F.count(F.lit(1)).alias("rows"))
    age = F.datediff(F.lit(as_of).cast("date"), F.col("last_event").cast("date")) * F.lit(24.0)
    limit = rank_of("source", FRESH_HOURS, -1.0)
    return last.withColumns({
        "age_hours": age,
        "status": F.when(limit < 0, F.lit("historical")).when(age <= limit, F.lit("fresh"))
        .when(age > POOR_HOURS, F.lit("poor")).otherwise(F.lit("stale"))})


def split_late(batch: DataFrame, newest, lateness_days: int = 3, t: str = "obs_date") -> tuple[DataFrame, DataFrame]:
    """(on time, late) rows of a batch against the newest event time seen before it."""
    limit = F.date_sub(F.lit(newest).cast("date"), lateness_days)
    late = F.coalesce(F.col(t).cast("date") < limit, F.lit(False))
    return batch.filter(~late), batch.filter(late)


def stream_late(stream: DataFrame, on_time_path: str, late_path: str, checkpoint: str, lateness_days: int = 3,
                t: str = "obs_date"):
    """Write rows older than the watermark to a side output for backfill; returns the query.

    The newest event time is kept with the on-time output itself, so a restarted query goes on
    from it, and each micro-batch lands in its own folder: replaying a batch overwrites it.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = None
        if batch_id > 0:
            # the mark of the batch before stands for all earlier ones
            newest = spark.read.schema("newest date").json(f"{on_time_path}/newest/batch={batch_id - 1}").first()[0]
        mark = batch.agg(F.greatest(F.max(F.col(t).cast("date")), F.lit(newest).cast("date")).alias("newest"))
        mark.write.mode("overwrite").json(f"{on_time_path}/newest/batch={batch_id}")
        good, late = split_late(batch, newest, lateness_days, t) if newest is not None else (batch, batch.limit(0))
        good.write.mode("overwrite").parquet(f"{on_time_path}/data/batch={batch_id}")
        late.write.mode("overwrite").parquet(f"{late_path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
