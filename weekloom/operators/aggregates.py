"""Summaries, coverage and progress counts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions import scalars as S
from weekloom.schema import ENTITY_STATUSES, QUALITY_RANK, rank_of


def _share(cond: Column) -> Column:
    """Share of rows that meet the condition; 0 on empty input."""
    n = F.count(F.lit(1))
    return F.when(n > 0, F.count_if(F.coalesce(cond, F.lit(False))) / n.cast("double")).otherwise(F.lit(0.0))


def one_row(*frames: DataFrame) -> DataFrame:
    """Put one-row frames side by side with a union and an aggregate instead of a join."""
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])


def dataset_summary(df: DataFrame, key="channel", t="week", source="collection_source", flag="data_quality_flag") -> DataFrame:
    """One row: totals, date range, counts by source and by quality flag.

    Rows shrink to (entity, source, flag) counts first; distinct entities and both maps come
    from those.
    """
    cells = df.groupBy(key, source, flag).agg(F.count(F.lit(1)).alias("n"), F.min(t).alias("lo"), F.max(t).alias("hi"))
    totals = cells.groupBy(key).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"), F.count(F.lit(1)).alias("unique_channels"),
        F.min("lo").alias("start_date"), F.max("hi").alias("end_date"))

    def counts(col: str, name: str) -> DataFrame:
        per = cells.groupBy(F.coalesce(F.col(col), F.lit("")).alias("v")).agg(F.sum("n").alias("n"))
        return per.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("v", "n")))).alias(name))

    return one_row(totals, counts(source, "collection_sources"), counts(flag, "quality_flags"))


def value_distribution(df: DataFrame, col: str, domain: list[str]) -> DataFrame:
    """Rows per value, with zero rows for values of the domain that do not occur."""
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    zeros = df.sparkSession.createDataFrame([(v, 0) for v in domain], "value string, n bigint")
    return counts.unionByName(zeros).groupBy("value").agg(F.sum("n").alias("n"))


# fixed values: required share of non-null values by importance
COMPLETENESS_LIMITS = {"critical": 1.0, "important": 0.95, "optional": 0.8}
REQUIRED_FIELDS = {
    "critical": ["channel", "datetime", "views", "subs"],
    "important": ["category", "videos"],
    "optional": ["channel_name", "total_longform_views"],
}


def completeness(df: DataFrame, fields: dict[str, list[str]] = REQUIRED_FIELDS) -> DataFrame:
    """Null count and filled share per field against the limit of its importance; one pass."""
    present = [(level, f) for level, names in fields.items() for f in names if f in df.columns]
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(f).isNull()).alias(f) for _, f in present])
    rows = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.lit(level).alias("importance"), F.col(f).alias("nulls"),
                                        F.lit(COMPLETENESS_LIMITS[level]).alias("required")) for level, f in present]))
    filled = F.when(F.col("_n") > 0, 1.0 - F.col("nulls") / F.col("_n").cast("double")).otherwise(F.lit(1.0))
    return (one.select("_n", rows.alias("r")).select("_n", "r.*").withColumn("filled_ratio", filled)
            .withColumn("passed", F.col("filled_ratio") >= F.col("required")).drop("_n"))


def entity_coverage(df: DataFrame, expected_weeks: int, key="channel", t="week", source="collection_source",
                    flag="data_quality_flag") -> DataFrame:
    """Per entity: date range, points, share of expected weeks, sources used, mean row grade (5..1)."""
    n = F.count(F.lit(1))
    cover = F.least(n / F.lit(float(expected_weeks)), F.lit(1.0)) if expected_weeks > 0 else F.lit(0.0)
    return df.groupBy(key).agg(
        F.min(t).alias("first_date"), F.max(t).alias("last_date"), n.alias("points"), cover.alias("coverage"),
        F.sort_array(F.collect_set(source)).alias("sources"), F.avg(rank_of(flag, QUALITY_RANK)).alias("mean_grade"))


def source_quality_grade(obs: DataFrame, target_weeks: int = 165, variant: str = "flagged", key="channel", t="week",
                         flags: str = "point_flags") -> DataFrame:
    """Grade of a collected series per entity.

    ``flagged`` judges the share of flagged points, ``complete`` the share of points with both
    subs and views above zero.
    """
    bad = F.size(F.coalesce(F.col(flags), F.array().cast("array<string>"))) > 0 if flags in obs.columns else F.lit(False)
    out = obs.groupBy(key).agg(
        F.count(F.lit(1)).alias("points"), F.floor(F.datediff(F.max(t), F.min(t)) / 7).cast("int").alias("weeks_covered"),
        _share(bad).alias("flagged_share"), _share((F.col("subs") > 0) & (F.col("views") > 0)).alias("complete_share"))
    cover = F.col("weeks_covered") / F.lit(float(target_weeks))
    flagged, complete = F.col("flagged_share"), F.col("complete_share")
    ok = {"flagged": [flagged < 0.1, flagged < 0.2, flagged < 0.3],
          "complete": [complete > 0.9, complete > 0.8, complete > 0.7]}[variant]
    return out.withColumn("coverage", cover).withColumn(
        "grade", F.when((cover > 0.9) & ok[0], F.lit("excellent")).when((cover > 0.7) & ok[1], F.lit("good"))
        .when((cover > 0.5) & ok[2], F.lit("fair")).otherwise(F.lit("poor")))


def collection_report(entities: DataFrame) -> DataFrame:
    """Totals, success rate in percent and counts of the five statuses."""
    n = F.count(F.lit(1))
    enriched = F.count_if(F.col("processing_status") == "enriched")
    return entities.agg(
        n.alias("total_channels"), enriched.alias("enriched_channels"),
        F.count_if(F.col("processing_status") == "failed").alias("failed_channels"),
        F.count_if(F.col("processing_status") == "not_found").alias("not_found_channels"),
        F.when(n > 0, enriched / n.cast("double") * 100).otherwise(F.lit(0.0)).alias("success_rate"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ENTITY_STATUSES])


def phase_stats(results: DataFrame, phase="phase", key="channel") -> DataFrame:
    """Per phase: entities processed and successful, rate, points, weeks, mean weeks per entity.

    Needs (phase, entity, success, data_points, weeks) rows; an entity with several results
    counts once and is successful if any result is.
    """
    per = results.groupBy(phase, key).agg(F.max("success").alias("ok"), F.sum("data_points").alias("points"),
                                          F.sum("weeks").alias("weeks"))
    n = F.count(F.lit(1))
    return per.groupBy(phase).agg(
        n.alias("channels_processed"), F.count_if("ok").alias("channels_successful"),
        (F.count_if("ok") / n.cast("double") * 100).alias("success_rate"), F.sum("points").alias("total_data_points"),
        F.sum("weeks").alias("total_weeks_covered"), (F.sum("weeks") / n.cast("double")).alias("average_weeks_per_channel"))


def coverage_report(df: DataFrame, eras: list[tuple[str, date, date, float]], total_entities: int | None = None,
                    key="channel", t="week", source="collection_source") -> DataFrame:
    """Entities with any data by era and source, with subtotals, against the era's goal.

    ``eras`` lists (name, first day, last day, goal share). Rows are reduced to distinct
    (era, source, entity) before the rollup.
    """
    era, goal = None, None
    for name, lo, hi, g in eras:
        inside = F.col(t).between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
        era = F.when(inside, F.lit(name)) if era is None else era.when(inside, F.lit(name))
        goal = F.when(F.col("era") == name, F.lit(g)) if goal is None else goal.when(F.col("era") == name, F.lit(g))
    # an entity has few eras and sources: its own and their totals are listed once for each entity, so nothing is counted distinct
    cells = df.select(key, era.alias("era"), F.col(source).alias("source")).filter(F.col("era").isNotNull())
    pair = F.struct("era", "source")
    own = cells.groupBy(key).agg(F.collect_set(pair).alias("_p"))
    eras = F.array_distinct(F.transform("_p", lambda p: F.struct(p["era"].alias("era"), F.lit(None).cast("string").alias("source"))))
    every = F.array(F.struct(F.lit(None).cast("string").alias("era"), F.lit(None).cast("string").alias("source")))
    # a subtotal is marked, as a source may be null itself
    listed = F.concat(*[F.transform(c, lambda p, level=level: F.struct(F.lit(level).alias("level"), p["era"].alias("era"), p["source"].alias("source")))
                        for level, c in enumerate((every, eras, F.col("_p")))])
    out = own.select(F.explode(listed).alias("g")).groupBy("g.level", "g.era", "g.source").agg(F.count(F.lit(1)).alias("entities")).drop("level")
    if total_entities is not None:
        total = F.lit(int(total_entities))
    else:
        total = F.first(F.when(F.col("era").isNull(), F.col("entities")), ignorenulls=True).over(
            Window.partitionBy(F.lit(1)))       # the rollup has a handful of rows
    share = F.when(total > 0, F.col("entities") / total.cast("double")).otherwise(F.lit(0.0))
    out = out.withColumn("share", share).withColumn("goal", F.coalesce(goal, F.lit(0.9)))
    return out.select(F.coalesce("era", F.lit("ALL")).alias("era"), F.coalesce("source", F.lit("ALL")).alias("source"),
                      "entities", "share", "goal", (F.col("share") >= F.col("goal")).alias("met"))


def collector_stats(events: DataFrame, collector="collector") -> DataFrame:
    """Per collector: requests, success percent, mean wait, failures, data points."""
    n, ok = F.count(F.lit(1)), F.count_if("success")
    return events.groupBy(collector).agg(
        n.alias("requests_made"), ok.alias("requests_successful"), (n - ok).alias("requests_failed"),
        (ok / n.cast("double") * 100).alias("success_rate"), F.avg("wait").alias("average_wait"),
        F.sum("data_points").alias("data_points_collected"))


def run_rollup(phases: DataFrame, run="run_id") -> DataFrame:
    """Totals over the phases of a run, with the rounded summary figures."""
    processed = F.coalesce(F.sum("channels_processed"), F.lit(0))
    rate = F.when(processed > 0, F.sum("channels_successful") / processed.cast("double")).otherwise(F.lit(0.0))
    return phases.groupBy(run).agg(
        processed.alias("total_channels_processed"), F.coalesce(F.sum("records_created"), F.lit(0)).alias("total_records_created"),
        F.coalesce(F.sum("duration_seconds"), F.lit(0.0)).alias("total_seconds"),
        F.round(F.sum("duration_seconds") / 3600, 3).alias("total_hours"), F.round(rate, 3).alias("success_rate"))


def junction_pass_rates(entities: DataFrame, junctions: list[str], validated="junction_points_validated",
                        key="channel") -> DataFrame:
    """Percent of entities validated per junction; junctions nobody passed are listed with 0."""
    n = F.count(F.lit(1))
    one = entities.groupBy(key).agg(*[F.max(F.array_contains(validated, j)).alias(j) for j in junctions]).agg(
        n.alias("_n"), *[F.count_if(F.coalesce(F.col(j), F.lit(False))).alias(j) for j in junctions])
    rows = F.explode(F.array(*[F.struct(F.lit(j).alias("junction"), F.col(j).alias("validated")) for j in junctions]))
    return one.select("_n", rows.alias("r")).select(
        "r.junction", "r.validated", F.col("_n").alias("total_channels"),
        F.when(F.col("_n") > 0, F.col("r.validated") / F.col("_n").cast("double") * 100).otherwise(F.lit(0.0)).alias("rate"))


def metric_correlation(df: DataFrame, a="subs", b="views", key="channel") -> DataFrame:
    """Correlation of two metrics per entity; null where one does not vary."""
    a, b = F.col(a).cast("double"), F.col(b).cast("double")
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("points"), F.when(spread > 0, F.covar_pop(a, b) / spread).alias("correlation"))


def variation(df: DataFrame, lo, hi, metric="views", key="channel", t="week") -> DataFrame:
    """Coefficient of variation of a metric inside a window of dates."""
    rows = df.filter(F.col(t).between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))
    mean = F.avg(metric)
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("points"),
                                 F.when(mean != 0, F.stddev_samp(metric) / mean).alias("cv"))


def parse_log_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """``ts - logger - level - message`` text lines to columns; other lines drop out."""
    parts = F.split(F.col(col), " - ", 4)
    return (lines.withColumn("_p", parts).filter(F.size("_p") == 4)
            .select(F.col("_p")[0].alias("ts"), F.col("_p")[1].alias("logger"), F.col("_p")[2].alias("level"),
                    F.col("_p")[3].alias("message")))


def log_summary(logs: DataFrame, hours: float = 1.0) -> DataFrame:
    """One row over parsed log lines: level counts, active collectors, rates, response time, quality."""
    msg = F.lower("message")

    def number(tag: str) -> Column:
        return F.regexp_extract(msg, tag + r":\s*([0-9]+(?:\.[0-9]+)?)", 1).try_cast("double")

    score = number("quality_score")
    collector = F.regexp_extract("logger", r"collectors\.([^ ]+)", 1)
    return logs.agg(
        F.count(F.lit(1)).alias("lines"),
        *[F.count_if(F.col("level") == lv).alias(f"{lv.lower()}_lines") for lv in ("ERROR", "WARNING", "INFO")],
        F.sort_array(F.collect_set(F.nullif(collector, F.lit("")))).alias("active_collectors"),
        (F.count_if(msg.contains("processed channel")) / F.lit(float(hours))).alias("processed_per_hour"),
        (F.count_if(msg.contains("api request")) / F.lit(60.0 * hours)).alias("api_requests_per_minute"),
        F.avg(number("api_response_time")).alias("mean_api_response_time"),
        F.max_by(score, F.when(score.isNotNull(), F.struct("ts", score))).alias("last_quality_score"))


def source_reliability(df: DataFrame, source="collection_source", flag="data_quality_flag", metrics=("views", "subs", "videos"),
                       outlier: str | None = None) -> DataFrame:
    """Per source: share of usable rows, of rows with nulls, of flagged rows and of outliers."""
    has_null = F.lit(False)
    for m in metrics:
        has_null = has_null | F.col(m).isNull()
    flagged = ~F.col(flag).isin("excellent", "good")
    out = F.col(outlier) if outlier else F.lit(False)
    return df.groupBy(F.col(source).alias("source")).agg(
        F.count(F.lit(1)).alias("rows"), _share(~has_null & (F.col(flag) != "missing")).alias("success_rate"),
        _share(has_null).alias("null_share"), _share(flagged).alias("flagged_share"), _share(out).alias("outlier_share"))


def points_per_month(df: DataFrame, min_points: int = 4, key="channel", t="week") -> DataFrame:
    """Entity-months with too few weekly rows; the first and last month of an entity are exempt."""
    months = df.groupBy(key, F.date_trunc("month", F.col(t)).cast("date").alias("month")).agg(F.count(F.lit(1)).alias("points"))
    w = Window.partitionBy(key)
    ends = months.withColumns({"_lo": F.min("month").over(w), "_hi": F.max("month").over(w)})
    inner = (F.col("month") > F.col("_lo")) & (F.col("month") < F.col("_hi"))
    return ends.filter(inner & (F.col("points") < min_points)).drop("_lo", "_hi")
