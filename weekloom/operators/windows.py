"""Per-entity window operators over a panel.

All share ``partitionBy(key).orderBy(t)`` (or the same partitioning unordered), so a chain of
them costs one exchange and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions import scalars as S
from weekloom.schema import METRICS


def ordered(key: str = "channel", t: str = "week"):
    return Window.partitionBy(key).orderBy(t)


def whole(key: str = "channel"):
    return Window.partitionBy(key)


def prev(col: str, key: str = "channel", t: str = "week") -> Column:
    return F.lag(col).over(ordered(key, t))


def mark_fair(df: DataFrame, cond: Column, flag: str = "data_quality_flag") -> DataFrame:
    """Rows that meet the condition are flagged ``fair``; others keep their flag."""
    return df.withColumn(flag, F.when(cond, F.lit("fair")).otherwise(F.col(flag)))


def deltas(df: DataFrame, metrics=METRICS, key="channel", t="week") -> DataFrame:
    """Change since the entity's previous row; its first row has 0."""
    return df.withColumns({
        f"delta_{m}": F.coalesce(F.col(m) - prev(m, key, t), F.lit(0)).cast("bigint") for m in metrics})


def growth_rates(df: DataFrame, key="channel", t="week") -> DataFrame:
    """Relative growth of subs and views (0 when the previous value is not positive) and the
    plain change of videos."""
    out = {}
    for m in ("subs", "views"):
        p = prev(m, key, t)
        out[f"{m}_growth"] = S.ratio(F.col(m) - p, p)
    out["videos_growth"] = F.coalesce(F.col("videos") - prev("videos", key, t), F.lit(0)).cast("bigint")
    return df.withColumns(out)


def iqr_bounds(df: DataFrame, metrics, k: float = 1.5, key="channel") -> DataFrame:
    """Add the lower and upper fence of each metric per entity (linear-interpolated quartiles)."""
    w = whole(key)
    df = df.withColumns({f"_q_{m}": F.percentile(m, F.array(F.lit(0.25), F.lit(0.75))).over(w) for m in metrics})
    out = {}
    for m in metrics:
        q1, q3 = F.col(f"_q_{m}")[0], F.col(f"_q_{m}")[1]
        out[f"{m}_lo"] = q1 - F.lit(float(k)) * (q3 - q1)
        out[f"{m}_hi"] = q3 + F.lit(float(k)) * (q3 - q1)
    return df.withColumns(out).drop(*[f"_q_{m}" for m in metrics])


def iqr_outliers(df: DataFrame, metrics=("delta_views", "delta_subs"), k: float = 1.5, min_rows: int = 4,
                 key="channel", flag: str | None = "data_quality_flag") -> DataFrame:
    """Add ``<m>_iqr_outlier`` per metric; flag rows with any outlier ``fair``."""
    metrics = list(metrics)
    rows = iqr_bounds(df, metrics, k, key).withColumn("_n", F.count(F.lit(1)).over(whole(key)))
    hit = {f"{m}_iqr_outlier": F.coalesce((F.col("_n") >= min_rows)
                                          & ((F.col(m) < F.col(f"{m}_lo")) | (F.col(m) > F.col(f"{m}_hi"))),
                                          F.lit(False)) for m in metrics}
    rows = rows.withColumns(hit).drop("_n", *[f"{m}_{s}" for m in metrics for s in ("lo", "hi")])
    return mark_fair(rows, F.greatest(*hit, F.lit(False)), flag) if flag and flag in df.columns else rows


def zscore_outliers(df: DataFrame, metrics=("delta_views", "delta_subs"), z: float = 3.0, min_rows: int = 4,
                    key="channel", flag: str | None = "data_quality_flag") -> DataFrame:
    """Add ``<m>_z_outlier``: population z-score beyond ``z``; no spread means no outlier."""
    metrics = list(metrics)
    w = whole(key)
    stats = {"_n": F.count(F.lit(1)).over(w)}
    for m in metrics:
        stats[f"_mean_{m}"] = F.avg(m).over(w)
        stats[f"_sd_{m}"] = F.stddev_pop(m).over(w)
    hit = {f"{m}_z_outlier": F.coalesce(
        F.when(F.col(f"_sd_{m}") > 0, (F.col("_n") >= min_rows)
               & (F.abs(F.col(m) - F.col(f"_mean_{m}")) / F.col(f"_sd_{m}") > z)), F.lit(False)) for m in metrics}
    rows = df.withColumns(stats).withColumns(hit).drop(*stats)
    return mark_fair(rows, F.greatest(*hit, F.lit(False)), flag) if flag and flag in df.columns else rows


def gap_days(key="channel", t="week") -> Column:
    return F.datediff(F.col(t), prev(t, key, t))


def weekly_granularity(df: DataFrame, expected: int = 7, tol: int = 3, key="channel", t="week") -> DataFrame:
    """Add the gap to the previous row and whether it is off the weekly rhythm."""
    rows = df.withColumn("gap_days", gap_days(key, t))
    off = ~F.col("gap_days").between(expected - tol, expected + tol)
    return rows.withColumn("off_rhythm", F.coalesce(off, F.lit(False)))


def consistency_score(key="channel", t="week") -> Column:
    """1 - mean capped relative change over the metrics with a positive previous value."""
    diffs = []
    for m in ("subs", "views", "videos"):
        p = prev(m, key, t)
        diffs.append(F.when(p > 0, F.least(F.abs(F.col(m) - p) / p.cast("double"), F.lit(1.0))))
    total = F.lit(0.0)
    count = F.lit(0)
    for d in diffs:
        total = total + F.coalesce(d, F.lit(0.0))
        count = count + F.when(d.isNotNull(), 1).otherwise(0)
    return F.when(count > 0, 1.0 - total / count).otherwise(F.lit(1.0))


def cross_source_consistency(df: DataFrame, min_score: float = 0.8, key="channel", t="week",
                             source="collection_source", flag="data_quality_flag") -> DataFrame:
    """Score each source change; scores below ``min_score`` make the row ``fair``."""
    before = prev(source, key, t)
    rows = df.withColumns({"_prev_source": before, "_score": consistency_score(key, t)})
    changed = F.col("_prev_source").isNotNull() & (F.col("_prev_source") != F.col(source))
    rows = (rows.withColumn("consistency_score", F.when(changed, F.col("_score")))
            .withColumn("inconsistent", F.coalesce(F.col("consistency_score") < min_score, F.lit(False)))
            .drop("_prev_source", "_score"))
    return mark_fair(rows, F.col("inconsistent"), flag) if flag in df.columns else rows


def growth_limits(df: DataFrame, sub: float = 0.2, view: float = 0.5, uploads: int = 50,
                  key="channel", t="week") -> DataFrame:
    """Three limit hits per row. Needs the delta columns; single-row entities are skipped."""
    n = F.count(F.lit(1)).over(whole(key))
    rows = df.withColumns({"_n": n, "_ps": prev("subs", key, t), "_pv": prev("views", key, t)})

    def over(delta: str, base: str, limit: float) -> Column:
        den = F.col(base).cast("double") + 1
        return F.coalesce(F.when(den != 0, F.col(delta) / den > limit), F.lit(False)) & (F.col("_n") > 1)

    return rows.withColumns({
        "sub_growth_hit": over("delta_subs", "_ps", sub),
        "view_growth_hit": over("delta_views", "_pv", view),
        "upload_hit": F.coalesce(F.col("delta_videos") > uploads, F.lit(False)) & (F.col("_n") > 1),
    }).drop("_n", "_ps", "_pv")


def monotonic_check(df: DataFrame, tol: float = 0.02, metric: str = "videos", key="channel", t="week") -> DataFrame:
    """True where a cumulative count drops by more than ``tol`` of its previous value."""
    p = prev(metric, key, t)
    drop = F.coalesce((p > 0) & (p - F.col(metric) > p * F.lit(float(tol))), F.lit(False))
    return df.withColumn(f"{metric}_decreased", drop)


def jump_reset(df: DataFrame, jump: float = 10.0, tol: float = 0.02, metric: str = "views",
               key="channel", t="week") -> DataFrame:
    """``spike`` when the value exceeds ``jump`` times the previous, ``reset`` when it falls
    below (1 - tol) times it."""
    p = prev(metric, key, t)
    kind = (F.when((p > 0) & (F.col(metric) > p * F.lit(float(jump))), F.lit("spike"))
            .when((p > 0) & (F.col(metric) < p * F.lit(1.0 - tol)), F.lit("reset")))
    return df.withColumn(f"{metric}_event", F.coalesce(kind, F.lit("none")))


def rolling_growth(df: DataFrame, weeks: int = 4, z: float = 2.5, metric: str = "views",
                   key="channel", t="week") -> DataFrame:
    """Mean weekly growth over the last ``weeks`` rows, and rows whose growth z-score exceeds ``z``."""
    p = prev(metric, key, t)
    rows = df.withColumn("growth", S.ratio(F.col(metric) - p, p))
    w = whole(key)
    return rows.withColumns({
        "rolling_growth": F.avg("growth").over(ordered(key, t).rowsBetween(-(weeks - 1), 0)),
        "_mean": F.avg("growth").over(w), "_sd": F.stddev_pop("growth").over(w),
    }).withColumn("growth_outlier", F.coalesce(
        F.when(F.col("_sd") > 0, F.abs(F.col("growth") - F.col("_mean")) / F.col("_sd") > z), F.lit(False))
    ).drop("_mean", "_sd")


def smooth(df: DataFrame, weeks: int = 4, metric: str = "views", key="channel", t="week") -> DataFrame:
    """Trailing mean of a metric over the last ``weeks`` rows."""
    return df.withColumn(f"{metric}_smooth", F.avg(metric).over(ordered(key, t).rowsBetween(-(weeks - 1), 0)))


def winsorize(df: DataFrame, mode: str = "fence", metrics=("delta_views",), k: float = 1.5, min_rows: int = 4,
              key="channel") -> DataFrame:
    """Replace outliers by the fence value or the entity median; originals stay in ``<m>_orig``."""
    metrics = list(metrics)
    w = whole(key)
    rows = iqr_bounds(df, metrics, k, key).withColumn("_n", F.count(F.lit(1)).over(w))
    if mode == "median":
        rows = rows.withColumns({f"_med_{m}": F.percentile(m, F.lit(0.5)).over(w) for m in metrics})
    out = {}
    for m in metrics:
        v, lo, hi = F.col(m).cast("double"), F.col(f"{m}_lo"), F.col(f"{m}_hi")
        fixed = F.least(F.greatest(v, lo), hi) if mode == "fence" else (
            F.when((v < lo) | (v > hi), F.col(f"_med_{m}")).otherwise(v))
        out[f"{m}_orig"] = F.col(m)
        out[m] = F.when(F.col("_n") >= min_rows, fixed).otherwise(v)
    keep = df.columns + [f"{m}_orig" for m in metrics]
    return rows.withColumns(out).select(*keep)


def activity_status(df: DataFrame, active: int = 4, dormant: int = 26, key="channel", t="week") -> DataFrame:
    """Activity class from the weeks since the last upload. Needs ``delta_videos``."""
    last = F.last(F.when(F.col("delta_videos") > 0, F.col(t)), ignorenulls=True).over(
        ordered(key, t).rowsBetween(Window.unboundedPreceding, 0))
    rows = df.withColumn("_last", last)
    weeks = F.floor(F.datediff(F.col(t), F.col("_last")) / 7)
    return rows.withColumns({
        "weeks_since_upload": weeks.cast("int"),
        "activity": F.when(F.col("_last").isNull(), F.lit("unknown")).when(weeks <= active, F.lit("active"))
        .when(weeks <= dormant, F.lit("inactive")).otherwise(F.lit("dormant")),
    }).drop("_last")


def trend_deviation(df: DataFrame, thr: float = 0.20, pct: float = 0.25, metric: str = "views",
                    key="channel", t="week") -> DataFrame:
    """Deviation from the entity's straight-line trend, and single steps above ``pct``."""
    w = whole(key)
    x = F.unix_date(F.col(t))
    p = prev(metric, key, t)
    rows = df.withColumns({"_slope": F.regr_slope(F.col(metric), x).over(w), "_mean": F.avg(metric).over(w), "_mid": F.avg(x).over(w),
                           "_step": S.ratio(F.abs(F.col(metric) - p), p)})
    # around the means: an intercept at day 0 lies far outside the data and would cost digits
    fit = F.col("_mean") + F.col("_slope") * (x - F.col("_mid"))
    dev = F.when(fit != 0, F.abs(F.col(metric) - fit) / F.abs(fit))
    return rows.withColumn("trend_deviation", dev).withColumns({
        "trend_outlier": F.coalesce(F.col("trend_deviation") > thr, F.lit(False)),
        "step_outlier": F.col("_step") > pct,
    }).drop("_slope", "_mean", "_mid", "_step")


def point_flags(obs: DataFrame, key="channel", t="week", change: float = 0.5) -> DataFrame:
    """Flags of a chart point: negative values, changes above ``change`` of the value, all zero."""
    rows = deltas(obs, ["subs", "views"], key, t)
    subs, views = F.col("subs"), F.col("views")
    return rows.withColumn("point_flags", S.messages(
        ((subs < 0) | (views < 0), "negative_values"),
        (F.abs(F.col("delta_subs")) > subs * F.lit(change), "large_subscriber_change"),
        (F.abs(F.col("delta_views")) > views * F.lit(change), "large_view_change"),
        ((subs == 0) & (views == 0), "zero_values")))


def upload_flags(obs: DataFrame, key="channel", t="obs_date", count="upload_count", change: int = 1000) -> DataFrame:
    """Flags of an upload point; falls inside interpolated stretches are named separately."""
    rows = obs.withColumn("delta_uploads", F.coalesce(F.col(count) - prev(count, key, t), F.lit(0)).cast("bigint"))
    made = F.coalesce(F.col("interpolated"), F.lit(False)) if "interpolated" in obs.columns else F.lit(False)
    delta = F.col("delta_uploads")
    return rows.withColumn("quality_flags", S.messages(
        (made, "interpolated_data"), (F.col(count) < 0, "negative_uploads"),
        (F.abs(delta) > change, "large_upload_change"),
        ((delta < 0) & made, "interpolated_decrease"), ((delta < 0) & ~made, "decreasing_uploads")))


def series_validity(obs: DataFrame, min_points: int = 100, key="channel", t="week") -> DataFrame:
    """Per entity: enough points, mean interval of 6-8 days, no fall of subs below 90 %."""
    rows = obs.select(key, t, "subs", gap_days(key, t).alias("_gap"), prev("subs", key, t).alias("_p"))
    out = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("points"), F.avg("_gap").alias("mean_interval"),
        F.count_if(F.coalesce(F.col("subs") < F.col("_p") * F.lit(0.9), F.lit(False))).alias("drops"))
    return out.withColumn("valid", (F.col("points") >= min_points)
                          & F.coalesce(F.col("mean_interval").between(6.0, 8.0), F.lit(False))
                          & (F.col("drops") == 0))


def upload_series_validity(obs: DataFrame, key="channel", t="week", count="videos", keep: float = 0.8, max_count: int | None = None) -> DataFrame:
    """Per entity: last count not below ``keep`` of the first; maximum at most ``max_count`` if given."""
    out = obs.groupBy(key).agg(
        F.count(F.lit(1)).alias("points"), F.min_by(count, t).alias("first_count"),
        F.max_by(count, t).alias("last_count"), F.max(count).alias("max_count"))
    reason = (F.when((F.col("points") > 1) & (F.col("last_count") < F.col("first_count") * F.lit(keep)), F.lit("decreased"))
              .when(F.col("max_count") > max_count if max_count is not None else F.lit(False), F.lit("too_high")).otherwise(F.lit("ok")))
    return out.withColumn("reason", reason).withColumn("valid", F.col("reason") == "ok")
