"""Filling gaps in a series: carry, interpolation, extrapolation, resampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.operators.windows import ordered


def fill(spine: DataFrame, max_gap_days: int = 14, metrics=("views", "subs", "videos"), key="channel",
         t="week") -> DataFrame:
    """Forward fill, then backward fill, each only across at most ``max_gap_days``.

    ``spine`` has one row per entity and week; metrics are null where nothing was observed.
    """
    w = ordered(key, t)
    past = w.rowsBetween(Window.unboundedPreceding, 0)
    # looking ahead is a running frame over the reverse order: a frame that ends at the last row
    # would be evaluated anew for every row
    ahead = Window.partitionBy(key).orderBy(F.col(t).desc()).rowsBetween(Window.unboundedPreceding, 0)
    out = {}
    for m in metrics:
        point = F.when(F.col(m).isNotNull(), F.struct(F.col(t).alias("t"), F.col(m).alias("v")))
        b, a = F.last(point, ignorenulls=True).over(past), F.last(point, ignorenulls=True).over(ahead)
        out[m] = F.coalesce(F.when(F.datediff(F.col(t), b["t"]) <= max_gap_days, b["v"]),
                            F.when(F.datediff(a["t"], F.col(t)) <= max_gap_days, a["v"]))
    made = F.lit(False)
    for m in metrics:
        made = made | (F.col(m).isNull() & F.col(f"_{m}").isNotNull())
    filled = spine.withColumns({f"_{m}": c for m, c in out.items()})
    return (filled.withColumn("filled", made).withColumns({m: F.col(f"_{m}") for m in metrics})
            .drop(*[f"_{m}" for m in metrics]))


def interpolate_weekly(obs: DataFrame, min_gap_days: int = 14, max_gap_days: int | None = None,
                       value: str = "upload_count", key="channel", t="obs_date", stamp: str | None = None) -> DataFrame:
    """Add weekly points inside every gap longer than ``min_gap_days``.

    n = max(1, gap div 7 - 1) points at +7, +14, ... days; each truncated and never below the
    left value. Output has ``interpolated`` and ``interpolation_source``. Observed and made rows
    leave through one explode over the lead window, so the input is read and shuffled once.
    """
    w = ordered(key, t)
    tag = F.col(stamp) if stamp else F.col(t).cast("string")
    rows = obs.withColumns({"_t2": F.lead(t).over(w), "_v2": F.lead(value).over(w), "_s": tag,
                            "_s2": F.lead(tag).over(w)})
    gap = F.datediff(F.col("_t2"), F.col(t))
    wide = gap > min_gap_days
    if max_gap_days is not None:
        wide = wide & (gap <= max_gap_days)
    n = F.when(F.coalesce(wide, F.lit(False)), F.greatest(F.lit(1), F.floor(gap / 7).cast("int") - 1)).otherwise(F.lit(0))
    rows = rows.withColumn("_n", n).withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n"))))
    step = (F.col("_v2") - F.col(value)) * (F.col("_i") / (F.col("_n") + 1).cast("double"))
    made = F.greatest((F.col(value) + step).cast("bigint"), F.col(value).cast("bigint"))
    is_made = F.col("_i") > 0
    source = F.when(is_made, F.struct(
        F.col("_s").alias("from_snapshot"), F.col("_s2").alias("to_snapshot"),
        F.col("_i").alias("interpolation_step"), (F.col("_n") + 1).alias("total_steps")))
    return (rows.withColumns({
        "_made": F.when(is_made, made).otherwise(F.col(value).cast("bigint")),
        "_at": F.date_add(F.col(t), F.col("_i") * 7), "interpolated": is_made, "interpolation_source": source})
        .withColumns({value: F.col("_made"), t: F.col("_at")})
        .drop("_t2", "_v2", "_s", "_s2", "_n", "_i", "_made", "_at"))


def extrapolate_to_current(obs: DataFrame, current: DataFrame, as_of, step: int = 30, value: str = "upload_count",
                           current_value: str = "current_count", key="channel", t="obs_date") -> DataFrame:
    """Points every ``step`` days from each entity's last observation to its current count.

    Only where the gap exceeds ``step`` days and the count grew; ends with the current point.
    """
    last = obs.groupBy(key).agg(F.max(F.struct(F.col(t).alias("t"), F.col(value).alias("v"))).alias("l"))
    today = F.lit(as_of).cast("date")
    rows = last.join(current.groupBy(key).agg(F.max(current_value).alias(current_value)), key)
    gap = F.datediff(today, F.col("l.t"))
    rise = F.col(current_value) - F.col("l.v")
    rows = rows.filter((gap > step) & (rise > 0)).withColumn("_n", F.floor((gap - 1) / F.lit(step)).cast("int"))
    rows = rows.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n") + 1)))
    is_made = F.col("_i") <= F.col("_n")
    days = F.col("_i") * step
    made = F.least((F.col("l.v") + rise / gap.cast("double") * days).cast("bigint"), F.col(current_value).cast("bigint"))
    return rows.select(
        key,
        F.when(is_made, F.date_add(F.col("l.t"), days)).otherwise(today).alias(t),
        F.when(is_made, made).otherwise(F.col(current_value).cast("bigint")).alias(value),
        F.when(is_made, F.lit("current_api_interpolated")).otherwise(F.lit("youtube_api_current")).alias("source"),
        is_made.alias("interpolated"))


def resample(df: DataFrame, unit: str = "month", key="channel", t="week", carry=("views", "subs", "videos")) -> DataFrame:
    """Last row of each entity and month or quarter."""
    if unit not in ("month", "quarter"):
        raise ValueError("unit must be month or quarter")
    period = F.date_trunc(unit, F.col(t)).cast("date")
    last = df.groupBy(key, period.alias("period")).agg(F.max(F.struct(F.col(t), *[F.col(c) for c in carry])).alias("_r"))
    return last.select(key, "period", f"_r.{t}", *[f"_r.{c}" for c in carry])
