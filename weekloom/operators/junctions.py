"""Continuity where one source hands over to another."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.operators.windows import mark_fair, prev, whole


@dataclass(frozen=True)
class Junction:
    """A hand-over date with the change tolerance in percent."""

    name: str
    day: date
    tolerance: float

    def window(self, days: int) -> tuple[date, date]:
        return self.day - timedelta(days=days), self.day + timedelta(days=days)


def _inside(t: str, lo: date, hi: date) -> Column:
    return (F.col(t) >= F.lit(lo).cast("date")) & (F.col(t) <= F.lit(hi).cast("date"))


def junction_steps(df: DataFrame, junctions: list[Junction], window_days: int = 14, key="channel", t="week",
                   metrics=("subs", "views")) -> DataFrame:
    """Add per junction ``<name>_hits``: how many metric changes of the row break the tolerance.

    Only neighbours inside the window count, so the first row of a window has none. In date
    order a window is contiguous, hence the neighbour inside it is the previous row whenever
    that row is not older than the window; one shared lag serves all junctions.
    """
    out = {}
    for j in junctions:
        lo, hi = j.window(window_days)
        near = _inside(t, lo, hi) & (prev(t, key, t) >= F.lit(lo).cast("date"))
        hits = F.lit(0)
        for m in metrics:
            p = prev(m, key, t)
            broken = F.when(p > 0, F.abs(F.col(m) - p) / p.cast("double") * 100 > j.tolerance)
            hits = hits + F.when(near & broken, 1).otherwise(0)
        out[f"{j.name}_hits"] = hits
    return df.withColumns(out)


def junction_continuity(df: DataFrame, junctions: list[Junction], window_days: int = 14, key="channel",
                        t="week") -> DataFrame:
    """One row per junction: offending metric pairs and offending entities."""
    lo = min(j.window(window_days)[0] for j in junctions)
    hi = max(j.window(window_days)[1] for j in junctions)
    steps = junction_steps(df.filter(_inside(t, lo, hi)).select(key, t, "subs", "views"), junctions, window_days, key, t)
    per_entity = steps.groupBy(key).agg(*[F.sum(f"{j.name}_hits").alias(j.name) for j in junctions])
    pairs = F.explode(F.array(*[F.struct(F.lit(j.name).alias("junction"), F.col(j.name).alias("hits"))
                                for j in junctions]))
    return (per_entity.select(pairs.alias("p")).select("p.*").groupBy("junction")
            .agg(F.sum("hits").cast("bigint").alias("bad_pairs"), F.count_if(F.col("hits") > 0).alias("bad_entities")))


def flag_junctions(df: DataFrame, junctions: list[Junction], window_days: int = 14, key="channel", t="week",
                   flag="data_quality_flag") -> DataFrame:
    """All rows of an offending entity inside the window become ``fair``."""
    rows = junction_steps(df, junctions, window_days, key, t)
    names = [f"{j.name}_hits" for j in junctions]
    rows = rows.withColumns({f"_{n}": F.max(n).over(whole(key)) for n in names})
    bad = F.lit(False)
    for j in junctions:
        bad = bad | (_inside(t, *j.window(window_days)) & (F.col(f"_{j.name}_hits") > 0))
    return mark_fair(rows, bad, flag).drop(*names, *[f"_{n}" for n in names])


def junction_regression(df: DataFrame, day: date, weeks: int = 4, metric: str = "views", key="channel",
                        t="week") -> DataFrame:
    """Fit a line to the rows before the junction, predict the rows after it, report the variance %.

    Pre and post rows of an entity meet in one aggregate window, so no self join is needed.
    """
    lo, hi = day - timedelta(weeks=weeks), day + timedelta(weeks=weeks)
    x = F.unix_date(F.col(t))
    pre = F.col(t) < F.lit(day).cast("date")
    w = whole(key)
    rows = df.filter(_inside(t, lo, hi)).select(key, t, metric).withColumns({
        "_slope": F.regr_slope(F.when(pre, F.col(metric)), x).over(w),
        "_mean": F.avg(F.when(pre, F.col(metric))).over(w), "_mid": F.avg(F.when(pre, x)).over(w)})
    fit = F.col("_mean") + F.col("_slope") * (x - F.col("_mid"))
    return (rows.filter(~pre).withColumn("predicted", fit).filter(F.col("predicted").isNotNull())
            .select(key, t, F.col(metric).alias("actual"), "predicted",
                    F.when(F.col("predicted") > 0, F.abs(F.col(metric) - F.col("predicted"))
                           / F.col("predicted") * 100).alias("variance_pct")))


# fixed values: upper variance limits (percent) of the tiers at the first and second junction
FIRST_CUTS = (5.0, 10.0, 15.0)
SECOND_CUTS = (3.0, 7.0, 10.0)


def junction_tier(variance: Column | str, cuts=FIRST_CUTS) -> Column:
    v = F.col(variance) if isinstance(variance, str) else variance
    return (F.when(v.isNull(), F.lit("missing")).when(v < cuts[0], F.lit("excellent"))
            .when(v < cuts[1], F.lit("good")).when(v <= cuts[2], F.lit("fair")).otherwise(F.lit("poor")))


def junction_nearest(df: DataFrame, day: date, key="channel", t="week", carry=("subs", "views", "videos")) -> DataFrame:
    """Per entity the row closest to the junction, earliest on ties."""
    away = F.abs(F.datediff(F.col(t), F.lit(day).cast("date")))
    best = df.groupBy(key).agg(F.min(F.struct(away.alias("days_away"), F.col(t), *[F.col(c) for c in carry])).alias("b"))
    return best.select(key, f"b.{t}", "b.days_away", *[f"b.{c}" for c in carry])


def junction_pair_check(df: DataFrame, day: date, max_gap: int = 14, max_sub: float = 0.05, max_view: float = 0.10,
                        key="channel", t="week", source="collection_source") -> DataFrame:
    """Last row up to the junction against the first row of the next source from it on.

    Both picks are conditional aggregates of the same group-by: one shuffle, no join. The next
    source is any source other than that of the last row, so one candidate per source is kept
    (the number of sources is fixed) and the earliest of another source wins.
    """
    d = F.lit(day).cast("date")
    row = F.struct(F.col(t).alias("t"), F.col(source).alias("s"), F.col("subs").alias("subs"), F.col("views").alias("views"))
    per_source = df.groupBy(key, source).agg(
        F.max(F.when(F.col(t) <= d, row)).alias("before"), F.min(F.when(F.col(t) >= d, row)).alias("after"))
    per_key = per_source.groupBy(key).agg(F.max("before").alias("a"), F.collect_list("after").alias("c"))
    other = F.array_min(F.filter("c", lambda r: r["s"] != F.col("a.s")))
    pairs = per_key.withColumn("b", other).filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    days = F.datediff(F.col("b.t"), F.col("a.t"))

    def rate(m: str) -> Column:
        a, b = F.col(f"a.{m}"), F.col(f"b.{m}")
        return F.when(a > 0, (b - a) / a.cast("double") / F.greatest(days, F.lit(1))).otherwise(F.lit(0.0))

    out = pairs.select(key, F.col("a.t").alias("before_week"), F.col("b.t").alias("after_week"), days.alias("gap_days"),
                       rate("subs").alias("subs_rate"), rate("views").alias("views_rate"))
    return out.withColumn("passed", (F.col("gap_days") <= max_gap) & (F.col("subs_rate") <= max_sub)
                          & (F.col("views_rate") <= max_view))
