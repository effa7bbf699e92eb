"""Joins of panels, entities and observations.

No join here is hinted: entity tables grow with the data, so whether a side is small enough to
broadcast is left to the size statistics at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions import scalars as S
from weekloom.operators.ranking import pick_best


def enrich_entities(entities: DataFrame, items: DataFrame, key: str = "channel") -> DataFrame:
    """Requested entities with what was returned for them.

    ``items`` is the flat output of ``project_api_item``. Matched entities become ``enriched``,
    unreadable counters ``failed`` and unmatched ones ``not_found``, each failure with a flag.
    """
    # repeated requests may return an entity twice: one readable answer per entity
    items = pick_best(items, [key], [~F.col("parse_failed"), F.col("views")])
    got = items.select(F.col(key), F.col("channel_name").alias("_name"), F.col("description").alias("_description"),
                       F.col("country").alias("_country"), F.col("created_date").alias("_created"),
                       F.col("subs").alias("_subs"), F.col("views").alias("_views"), F.col("videos").alias("_videos"),
                       F.col("privacy").alias("_privacy"), F.col("parse_failed").alias("_failed"),
                       F.lit(True).alias("_found"))
    rows = entities.join(got, key, "left")
    found, failed = F.coalesce(F.col("_found"), F.lit(False)), F.coalesce(F.col("_failed"), F.lit(False))
    good = found & ~failed
    flags = F.col("validation_flags") if "validation_flags" in entities.columns else F.array().cast("array<string>")
    flags = S.flag_add(flags, "youtube_api_not_found", ~found)
    flags = S.flag_add(flags, "youtube_api_processing_error", failed)
    keep = [c for c in entities.columns if c not in ("channel_name", "status", "validation_flags")]
    return rows.select(
        *keep,
        F.when(good, F.coalesce("_name", "channel_name")).otherwise(F.col("channel_name")).alias("channel_name"),
        F.when(good, S.map_status("_privacy")).when(~found, F.lit("terminated"))
        .otherwise(F.col("status")).alias("status"),
        F.col("_description").alias("description"), F.col("_country").alias("country"),
        F.col("_created").alias("created_date"),
        *[F.when(good, F.col(f"_{m}")).alias(f"current_{m}") for m in ("subs", "views", "videos")],
        F.when(~found, F.lit("not_found")).when(failed, F.lit("failed")).otherwise(F.lit("enriched"))
        .alias("processing_status"),
        flags.alias("validation_flags"))


def unexpected_items(items: DataFrame, entities: DataFrame, key: str = "channel") -> DataFrame:
    """Returned but never requested."""
    return items.join(entities.select(key), key, "left_anti")


def remaining(entities: DataFrame, done: DataFrame, key: str = "channel") -> DataFrame:
    """Entities a resumed run still has to process."""
    return entities.join(done.select(key), key, "left_anti")


def attach_metadata(df: DataFrame, entities: DataFrame, key: str = "channel") -> DataFrame:
    """Set name and category from the entity table; missing metadata keeps the old values.

    Of repeated entities the one with the largest name, then category counts; rows never multiply.
    """
    meta = entities.select(key, F.col("channel_name").alias("_name"), F.col("category").alias("_category"))
    meta = pick_best(meta, [key], [F.col("_name"), F.col("_category")])
    rows = df.join(meta, key, "left")
    old = F.col("channel_name") if "channel_name" in df.columns else F.lit("")
    return (rows.withColumns({"channel_name": F.coalesce("_name", old), "category": F.coalesce("_category", "category")})
            .drop("_name", "_category"))


def resolve_source_key(entities: DataFrame, legacy: DataFrame, key: str = "channel") -> DataFrame:
    """Key to look an entity up with: legacy mapping, else its id, else the handle without ``@``."""
    known = legacy.filter(F.col("legacy_key") != "").groupBy(key).agg(F.max("legacy_key").alias("legacy_key"))
    rows = entities.join(known, key, "left")
    handle = F.regexp_replace(F.coalesce(F.col("handle"), F.lit("")), "^@", "")
    return rows.withColumn("source_key", F.coalesce(
        F.nullif("legacy_key", F.lit("")), F.nullif(key, F.lit("")), F.nullif(handle, F.lit(""))
    )).drop("legacy_key")


def sundays_between(start: Column, end: Column) -> Column:
    """Array of the Sundays in [first Sunday >= start, end]; empty when there is none."""
    first = S.week_start_sunday(F.date_add(start, 6))
    return F.when(first <= end, F.sequence(first, end, F.expr("interval 7 days"))).otherwise(
        F.array().cast("array<date>"))


def dense_spine(entities: DataFrame, start, end, key: str = "channel", week: str = "week") -> DataFrame:
    """Every entity with every Sunday of the range, grown in place from a calendar sequence."""
    weeks = sundays_between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return entities.select(key, F.explode(weeks).alias(week))


def missing_weeks(df: DataFrame, spine: DataFrame, key: str = "channel", week: str = "week") -> DataFrame:
    """Weeks of the spine without a row."""
    return spine.join(df.select(key, week), [key, week], "left_anti")


def missing_runs(df: DataFrame, entities: DataFrame, start, end, key: str = "channel", week: str = "week") -> DataFrame:
    """(key, gap_start, gap_weeks): unbroken runs of Sundays from ``start`` to ``end`` without a row, for every entity.

    Gaps and islands: each row looks at the one before it, and a closing row after the range ends the last run, so the
    work follows the rows that exist and no entity is ever laid out week by week. Entities without rows have one run.
    Rows outside of the range or between Sundays count for nothing; rows of unknown entities are left out.
    """
    def sunday(value, shift: int):
        return F.date_sub(F.date_add(F.lit(value).cast("date"), shift), (F.dayofweek(F.date_add(F.lit(value).cast("date"), shift)) - 1).cast("int"))
    first, after = sunday(start, 6), F.date_add(sunday(end, 0), 7)
    present = df.select(key, F.col(week).cast("date").alias(week)).filter(F.col(week).between(first, F.date_sub(after, 7)) & (F.dayofweek(week) == 1))
    ends = entities.select(key).distinct().select(key, after.alias(week), F.lit(True).alias("_known"))
    rows = present.withColumn("_known", F.lit(False)).unionByName(ends)
    w = Window.partitionBy(key).orderBy(week)
    before = F.coalesce(F.lag(week).over(w), F.date_sub(first, 7))
    rows = rows.withColumns({"gap_start": F.date_add(before, 7), "gap_weeks": (F.datediff(F.col(week), before) / 7).cast("int") - 1,
                             "_known": F.max("_known").over(Window.partitionBy(key))})
    return rows.filter(F.col("_known") & (F.col("gap_weeks") > 0)).select(key, "gap_start", "gap_weeks")


def weeks_of_runs(runs: DataFrame, key: str = "channel", week: str = "week") -> DataFrame:
    """The single weeks of ``missing_runs``: as many rows as there are weeks missing."""
    return runs.select(key, F.explode(F.transform(F.sequence(F.lit(0), F.col("gap_weeks") - 1), lambda i: F.date_add(F.col("gap_start"), (i * 7).cast("int")))).alias(week))


def asof_before(df: DataFrame, cutoff, key: str = "channel", t: str = "week", inclusive: bool = False,
                carry=("views", "subs", "videos")) -> DataFrame:
    """Per entity the last row before the cutoff; entities without one drop out."""
    at = F.lit(cutoff).cast("date")
    rows = df.filter(F.col(t) <= at if inclusive else F.col(t) < at)
    last = rows.groupBy(key).agg(F.max(F.struct(F.col(t), *[F.col(c) for c in carry])).alias("_r"))
    return last.select(key, f"_r.{t}", *[f"_r.{c}" for c in carry])


def nearest_join(left: DataFrame, right: DataFrame, value: str, key: str | list[str] = "channel", t: str = "t",
                 tol_days: int = 28, default=0) -> DataFrame:
    """Give each left row the right value nearest in time within ``tol_days`` (tie: earlier).

    Time is cut into buckets of the tolerance. A match lies in the row's own bucket, or is the
    last right row of the bucket before or the first of the bucket after; only those two rows
    per bucket are copied to the neighbours. Each (entity, bucket) is one small window, so a hot
    entity is spread over all its buckets and no pairs are produced. ``t`` is a date or a number
    of epoch milliseconds.
    """
    keys = [key] if isinstance(key, str) else list(key)
    dtype = dict(left.dtypes)[t]
    unit = 86_400_000 if dtype in ("bigint", "double", "int") else 1
    pos = F.col(t).cast("bigint") if unit > 1 else F.unix_date(F.col(t)).cast("bigint")
    span = tol_days * unit
    bucket = F.floor(F.col("_p") / F.lit(span)).cast("bigint")
    own = left.withColumn("_p", pos).withColumn("_b", bucket)
    # one right row per entity and instant: the last written wins, made explicit as the largest
    points = (right.groupBy(*keys, t).agg(F.max(value).alias("_rv")).withColumn("_p", pos).withColumn("_b", bucket)
              .select(*keys, "_b", "_p", "_rv"))
    edge = points.groupBy(*keys, "_b").agg(F.max(F.struct("_p", "_rv")).alias("_last"), F.min(F.struct("_p", "_rv")).alias("_first"))
    copies = edge.select(*keys, F.explode(F.array(
        F.struct((F.col("_b") + 1).alias("_b"), F.col("_last").alias("_x")),
        F.struct((F.col("_b") - 1).alias("_b"), F.col("_first").alias("_x")))).alias("_e")
    ).select(*keys, F.col("_e._b").alias("_b"), F.col("_e._x._p").alias("_p"), F.col("_e._x._rv").alias("_rv"))
    hits = points.unionByName(copies).withColumn("_r", F.struct("_p", "_rv")).drop("_rv")
    rows = own.withColumn("_left", F.lit(True)).unionByName(hits, allowMissingColumns=True)
    part = Window.partitionBy(*keys, "_b")
    upto = part.orderBy("_p").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    onward = part.orderBy(F.col("_p").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({
        "_before": F.last("_r", ignorenulls=True).over(upto), "_after": F.last("_r", ignorenulls=True).over(onward),
    }).filter(F.col("_left"))
    back, ahead = F.col("_p") - F.col("_before._p"), F.col("_after._p") - F.col("_p")
    near_back = F.when(back <= span, back)
    near_ahead = F.when(ahead <= span, ahead)
    use_back = near_back.isNotNull() & (near_ahead.isNull() | (near_back <= near_ahead))
    found = F.when(use_back, F.col("_before._rv")).when(near_ahead.isNotNull(), F.col("_after._rv"))
    return rows.select(*left.columns, F.coalesce(found, F.lit(default)).alias(value))


def asof_uploads(df: DataFrame, uploads: DataFrame, key: str = "channel", t: str = "week",
                 obs_t: str = "obs_date", count: str = "upload_count", chart_source: str = "WAYBACK_CHARTS",
                 upload_source: str = "WAYBACK_UPLOADS") -> DataFrame:
    """Chart rows take the latest upload count observed up to their week and are retagged;
    ``delta_videos`` is then recomputed.

    Uploads are first reduced to the last observation per week they can apply to, so a week
    carries at most one of them, whatever the number of snapshots.
    """
    first_week = S.week_start_sunday(F.date_add(F.col(obs_t).cast("date"), 6))
    latest = (uploads.groupBy(key, first_week.alias("_w"))
              .agg(F.max(F.struct(F.col(obs_t), F.col(count).cast("bigint").alias("_count"))).alias("_u"))
              .select(key, F.col("_w").alias(t), F.col("_u._count").alias("_seen")))
    rows = df.withColumn("_row", F.lit(True)).unionByName(latest, allowMissingColumns=True)
    # at equal weeks the upload sorts first (null marker first), so the panel row sees it
    w = Window.partitionBy(key).orderBy(F.col(t), F.col("_row").asc_nulls_first())
    seen = F.last("_seen", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("_asof", seen).filter(F.col("_row"))
    use = (F.col("collection_source") == chart_source) & F.col("_asof").isNotNull()
    rows = rows.withColumns({
        "videos": F.when(use, F.col("_asof")).otherwise(F.col("videos")),
        "collection_source": F.when(use, F.lit(upload_source)).otherwise(F.col("collection_source"))})
    by_week = Window.partitionBy(key).orderBy(t)
    delta = F.coalesce(F.col("videos") - F.lag("videos").over(by_week), F.lit(0)).cast("bigint")
    return rows.withColumn("delta_videos", delta).select(*dict.fromkeys(df.columns + ["delta_videos"]))


def overlap_compare(df: DataFrame, tol: float = 0.15, metrics=("views", "subs"), key: str = "channel",
                    t: str = "week", source: str = "collection_source") -> DataFrame:
    """Same entity and week seen by two sources: relative difference per metric.

    Rows are first reduced to one per (entity, week, source); the sources of a week are few and
    fixed, so they are paired inside one aggregated array instead of by a self join.
    """
    one = df.groupBy(key, t, source).agg(*[F.max(m).alias(m) for m in metrics])
    row = F.struct(F.col(source).alias("s"), *[F.col(m).alias(m) for m in metrics])
    sets = one.groupBy(key, t).agg(F.sort_array(F.collect_list(row)).alias("_r")).filter(F.size("_r") > 1)
    pairs = (sets.select(key, t, F.explode("_r").alias("a"), "_r")
             .select(key, t, "a", F.explode("_r").alias("b")).filter(F.col("a.s") < F.col("b.s")))
    out = [F.col("a.s").alias("source_a"), F.col("b.s").alias("source_b")]
    over = F.lit(False)
    for m in metrics:
        a, b = F.col(f"a.{m}"), F.col(f"b.{m}")
        diff = F.coalesce(F.when(a != 0, F.abs(b - a) / F.abs(a).cast("double")),
                          F.when(b == 0, F.lit(0.0)).otherwise(F.lit(1.0)))
        out.append(diff.alias(f"{m}_diff"))
        over = over | (diff > tol)
    return pairs.select(key, t, *out, over.alias("exceeds"))


def point_to_point_growth(df: DataFrame, entities: DataFrame | None, d1, d2, category: str | None = None,
                          k: int = 100, metric: str = "subs", key: str = "channel", t: str = "week") -> DataFrame:
    """Growth of a metric between two dates (each entity's row as of the date), best ``k``.

    Both snapshots come from one conditional aggregate: one pass, one shuffle with map-side
    combining, then a bounded top-k.
    """
    rows = df.filter(F.col(t) <= F.lit(d2).cast("date"))
    at = F.struct(F.col(t), F.col(metric))
    snaps = rows.groupBy(key).agg(
        F.max(F.when(F.col(t) <= F.lit(d1).cast("date"), at)).alias("_a"), F.max(at).alias("_b"))
    if entities is not None:
        if category is not None:
            entities = entities.filter(F.col("category") == category)
        named = pick_best(entities.select(key, "channel_name", "category"), [key], [F.col("channel_name")])
        snaps = snaps.join(named, key)
    carry = [] if entities is None else ["channel_name", "category"]
    start, end = F.col(f"_a.{metric}"), F.col(f"_b.{metric}")
    return (snaps.filter(start > 0)
            .select(key, *carry, start.alias("start_value"), end.alias("end_value"),
                    ((end - start) / start.cast("double")).alias("growth"))
            .orderBy(F.col("growth").desc(), F.col(key)).limit(k))


def reconcile_current(df: DataFrame, current: DataFrame, key: str = "channel", t: str = "week") -> DataFrame:
    """Judge each series against the entity's current counters; the first failing reason wins."""
    ends = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("points"), F.min_by("subs", t).alias("first_subs"),
        F.max(F.struct(F.col(t), F.col("subs"), F.col("views"))).alias("_l"))
    now = pick_best(current.select(key, "current_subs", "current_views"), [key], [F.col("current_subs"), F.col("current_views")])
    rows = ends.join(now, key, "left")
    cs, cv = F.coalesce("current_subs", F.lit(0)), F.coalesce("current_views", F.lit(0))
    last_subs, last_views = F.col("_l.subs"), F.col("_l.views")
    subs_ratio = F.when(cs > 0, last_subs / cs.cast("double"))
    views_ratio = F.when(cv > 0, last_views / cv.cast("double"))
    reason = (F.when((subs_ratio < 0.1) | (subs_ratio > 10), F.lit("subs_mismatch"))
              .when((views_ratio < 0.01) | (views_ratio > 100), F.lit("views_mismatch"))
              .when((F.col("first_subs") == 0) & (F.col("points") > 50), F.lit("starts_with_zero"))
              .when(last_subs < F.col("first_subs"), F.lit("negative_growth")).otherwise(F.lit("ok")))
    return rows.select(key, "points", "first_subs", last_subs.alias("last_subs"), last_views.alias("last_views"),
                       reason.alias("reason")).withColumn("valid", F.col("reason") == "ok")


def peer_deviation(df: DataFrame, key: str = "channel", t: str = "week", category: str = "category",
                   metric: str = "views") -> DataFrame:
    """Row growth against the median growth of its category in that week.

    The growth frame is written once and read for the medians' counts and for the comparison.
    """
    from weekloom.operators.quantiles import exact_quantile
    from weekloom.session import cut_lineage

    p = F.lag(metric).over(Window.partitionBy(key).orderBy(t))
    rows = df.withColumn("growth", F.when(p > 0, (F.col(metric) - p) / p.cast("double")))
    rows = cut_lineage(rows.filter(F.col("growth").isNotNull()))
    medians = exact_quantile(rows, [category, t], "growth", 0.5, "peer_growth", spread=[key])
    return (rows.join(medians, [category, t])
            .withColumn("peer_deviation", F.col("growth") - F.col("peer_growth")))
