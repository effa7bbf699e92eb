"""Choosing rows: duplicates, best and first rows per key, evenly spread picks, top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions import scalars as S
from weekloom.schema import QUALITY_RANK, SOURCE_RANK, rank_of


def pick_best(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Per key the row with the largest ordering tuple.

    An aggregate, not a ranking window: each map task sends at most one row per key, so a key
    with most of the rows costs no more than any other.
    """
    cols = df.columns
    rest = [c for c in cols if c not in keys]
    tuple_ = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)],
                      *[F.col(c).alias(f"t{i}") for i, c in enumerate(rest)])
    best = df.groupBy(*keys).agg(F.max(tuple_).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.t{rest.index(c)}").alias(c) for c in cols])


def dedup_weekly(df: DataFrame, key: str = "channel", t: str = "datetime", week: str = "week") -> DataFrame:
    """One row per entity and Sunday week: best quality, then source precedence, latest
    time, largest views; all other columns break the remaining ties."""
    rows = df.withColumn(week, S.week_start_sunday(t))
    return pick_best(rows, [key, week], [
        rank_of("data_quality_flag", QUALITY_RANK), rank_of("collection_source", SOURCE_RANK),
        F.col(t), F.col("views")])


def best_duplicate(obs: DataFrame, key: str = "channel", t: str = "obs_date",
                   stamp: str | None = None) -> DataFrame:
    """Same entity and exact date: keep the most complete point, ties to the latest snapshot."""
    score = (F.when(F.col("views") > 0, F.lit(1000.0)).otherwise(F.lit(0.0))
             + F.coalesce(F.col("views"), F.lit(0)) / F.lit(1_000_000.0)
             + F.coalesce(F.col("subs"), F.lit(0)) / F.lit(1000.0))
    return pick_best(obs, [key, t], [score] + ([F.col(stamp)] if stamp else []))


def first_per_week(obs: DataFrame, key: str = "channel", t: str = "obs_date", week: str = "week") -> DataFrame:
    """Earliest point of each week; several on that date: largest counts."""
    rows = obs.withColumn(week, S.week_start_sunday(t))
    return pick_best(rows, [key, week], [-F.unix_date(F.col(t))])


def promote_latest(df: DataFrame, current_week, key: str = "channel", t: str = "week") -> DataFrame:
    """Each entity's newest row, if not older than a week, becomes the final API row."""
    w = Window.partitionBy(key).orderBy(F.col(t).desc())
    newest = ((F.row_number().over(w) == 1)
              & (F.col(t).cast("date") >= F.date_sub(F.lit(current_week).cast("date"), 7)))
    return (df.withColumn("_newest", newest).withColumns({
        "collection_source": F.when(F.col("_newest"), F.lit("FINAL_API")).otherwise(F.col("collection_source")),
        "data_quality_flag": F.when(F.col("_newest"), F.lit("excellent")).otherwise(F.col("data_quality_flag")),
    }).drop("_newest"))


#: Rows of an entity that one task may order, and parts that a larger entity is cut into at most.
PART_ROWS, MOST_PARTS = 1 << 20, 512


def parts_of(df: DataFrame, key: str, order: list[str], leading: Column | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """Distinct rows of ``df`` with ``_copies``, their place in the order (``_o``) and the ``_part`` of their entity they are in.

    An entity of more than ``part_rows`` rows is cut at splitters that are sampled from its own rows, so parts are even
    whatever values crowd together; any other one is one part.
    """
    columns = df.columns
    by = [*order, *[c for c in columns if c not in (key, *order)]]
    rows = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")).withColumn("_o", F.struct(*([] if leading is None else [leading.alias("_l")]), *by))
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    # a hashed sample of each large entity's rows, some 32 for each part; every 32nd one is a splitter
    parts = F.least(F.ceil(F.col("_rows") / part_rows), F.lit(MOST_PARTS))
    large = sizes.filter(F.col("_rows") > part_rows).select(key, F.greatest(F.floor(F.col("_rows") / (32 * parts)), F.lit(1)).alias("_every"))
    taken = rows.join(large, key).filter(F.pmod(F.xxhash64("_o"), F.col("_every")) == 0)
    sample = taken.groupBy(key).agg(F.array_sort(F.collect_list("_o")).alias("_s"))
    cuts = sample.select(key, F.filter("_s", lambda x, i: (i + 1) % 32 == 0).alias("_cuts"))
    return rows.join(cuts, key, "left").withColumn("_part", F.coalesce(F.size(F.filter("_cuts", lambda c: c <= F.col("_o"))), F.lit(0))).drop("_cuts")


def position_in_key(df: DataFrame, key: str, order: list[str], leading: Column | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """Add ``pos`` (0-based position in the entity's order, all other columns breaking ties) and ``total``.

    ``leading`` is compared before ``order``; nulls come first everywhere. No task orders a whole hot entity: equal rows
    are one row with a count, positions are counted inside even parts and shifted by the entity's earlier ones.
    """
    columns = df.columns
    placed = parts_of(df, key, order, leading, part_rows)
    w = Window.partitionBy(key)
    counts = placed.groupBy(key, "_part").agg(F.sum("_copies").alias("_c"))
    before = w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(key, "_part", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"), F.sum("_c").over(w).alias("total"))
    inner = Window.partitionBy(key, "_part").orderBy("_o").rowsBetween(Window.unboundedPreceding, -1)
    first = placed.withColumn("_at", F.coalesce(F.sum("_copies").over(inner), F.lit(0))).join(offsets, [key, "_part"])
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1))
    return first.select(*columns, "total", (F.col("_before") + F.col("_at")).alias("_p"), copies.alias("_i")).select(*columns, "total", (F.col("_p") + F.col("_i")).alias("pos"))


def spread_snapshots(idx: DataFrame, n: int | None = 10, key: str = "channel", stamp: str = "timestamp",
                     tie: str = "digest") -> DataFrame:
    """Of the status-200 snapshots of an entity keep about ``n`` spread evenly over its list (None: all)."""
    ok = idx.filter(F.col("statuscode").cast("string") == "200")
    if n is None:
        return ok
    placed = position_in_key(ok, key, [stamp, tie])
    wanted = F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                         lambda i: F.floor(i * F.col("total") / F.lit(float(n))).cast("bigint"))
    return (placed.filter((F.col("total") <= n) | F.array_contains(wanted, F.col("pos").cast("bigint")))
            .drop("total"))


def weekly_snapshots(idx: DataFrame, max_weeks: int | None = None, key: str = "channel", stamp: str = "timestamp",
                     tie: str = "digest") -> DataFrame:
    """First status-200 snapshot of each ISO week; only of the earliest ``max_weeks`` weeks if given."""
    day = S.parse_snapshot_ts(stamp).cast("date")
    monday = F.date_trunc("week", day).cast("date")
    rows = (idx.filter(F.col("statuscode").cast("string") == "200").filter(day.isNotNull())
            .withColumn("iso_week", monday))
    rest = [c for c in idx.columns if c != key]
    first = rows.groupBy(key, "iso_week").agg(
        F.min(F.struct(stamp, tie, *[c for c in rest if c not in (stamp, tie)])).alias("_first"))
    if max_weeks is not None:
        w = Window.partitionBy(key).orderBy("iso_week")
        first = first.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= max_weeks)
    return first.select(key, "iso_week", "_first.*")


def top_snapshots(idx: DataFrame, end, n: int | None = 3, key: str = "channel", stamp: str = "timestamp",
                  tie: str = "digest") -> DataFrame:
    """Best ``n`` snapshots by coverage score above zero (None: all, unranked); ranked limits apply before the shuffle."""
    scored = idx.withColumn("coverage_score", S.score_snapshot(stamp, "statuscode", end)).filter("coverage_score > 0")
    if n is None:
        return scored
    w = Window.partitionBy(key).orderBy(F.col("coverage_score").desc(), F.col(stamp).desc(), F.col(tie))
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def sort_panel(df: DataFrame, key: str = "channel", t: str = "week") -> DataFrame:
    return df.orderBy(key, t)


def recent_errors(logs: DataFrame, n: int = 10) -> DataFrame:
    """The last ``n`` ERROR rows of a parsed log."""
    return logs.filter(F.col("level") == "ERROR").orderBy(F.col("ts").desc(), F.col("logger"), F.col("message")).limit(n)


def sample_head(entities: DataFrame, n: int, key: str = "channel") -> DataFrame:
    """First ``n`` entities by key; a deterministic test-run limit."""
    return entities.orderBy(key).limit(n)
