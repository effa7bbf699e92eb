"""Rules, scores, gates and review queues of a panel."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions import scalars as S
from weekloom.operators import junctions as J
from weekloom.operators import windows as W
from weekloom.operators.aggregates import one_row
from weekloom.operators.junctions import Junction
from weekloom.operators.quantiles import exact_quantile
from weekloom.session import cut_lineage
from weekloom.operators.ranking import pick_best
from weekloom.schema import INTERPOLATED_WEIGHT, QUALITY_FLAGS, QUALITY_RANK, SEVERITIES, SOURCE_RANK, SOURCE_WEIGHT, rank_of

CRITICAL_FIELDS = ["channel", "datetime", "views", "subs"]
IMPORTANT_FIELDS = ["category", "videos"]
NUMERIC_FIELDS = ["views", "delta_views", "subs", "delta_subs", "videos", "delta_videos"]


class SchemaError(ValueError):
    """A critical column is missing."""


@dataclass(frozen=True)
class Rule:
    """A validation rule.

    ``apply(panel, params, ctx)`` returns the panel with helper columns, a per-row count of
    hits, and the condition under which the row becomes ``fair`` (or None). Only column
    expressions, so every rule joins the same window pass.
    """

    name: str
    category: str
    severity: str
    level: str
    apply: Callable[[DataFrame, dict, dict], tuple[DataFrame, Column, Column | None]]
    message: str
    parameters: dict = field(default_factory=dict)
    enabled: bool = True


REGISTRY: dict[str, Rule] = {}
LEVELS = ["basic", "standard", "comprehensive"]


def register(rule: Rule) -> Rule:
    """Add or replace a rule; later runs of ``validate`` include it."""
    REGISTRY[rule.name] = rule
    return rule


def _int(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


def _weekly(df, p, ctx):
    df = W.weekly_granularity(df, p["expected_interval_days"], p["tolerance_days"], ctx["key"], ctx["t"])
    return df, _int(F.col("off_rhythm")), None


def _date_range(df, p, ctx):
    day = F.col(ctx["t"]).cast("date")
    lo, hi = F.lit(p["min_date"]).cast("date"), F.lit(p["max_date"]).cast("date")
    return df, _int((day < lo) | (day > hi)), None


def _growth(df, p, ctx):
    df = W.growth_limits(df, p["max_subscriber_growth_rate"], p["max_view_growth_rate"],
                         p["max_video_uploads_per_week"], ctx["key"], ctx["t"])
    hits = sum((_int(F.col(c)) for c in ("sub_growth_hit", "view_growth_hit", "upload_hit")), F.lit(0))
    return df, hits, None


def _outliers(df, p, ctx):
    df = W.zscore_outliers(df, ["delta_views", "delta_subs"], p["z_score_threshold"], key=ctx["key"], flag=None)
    df = W.iqr_outliers(df, ["views", "subs", "videos"], p["iqr_multiplier"], key=ctx["key"], flag=None)
    cols = ["delta_views_z_outlier", "delta_subs_z_outlier"] + [f"{m}_iqr_outlier" for m in ("views", "subs", "videos")]
    return df, sum((_int(F.col(c)) for c in cols), F.lit(0)), F.greatest(*cols)


def _junctions(df, p, ctx):
    js = ctx["junctions"]
    names = [f"{j.name}_hits" for j in js]
    df = J.junction_steps(df, js, p["window_days"], ctx["key"], ctx["t"])
    df = df.withColumns({f"_any_{n}": F.max(n).over(W.whole(ctx["key"])) for n in names})
    bad = F.lit(False)
    for j in js:
        bad = bad | (J._inside(ctx["t"], *j.window(p["window_days"])) & (F.col(f"_any_{j.name}_hits") > 0))
    return df, sum((F.col(n) for n in names), F.lit(0)), bad


def _cross_source(df, p, ctx):
    df = W.cross_source_consistency(df, p["min_score"], ctx["key"], ctx["t"], flag="")
    return df, _int(F.col("inconsistent")), F.col("inconsistent")


def _nulls(fields):
    def apply(df, p, ctx):
        names = [ctx["t"] if f == "datetime" else f for f in fields]
        # an absent column is missing in every row
        return df, sum((_int(F.col(f).isNull()) if f in df.columns else F.lit(1) for f in names), F.lit(0)), None
    return apply


def _required(df, p, ctx):
    return df, F.lit(sum(f not in df.columns for f in IMPORTANT_FIELDS)), None


def _types(df, p, ctx):
    texts = [f for f, kind in df.dtypes if f in NUMERIC_FIELDS and kind == "string"]
    bad = [_int(F.col(f).isNotNull() & F.trim(f).try_cast("double").isNull()) for f in texts]
    if dict(df.dtypes).get(ctx["t"]) == "string":
        bad.append(_int(F.col(ctx["t"]).isNotNull() & F.col(ctx["t"]).try_cast("timestamp").isNull()))
    return df, sum(bad, F.lit(0)), None


#: Rows that stand behind a reduced one.
COPIES = "_copies"


def reduced_weeks(df: DataFrame, key: str = "channel", t: str = "week", flag: str = "data_quality_flag", source: str = "collection_source") -> DataFrame:
    """One row for each entity and week with the number of rows it stands for: best flag, then source, then views.

    Combined in the map task, so an entity that repeats its weeks costs no more than its weeks. Rows without entity or
    week stay as they are.
    """
    whole = F.col(key).isNotNull() & F.col(t).isNotNull()
    order = [*([rank_of(flag, QUALITY_RANK)] if flag in df.columns else []), *([rank_of(source, SOURCE_RANK)] if source in df.columns else []), F.col("views")]
    rest = [c for c in df.columns if c not in (key, t)]
    best = df.filter(whole).groupBy(key, t).agg(
        F.max(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], *[F.col(c).alias(f"r{i}") for i, c in enumerate(rest)])).alias("_b"), F.count(F.lit(1)).alias(COPIES))
    kept = best.select(*[F.col(c) if c in (key, t) else F.col(f"_b.r{rest.index(c)}").alias(c) for c in df.columns], COPIES)
    return kept.unionByName(df.filter(~whole).withColumn(COPIES, F.lit(1).cast("bigint")))


def _unique(df, p, ctx):
    if COPIES in df.columns:                      # repeated rows were put together before
        return df, F.col(COPIES) - 1, None
    # next to each other in the order that the other rules use
    before = F.lag(ctx["t"]).over(Window.partitionBy(ctx["key"]).orderBy(ctx["t"]))
    return df, _int(before == F.col(ctx["t"])), None


register(Rule("required_fields", "schema", "high", "basic", _required, "missing required fields"))
register(Rule("data_types", "schema", "medium", "basic", _types, "values of a wrong type"))
register(Rule("unique_weeks", "schema", "high", "basic", _unique, "rows that repeat an entity's week"))
register(Rule("weekly_granularity", "temporal", "high", "basic", _weekly, "records violating weekly granularity",
              {"tolerance_days": 3, "expected_interval_days": 7}))
register(Rule("date_range", "temporal", "critical", "basic", _date_range, "records with dates outside valid range",
              {"min_date": "2015-01-01", "max_date": "2025-12-31"}))
register(Rule("growth_rate_limits", "statistical", "medium", "standard", _growth, "records with excessive growth rates",
              {"max_subscriber_growth_rate": 0.2, "max_view_growth_rate": 0.5, "max_video_uploads_per_week": 50}))
register(Rule("outlier_detection", "statistical", "low", "standard", _outliers, "statistical outliers",
              {"z_score_threshold": 3.0, "iqr_multiplier": 1.5}))
register(Rule("junction_continuity", "junction_point", "high", "comprehensive", _junctions, "junction point violations",
              {"window_days": 14}))
register(Rule("cross_source_consistency", "cross_source", "medium", "comprehensive", _cross_source,
              "cross-source inconsistencies", {"min_score": 0.8}))
register(Rule("critical_completeness", "completeness", "critical", "basic", _nulls(CRITICAL_FIELDS),
              "missing values in critical fields"))
register(Rule("important_completeness", "completeness", "high", "basic", _nulls(IMPORTANT_FIELDS),
              "missing values in important fields"))

DEFAULT_JUNCTIONS = [Junction("sep_2019", date(2019, 9, 1), 15.0), Junction("aug_2022", date(2022, 8, 1), 10.0)]


def select_rules(level: str = "comprehensive", overrides: dict[str, dict] | None = None) -> list[Rule]:
    """Registered rules up to a level, with parameters (or ``enabled``) overridden per run."""
    if level not in LEVELS:
        raise ValueError(f"level must be one of {LEVELS}")
    out = []
    for rule in REGISTRY.values():
        change = dict((overrides or {}).get(rule.name, {}))
        enabled = change.pop("enabled", rule.enabled)
        if enabled and LEVELS.index(rule.level) <= LEVELS.index(level):
            out.append(replace(rule, parameters={**rule.parameters, **change}))
    return out


def schema_check(df: DataFrame, t: str = "datetime") -> tuple[DataFrame, DataFrame]:
    """Column presence and number/date repair of a text panel.

    Missing critical columns raise; missing important ones give a result row. Unparsable
    numbers become 0 and unparsable dates null, both counted. Returns (typed panel, results).
    """
    have = set(df.columns)
    critical = [c for c in (t if f == "datetime" else f for f in CRITICAL_FIELDS) if c not in have]
    if critical:
        raise SchemaError(f"missing critical fields: {critical}")
    numbers = [c for c in NUMERIC_FIELDS if c in have]
    bad = F.lit(0)
    typed = {}
    for c in numbers:
        number = F.col(c).cast("string").try_cast("double")
        bad = bad + _int(number.isNull() | F.isnan(number))
        typed[c] = S.numeric_or_zero(c)
    dtype = dict(df.dtypes)[t]
    day = F.coalesce(F.col(t).try_cast("timestamp"), S.parse_flexible_date(t).cast("timestamp")) if dtype == "string" else F.col(t)
    bad = bad + _int(day.isNull())
    typed[t] = day
    counts = df.agg(F.coalesce(F.sum(bad), F.lit(0)).alias("affected_records"))
    results = counts.select(F.lit("data_types").alias("rule_name"), F.lit("medium").alias("severity"),
                            (F.col("affected_records") == 0).alias("passed"), "affected_records",
                            F.concat(F.lit("Fixed "), "affected_records", F.lit(" data type issues")).alias("message"))
    important = [c for c in IMPORTANT_FIELDS if c not in have]
    if important:
        row = counts.select(F.lit("required_fields").alias("rule_name"), F.lit("high").alias("severity"),
                            F.lit(False).alias("passed"), F.lit(0).cast("bigint").alias("affected_records"),
                            F.lit(f"Missing important fields: {important}").alias("message"))
        results = results.unionByName(row)
    return df.withColumns(typed), results


def date_range_check(df: DataFrame, lo="2015-01-01", hi="2025-12-31", t: str = "week") -> DataFrame:
    day = F.col(t).cast("date")
    out = (day < F.lit(lo).cast("date")) | (day > F.lit(hi).cast("date"))
    return df.agg(F.count_if(F.coalesce(out, F.lit(False))).alias("out_of_range"), F.min(day).alias("earliest_found"),
                  F.max(day).alias("latest_found"))


def annotate(df: DataFrame, rules: list[Rule], ctx: dict) -> tuple[DataFrame, Column | None]:
    """Run all rules over one shared partitioning; hits land in ``hit_<rule>`` columns."""
    fair = None
    for rule in rules:
        df, hits, cond = rule.apply(df, rule.parameters, ctx)
        df = df.withColumn(f"hit_{rule.name}", hits.cast("bigint"))
        if cond is not None:
            df = df.withColumn(f"fair_{rule.name}", F.coalesce(cond, F.lit(False)))
            fair = F.col(f"fair_{rule.name}") if fair is None else fair | F.col(f"fair_{rule.name}")
    return df, fair


def profile(annotated: DataFrame, rules: list[Rule], key: str = "channel", t: str = "week",
            flag: str | None = "data_quality_flag", fair: Column | None = None) -> DataFrame:
    """Everything results and metrics need as one row, in one pass.

    Counted per entity first, on the partitioning the rule windows already have, then summed;
    entities are counted, never collected.
    """
    full = F.lit(True)
    for c in (key, t, "views", "subs"):
        full = full & F.col(c).isNotNull()
    rows = annotated.withColumn("_full", full)
    flags = []
    if flag:
        final = F.coalesce(F.when(fair, F.lit("fair")).otherwise(F.col(flag)) if fair is not None else F.col(flag), F.lit(""))
        rows = rows.withColumn("_flag", final)
        flags = [*QUALITY_FLAGS, "other"]

    def has_flag(f: str) -> Column:
        return ~F.col("_flag").isin(QUALITY_FLAGS) if f == "other" else F.col("_flag") == f

    per_entity = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_full").alias("full"), *[F.sum(f"hit_{r.name}").alias(r.name) for r in rules],
        *[F.count_if(has_flag(f)).alias(f"flag_{f}") for f in flags])

    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    one = per_entity.agg(
        total("n").alias("n"), total("full").alias("full"), *[total(f"flag_{f}").alias(f"flag_{f}") for f in flags],
        *[F.struct(total(r.name).alias("affected_records"), F.count_if(F.col(r.name) > 0).alias("affected_channels")).alias(r.name)
          for r in rules])
    if flags:
        pairs = F.filter(F.array(*[F.struct(F.lit(f).alias("k"), F.col(f"flag_{f}").alias("v")) for f in sorted(flags)]), lambda p: p["v"] > 0)
        one = one.withColumn("quality_flags", F.map_from_entries(pairs))
    return one


def rule_results(one: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule out of the profile row."""
    rows = F.explode(F.array(*[F.struct(
        F.lit(r.name).alias("rule_name"), F.lit(r.category).alias("category"), F.lit(r.severity).alias("severity"),
        F.lit(r.message).alias("_m"), F.col(r.name)["affected_records"].alias("affected_records"),
        F.col(r.name)["affected_channels"].alias("affected_channels"),
        F.create_map(*[x for k, v in r.parameters.items() for x in (F.lit(k), F.lit(str(v)))]).cast("map<string,string>")
        .alias("details") if r.parameters else F.create_map().cast("map<string,string>").alias("details"),
    ) for r in rules]))
    return one.select(rows.alias("r")).select("r.*").select(
        "rule_name", "category", "severity", (F.col("affected_records") == 0).alias("passed"), "affected_records",
        "affected_channels", F.concat(F.lit("Found "), F.col("affected_records"), F.lit(" "), F.col("_m")).alias("message"), "details")


def validate(df: DataFrame, level: str = "comprehensive", junctions: list[Junction] = DEFAULT_JUNCTIONS,
             overrides: dict[str, dict] | None = None, key: str = "channel", t: str = "week",
             flag: str = "data_quality_flag", materialize: bool = False, reduce: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Check a panel; returns (flagged panel, results, metrics).

    An entity's windows hold its rows, at most one a week in a panel. For raw rows, whose weeks may repeat without
    bound, ``reduce`` puts the rows of a week together first: the panel that is checked and returned has the best one,
    and ``unique_weeks`` counts the others.

    All rules share one exchange on the entity. ``materialize`` writes the annotated rows and the
    one-row profile to the cluster's checkpoint folder, for callers that act on several outputs.
    """
    have = set(df.columns)
    missing = [c for c in (t, key, "views", "subs") if c not in have]
    if missing:
        raise SchemaError(f"missing critical fields: {missing}")
    rules = select_rules(level, overrides)
    columns = df.columns
    if reduce:
        df = reduced_weeks(df, key, t, flag)
    annotated, fair = annotate(df, rules, {"key": key, "t": t, "junctions": junctions})
    if materialize:
        keep = [F.col(f"hit_{r.name}") for r in rules]
        mark = (fair if fair is not None else F.lit(False)).alias("_fair")
        annotated = cut_lineage(annotated.select(*columns, *keep, mark))
        fair = F.col("_fair")
    one = profile(annotated, rules, key, t, flag if flag in have else None, fair)
    if materialize:
        one = cut_lineage(one)
    flagged = W.mark_fair(annotated, fair, flag) if fair is not None and flag in have else annotated

    def errors(s: str) -> Column:
        return sum((_int(F.col(r.name)["affected_records"] > 0) for r in rules if r.severity == s), F.lit(0)).cast("bigint")

    def affected(*names: str) -> Column:
        return sum((F.col(r.name)["affected_records"] for r in rules if not names or r.name in names), F.lit(0).cast("bigint"))

    row = one.select(
        F.col("n").alias("total_records"), F.col("full").alias("_full"), *[errors(s).alias(f"{s}_errors") for s in SEVERITIES],
        affected().alias("_affected"), affected("cross_source_consistency").alias("_cross"),
        affected("weekly_granularity", "date_range").alias("_temporal"), *(["quality_flags"] if flag in have else []))
    return flagged.select(*columns), rule_results(one, rules), _scores(row)


def _scores(row: DataFrame) -> DataFrame:
    """Scores out of the counts: a failed rule costs its severity weight once, spread over the rows."""
    n = F.col("total_records").cast("double")
    penalty = (F.col("critical_errors") * 0.4 + F.col("high_errors") * 0.3 + F.col("medium_errors") * 0.2
               + F.col("low_errors") * 0.1)

    def guarded(value: Column) -> Column:
        return F.when(F.col("total_records") > 0, value).otherwise(F.lit(1.0))

    return row.select(
        "total_records", F.greatest(F.col("total_records") - F.col("_affected"), F.lit(0)).cast("bigint").alias("valid_records"),
        (F.col("critical_errors") + F.col("high_errors") + F.col("medium_errors") + F.col("low_errors")).alias("validation_errors"),
        "critical_errors", "high_errors", "medium_errors", "low_errors",
        guarded(1.0 - F.least(penalty / n, F.lit(0.1))).alias("quality_score"),
        guarded(F.col("_full") / n).alias("completeness_score"),
        guarded(F.greatest(1.0 - F.col("_cross") / n, F.lit(0.0))).alias("consistency_score"),
        guarded(F.greatest(1.0 - F.col("_temporal") / n, F.lit(0.0))).alias("temporal_score"),
        *(["quality_flags"] if "quality_flags" in row.columns else []))


def quality_metrics(results: DataFrame, df: DataFrame, key="channel", t="week", flag="data_quality_flag") -> DataFrame:
    """Totals, four scores, errors by severity and flag distribution from any results and panel.

    Empty input scores 1. ``validate`` returns the same row from its single pass.
    """
    failed = ~F.col("passed")

    def affected(*names: str) -> Column:
        cond = failed & F.col("rule_name").isin(*names) if names else failed
        return F.coalesce(F.sum(F.when(cond, F.col("affected_records"))), F.lit(0)).cast("bigint")

    per_rule = results.agg(
        *[F.count_if(failed & (F.col("severity") == s)).alias(f"{s}_errors") for s in SEVERITIES],
        affected().alias("_affected"), affected("cross_source_consistency").alias("_cross"),
        affected("weekly_granularity", "date_range").alias("_temporal"))
    full = F.lit(True)
    for c in (key, t, "views", "subs"):
        full = full & F.col(c).isNotNull()
    frames = [per_rule, df.agg(F.count(F.lit(1)).alias("total_records"), F.count_if(full).alias("_full"))]
    if flag in df.columns:
        per_flag = df.groupBy(F.coalesce(F.col(flag), F.lit("")).alias("f")).agg(F.count(F.lit(1)).alias("n"))
        frames.append(per_flag.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("f", "n")))).alias("quality_flags")))
    return _scores(one_row(*frames))


# fixed values: recommendation texts
RECOMMEND_CRITICAL = "CRITICAL: Address missing required fields and data type issues immediately"
RECOMMEND_SCORE = "Overall data quality is below acceptable threshold. Consider data cleaning."
RECOMMEND_JUNCTION = "Junction point validation failed. Review data source transitions for continuity."
RECOMMEND_WEEKLY = "Weekly granularity violations detected. Consider temporal data normalization."
RECOMMEND_NONE = "Data quality meets acceptable standards."


def _triggers() -> list[Column]:
    failed = ~F.col("passed")

    def any_failed(cond: Column) -> Column:
        return F.coalesce(F.bool_or(failed & cond), F.lit(False))

    return [any_failed(F.col("severity") == "critical").alias("_c"), any_failed(F.col("rule_name") == "junction_continuity").alias("_j"),
            any_failed(F.col("rule_name") == "weekly_granularity").alias("_w")]


def _texts(score: Column) -> Column:
    texts = S.messages((F.col("_c"), RECOMMEND_CRITICAL), (score < 0.7, RECOMMEND_SCORE),
                       (F.col("_j"), RECOMMEND_JUNCTION), (F.col("_w"), RECOMMEND_WEEKLY))
    return F.when(F.size(texts) == 0, F.array(F.lit(RECOMMEND_NONE))).otherwise(texts)


def recommendations(metrics: DataFrame, results: DataFrame) -> DataFrame:
    """One row with the array of texts whose condition holds."""
    row = one_row(results.agg(*_triggers()), metrics.select("quality_score"))
    return row.select(_texts(F.col("quality_score")).alias("recommendations"))


def validation_report(results: DataFrame, metrics: DataFrame) -> DataFrame:
    """Nested one-row report: summary, metrics, rule results (a fixed handful), recommendations."""
    summary = results.agg(
        F.struct(F.count(F.lit(1)).alias("total_rules_checked"), F.count_if("passed").alias("rules_passed"),
                 F.count_if(~F.col("passed")).alias("rules_failed"),
                 F.coalesce(F.sum(F.when(~F.col("passed"), F.col("affected_records"))), F.lit(0)).alias("total_records_affected"),
                 ).alias("validation_summary"),
        F.sort_array(F.collect_list(F.struct("rule_name", "severity", "passed", "message", "affected_records", "affected_channels"))
                     ).alias("validation_results"), *_triggers())
    scores = metrics.select(F.struct(*[c for c in metrics.columns if c != "quality_flags"]).alias("quality_metrics"),
                            *(["quality_flags"] if "quality_flags" in metrics.columns else []))
    row = one_row(summary, scores).withColumn("recommendations", _texts(F.col("quality_metrics.quality_score")))
    return row.drop("_c", "_j", "_w")


# fixed values: hours a source may lag before it counts as stale
FRESH_HOURS = {"API": 24.0, "FINAL_API": 24.0, "VIEWSTATS": 72.0}
POOR_HOURS = 48.0
DECAY_HOURS = 168.0


def freshness_score(age_hours: Column, limit: Column) -> Column:
    """1 within the limit, falling linearly to 0 at seven days."""
    decay = 1.0 - (age_hours - limit) / (F.lit(DECAY_HOURS) - limit)
    return F.when(age_hours <= limit, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), decay)))


def freshness(df: DataFrame, as_of, key="channel", t="week", source="collection_source") -> DataFrame:
    """Age of each entity's newest row against the limit of its source. Archive sources are
    historical and have no limit; their score is null."""
    best = df.groupBy(key).agg(F.max(F.struct(F.col(t).alias("t"), F.col(source).alias("s"))).alias("b"))
    limit = rank_of(F.col("b.s"), FRESH_HOURS, -1.0)
    age = F.datediff(F.lit(as_of).cast("date"), F.col("b.t").cast("date")) * F.lit(24.0)
    rows = best.select(key, F.col("b.t").alias("last_week"), F.col("b.s").alias("source"), age.alias("age_hours"),
                       F.when(limit >= 0, limit).alias("limit_hours"))
    return rows.withColumns({
        "freshness_score": F.when(F.col("limit_hours").isNotNull(), freshness_score(F.col("age_hours"), F.col("limit_hours"))),
        "status": F.when(F.col("limit_hours").isNull(), F.lit("historical"))
        .when(F.col("age_hours") <= F.col("limit_hours"), F.lit("fresh"))
        .when(F.col("age_hours") > POOR_HOURS, F.lit("poor")).otherwise(F.lit("stale"))})


# fixed values: weights of the composite score
COMPOSITE = {"completeness": 0.25, "continuity": 0.30, "statistical": 0.20, "temporal": 0.15, "freshness": 0.10}


def composite_score(df: DataFrame, as_of, junctions: list[Junction], window_days: int = 14, fields=("views", "subs", "category", "videos"),
                    key="channel", t="week", source="collection_source") -> DataFrame:
    """Weighted score per entity and its grade; one exchange, one aggregate.

    completeness: mean share of non-null required fields; continuity: share of junctions without
    a broken step; statistical: share of rows that are no outlier; temporal: share of rows on
    the weekly rhythm; freshness: age of the newest row (archive sources count as API).
    """
    rows = W.weekly_granularity(df, key=key, t=t)
    rows = W.zscore_outliers(rows, ["delta_views", "delta_subs"], key=key, flag=None)
    rows = W.iqr_outliers(rows, ["delta_views", "delta_subs"], key=key, flag=None)
    rows = J.junction_steps(rows, junctions, window_days, key, t)
    filled = sum((_int(F.col(f).isNotNull()) for f in fields), F.lit(0)) / F.lit(float(len(fields)))
    outlier = (F.col("delta_views_z_outlier") | F.col("delta_subs_z_outlier") | F.col("delta_views_iqr_outlier")
               | F.col("delta_subs_iqr_outlier"))
    n = F.count(F.lit(1)).cast("double")
    last = F.max(F.struct(F.col(t).alias("t"), F.col(source).alias("s")))
    passed = sum((_int(F.max(f"{j.name}_hits") == 0) for j in junctions), F.lit(0)) / F.lit(float(max(len(junctions), 1)))
    per = rows.groupBy(key).agg(
        F.avg(filled).alias("completeness"), passed.alias("continuity"), (1.0 - F.count_if(outlier) / n).alias("statistical"),
        (1.0 - F.count_if("off_rhythm") / n).alias("temporal"), last.alias("_last"))
    age = F.datediff(F.lit(as_of).cast("date"), F.col("_last.t").cast("date")) * F.lit(24.0)
    per = per.withColumn("freshness", freshness_score(age, rank_of(F.col("_last.s"), FRESH_HOURS, 24.0))).drop("_last")
    score = sum((F.col(name) * w for name, w in COMPOSITE.items()), F.lit(0.0))
    return per.withColumn("score", score).withColumn("grade", S.grade("score"))


def resolve_conflicts(obs: DataFrame, mode: str = "precedence", metrics=("views", "subs"), key="channel", t="week",
                      source="collection_source", interpolated: str | None = None) -> DataFrame:
    """One value per entity and week when several sources report it.

    ``precedence`` takes the highest ranked source whole; ``weighted`` averages by source weight.
    Both are plain aggregates with map-side combining.
    """
    made = F.coalesce(F.col(interpolated), F.lit(False)) if interpolated else F.lit(False)
    if mode == "precedence":
        rank = F.when(made, F.lit(0)).otherwise(rank_of(source, SOURCE_RANK))
        return pick_best(obs.select(key, t, source, *metrics, *([interpolated] if interpolated else [])), [key, t],
                         [rank] + [F.col(m) for m in metrics])
    if mode != "weighted":
        raise ValueError("mode must be precedence or weighted")
    w = F.when(made, F.lit(INTERPOLATED_WEIGHT)).otherwise(rank_of(source, SOURCE_WEIGHT, 1.0))
    # one row per source and week first: the mean within a source, then across sources
    per = obs.withColumn("_w", w).groupBy(key, t, source).agg(F.max("_w").alias("_w"), *[F.avg(m).alias(m) for m in metrics])
    return per.groupBy(key, t).agg(
        F.count(F.lit(1)).alias("sources"),
        *[(F.sum(F.col(m) * F.col("_w")) / F.sum(F.when(F.col(m).isNotNull(), F.col("_w")))).alias(m) for m in metrics])


def phase_gate(stats: DataFrame, success: float = 0.90, error: float = 0.05, critical: float = 0.15) -> DataFrame:
    """pass / warn / halt from the shares of successful and failed entities of a phase."""
    rate = F.when(F.col("channels_processed") > 0, F.col("channels_successful") / F.col("channels_processed").cast("double")
                  ).otherwise(F.lit(1.0))
    rows = stats.withColumn("error_rate", 1.0 - rate)
    return rows.withColumn("gate", F.when(F.col("error_rate") >= critical, F.lit("halt"))
                           .when((rate >= success) & (F.col("error_rate") <= error), F.lit("pass")).otherwise(F.lit("warn")))


def alerts(metrics: DataFrame) -> DataFrame:
    """Alert rows raised by a one-row metrics frame.

    Reads ``error_rate``, ``flagged_share``, ``junction_failures``, ``quality_score`` and
    ``success_rate`` (a share), each optional.
    """
    # fixed values: alert name, severity, column, condition
    checks = [
        ("junction_validation_failure", "CRITICAL", "junction_failures", lambda c: c > 0),
        ("error_rate", "HIGH", "error_rate", lambda c: c > 0.10),
        ("quality_flags", "MEDIUM", "flagged_share", lambda c: c > 0.05),
        ("quality_score", "MEDIUM", "quality_score", lambda c: c < 0.90),
        ("success_rate", "LOW", "success_rate", lambda c: c >= 0.90),
    ]
    rows = [F.struct(F.lit(name).alias("alert"), F.lit(sev).alias("severity"), F.col(c).cast("double").alias("value"),
                     F.coalesce(cond(F.col(c)), F.lit(False)).alias("raised"))
            for name, sev, c, cond in checks if c in metrics.columns]
    return metrics.select(F.explode(F.array(*rows)).alias("r")).select("r.*").filter("raised").drop("raised")


def data_flags(df: DataFrame, as_of, max_age_days: int = 7, t="week", interpolated: str = "interpolated",
               flag="data_quality_flag") -> DataFrame:
    """State of each row, most serious first."""
    critical = F.col("views").isNull() & F.col("subs").isNull()
    partial = F.col("views").isNull() | F.col("subs").isNull() | F.col("videos").isNull()
    invalid = (F.col("views") < 0) | (F.col("subs") < 0) | (F.col("videos") < 0)
    made = F.coalesce(F.col(interpolated), F.lit(False)) if interpolated in df.columns else F.lit(False)
    old = F.datediff(F.lit(as_of).cast("date"), F.col(t)) > max_age_days
    return df.withColumn("data_flag", F.when(critical, F.lit("MISSING")).when(invalid, F.lit("INVALID"))
                         .when(partial, F.lit("PARTIAL")).when(made, F.lit("INTERPOLATED"))
                         .when(F.col(flag).isin("fair", "poor", "missing"), F.lit("SUSPICIOUS"))
                         .when(old, F.lit("OUTDATED")).otherwise(F.lit("COMPLETE")))


def impute(spine: DataFrame, metric: str = "views", max_gap_days: int = 14, key="channel", t="week",
           category="category") -> DataFrame:
    """Fill a metric on a dense spine: own history inside the gap limit, else the last own value
    grown by the category's median growth of the week; with a confidence.

    Observed 1.0, history 0.8, peers 0.5. Rows before an entity's first value stay null (0.0).
    """
    past = W.ordered(key, t).rowsBetween(Window.unboundedPreceding, -1)
    point = F.when(F.col(metric).isNotNull(), F.struct(F.col(t).alias("t"), F.col(metric).alias("v")))
    # written once: read for the peers' medians and for the filling
    rows = cut_lineage(spine.withColumn("_last", F.last(point, ignorenulls=True).over(past)))
    grown = rows.filter(F.col(metric).isNotNull() & (F.col("_last.v") > 0)).select(
        key, category, t, ((F.col(metric) - F.col("_last.v")) / F.col("_last.v").cast("double")).alias("_g"))
    medians = exact_quantile(grown, [category, t], "_g", 0.5, "_peer", spread=[key])
    rows = rows.join(medians, [category, t], "left")
    near = F.datediff(F.col(t), F.col("_last.t")) <= max_gap_days
    seen, has = F.col(metric).isNotNull(), F.col("_last").isNotNull()
    return rows.select(
        key, category, t,
        F.when(seen, F.col(metric)).when(has & near, F.col("_last.v"))
        .when(has, (F.col("_last.v") * (1.0 + F.coalesce("_peer", F.lit(0.0)))).cast("bigint")).alias(metric),
        F.when(seen, F.lit("observed")).when(has & near, F.lit("history")).when(has, F.lit("peers"))
        .otherwise(F.lit("none")).alias("method"),
        F.when(seen, F.lit(1.0)).when(has & near, F.lit(0.8)).when(has, F.lit(0.5)).otherwise(F.lit(0.0)).alias("confidence"))


def manual_review(df: DataFrame, junctions: list[Junction], max_variance: float = 15.0, window_days: int = 14, tol: float = 0.0,
                  key="channel", t="week") -> DataFrame:
    """Rows to review with their reasons: junction variance, outlier, negative growth."""
    js = [Junction(j.name, j.day, max_variance) for j in junctions]
    rows = J.junction_steps(df, js, window_days, key, t)
    rows = W.iqr_outliers(rows, ["delta_views", "delta_subs"], key=key, flag=None)
    p = W.prev("subs", key, t)
    rows = rows.withColumn("_neg", F.coalesce((p > 0) & (F.col("subs") < p * F.lit(1.0 - tol)), F.lit(False)))
    broken = sum((F.col(f"{j.name}_hits") for j in js), F.lit(0)) > 0
    reasons = S.messages((broken, "junction_variance"),
                         (F.col("delta_views_iqr_outlier") | F.col("delta_subs_iqr_outlier"), "outlier"),
                         (F.col("_neg"), "negative_growth"))
    return rows.select(key, t, reasons.alias("reasons")).filter(F.size("reasons") > 0)


def dimension_gate(df: DataFrame, as_of, key="channel", t="week", source="collection_source") -> DataFrame:
    """Completeness, accuracy, consistency and timeliness of the whole panel against their limits."""
    rows = W.cross_source_consistency(df, key=key, t=t, source=source, flag="")
    fields = (key, t, "views", "subs")
    filled = sum((_int(F.col(f).isNotNull()) for f in fields), F.lit(0)) / F.lit(float(len(fields)))
    proper = ((F.dayofweek(F.col(t)) == 1) & (F.col("views") >= 0) & (F.col("subs") >= 0) & (F.col("videos") >= 0))
    n = F.count(F.lit(1))
    age = F.datediff(F.lit(as_of).cast("date"), F.max(t)) * F.lit(24.0)
    one = rows.agg(F.coalesce(F.avg(filled), F.lit(1.0)).alias("completeness"),
                   F.coalesce(F.avg("consistency_score"), F.lit(1.0)).alias("accuracy"),
                   F.when(n > 0, F.count_if(proper) / n.cast("double")).otherwise(F.lit(1.0)).alias("consistency"),
                   age.alias("timeliness"))
    # fixed values: dimension, limit, criticality
    limits = [("completeness", 0.95, "high"), ("accuracy", 0.90, "high"), ("consistency", 0.98, "medium"),
              ("timeliness", 24.0, "medium")]
    rows = F.explode(F.array(*[F.struct(
        F.lit(d).alias("dimension"), F.col(d).cast("double").alias("value"), F.lit(limit).alias("threshold"),
        F.lit(c).alias("criticality"),
        F.coalesce((F.col(d) <= limit) if d == "timeliness" else (F.col(d) >= limit), F.lit(False)).alias("passed"))
        for d, limit, c in limits]))
    return one.select(rows.alias("r")).select("r.*")
