"""Hand-written edge rows: empty and single-row panels, ties, nulls, borders of limits."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from weekloom.functions import scalars as S
from weekloom.operators import aggregates as A, joins as J, quality as Q, ranking as R, series, setops, windows as W
from weekloom.operators.junctions import Junction, junction_regression

PANEL = "channel string, week date, views bigint, subs bigint, videos bigint, collection_source string, data_quality_flag string, category string"
OBS = "channel string, obs_date date, upload_count bigint"


def panel(spark, rows):
    return spark.createDataFrame([(k, w, v, s, n, "API", "good", "x") for k, w, v, s, n in rows], PANEL)


def one(spark, expr, schema="x string", value=None):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first().r


@pytest.mark.parametrize("text,want", [("17.8M", 17_800_000), ("4.16B", 4_160_000_000), ("1,645", 1645), ("", None), ("abc", None),
                                       ("1.2.3", None), ("8.2k", 8200), ("0.0015K", 1), (None, None)])
def test_compact_number(spark, text, want):
    assert one(spark, S.parse_compact_number("x"), value=text) == want


@pytest.mark.parametrize("text,want", [("2020-01-05", date(2020, 1, 5)), ("1/5/2020", date(2020, 1, 5)), ("25/1/2020", date(2020, 1, 25)),
                                       ("20200105", date(2020, 1, 5)), ("Jan 5 2020", date(2020, 1, 5)), ("January 5, 2020", date(2020, 1, 5)),
                                       ("1567296000000", date(2019, 9, 1)), ("1567296000", date(2019, 9, 1)), ("99/99/2020", None), ("", None),
                                       ("1000000000", None)])
def test_flexible_date(spark, text, want):
    assert one(spark, S.parse_flexible_date("x"), value=text) == want


@pytest.mark.parametrize("text,want", [("12.7", 12), ("-3", -3), ("n/a", 0), (None, 0), ("NaN", 0), ("9223372036854775807", 2**63 - 1)])
def test_numeric_or_zero(spark, text, want):
    assert one(spark, S.numeric_or_zero("x"), value=text) == want


def test_week_borders(spark):
    rows = spark.sql("SELECT timestamp'2020-01-04 23:59:59' AS a, timestamp'2020-01-05 00:00:00' AS b")
    r = rows.select(S.week_start_sunday("a").alias("a"), S.week_start_sunday("b").alias("b")).first()
    assert (r.a, r.b) == (date(2019, 12, 29), date(2020, 1, 5))


def test_stable_week(spark):
    days = spark.createDataFrame([(date(2020, 1, 7),), (date(2020, 1, 8),)], "d date")
    assert [r.w for r in days.orderBy("d").select(S.stable_week("d").alias("w")).collect()] == [date(2019, 12, 29), date(2020, 1, 5)]


def test_flags_are_sets(spark):
    df = spark.createDataFrame([(["a"],), (None,)], "f array<string>")
    yes = F.lit(True)
    assert [r.f for r in df.select(S.flag_add(S.flag_add("f", "b", yes), "b", yes).alias("f")).collect()] == [["a", "b"], ["b"]]
    assert [r.f for r in df.select(S.flag_remove("f", "a", yes).alias("f")).collect()] == [[], []]


def test_empty_panel(spark):
    empty = W.deltas(panel(spark, []))
    flagged, results, metrics = Q.validate(empty, junctions=[Junction("j", date(2020, 1, 5), 10.0)])
    m = metrics.first()
    assert flagged.count() == 0 and (m.quality_score, m.completeness_score, m.temporal_score, m.total_records) == (1.0, 1.0, 1.0, 0)
    assert all(r.passed and r.affected_records == 0 for r in results.collect())
    assert A.dataset_summary(empty).first().total_records == 0
    assert A.collection_report(spark.createDataFrame([], "processing_status string, status string")).first().success_rate == 0.0


def test_missing_critical_column_raises(spark):
    with pytest.raises(Q.SchemaError):
        Q.schema_check(spark.createDataFrame([("a", "1")], "channel string, views string"))
    with pytest.raises(Q.SchemaError):
        Q.validate(spark.createDataFrame([("a", 1)], "channel string, views bigint"))


def test_single_row_and_constant_series(spark):
    rows = [("one", date(2020, 1, 5), 5, 5, 5)] + [("flat", date(2020, 1, 5 + 7 * i), 9, 9, 9) for i in range(3)]
    rows += [("flat", date(2020, 2, 2), 9, 9, 9)]
    p = W.deltas(panel(spark, rows))
    assert p.filter("channel = 'one'").first().delta_views == 0
    assert W.zscore_outliers(p).filter("delta_views_z_outlier").count() == 0
    assert W.growth_limits(p).filter("sub_growth_hit OR view_growth_hit OR upload_hit").count() == 0
    assert A.metric_correlation(p).filter("correlation IS NOT NULL").count() == 0
    assert A.variation(p, date(2020, 1, 1), date(2020, 12, 31)).filter("channel = 'one' AND cv IS NOT NULL").count() == 0
    assert W.trend_deviation(p).filter("channel = 'one' AND trend_outlier").count() == 0
    assert W.rolling_growth(p).filter("growth_outlier").count() == 0
    assert W.winsorize(p).count() == 5 and W.winsorize(p, "median").count() == 5
    before = junction_regression(p, date(2020, 1, 12)).filter("channel = 'flat'").count()
    assert before == 0      # one earlier row fits no line


def test_interpolation_gap_of_14_and_15_days(spark):
    obs = spark.createDataFrame([("a", date(2020, 1, 1), 10), ("a", date(2020, 1, 15), 20), ("a", date(2020, 1, 30), 30),
                                 ("a", date(2020, 3, 30), 12)], OBS)
    made = [(r.obs_date, r.upload_count) for r in series.interpolate_weekly(obs).filter("interpolated").orderBy("obs_date").collect()]
    # 14 days: none; 15 days: one; 60 days: seven, never below the left value
    assert made[0] == (date(2020, 1, 22), 25) and len(made) == 8 and all(v == 30 for _, v in made[1:])
    capped = series.interpolate_weekly(obs, max_gap_days=30).filter("interpolated").count()
    assert capped == 1


def test_extrapolation_needs_gap_and_growth(spark):
    obs = spark.createDataFrame([("a", date(2020, 1, 1), 10), ("b", date(2020, 1, 1), 10), ("c", date(2020, 3, 20), 10)], OBS)
    cur = spark.createDataFrame([("a", 40), ("b", 10), ("c", 99)], "channel string, current_count bigint")
    out = series.extrapolate_to_current(obs, cur, date(2020, 3, 31)).orderBy("obs_date").collect()
    # 90 days: day 30 and 60; the 90th day is the current point itself
    assert [(r.channel, r.obs_date, r.upload_count, r.interpolated) for r in out] == [
        ("a", date(2020, 1, 31), 20, True), ("a", date(2020, 3, 1), 30, True), ("a", date(2020, 3, 31), 40, False)]


def test_nearest_join_tie_and_limit(spark):
    left = spark.createDataFrame([("a", date(2020, 1, 10)), ("a", date(2020, 3, 10)), ("b", date(2020, 1, 1))], "channel string, t date")
    right = spark.createDataFrame([("a", date(2020, 1, 8), 1), ("a", date(2020, 1, 12), 2), ("a", date(2020, 2, 11), 3)], "channel string, t date, v bigint")
    got = {(r.channel, r.t): r.v for r in J.nearest_join(left, right, "v").collect()}
    assert got == {("a", date(2020, 1, 10)): 1, ("a", date(2020, 3, 10)): 3, ("b", date(2020, 1, 1)): 0}


def test_dedup_ties(spark):
    rows = [("a", date(2020, 1, 6), 1, 1, 1, "VIEWSTATS", "good", "x"), ("a", date(2020, 1, 7), 9, 1, 1, "WAYBACK_CHARTS", "good", "x"),
            ("a", date(2020, 1, 8), 99, 1, 1, "API", "fair", "x")]
    out = R.dedup_weekly(spark.createDataFrame(rows, PANEL.replace("week", "datetime"))).collect()
    assert len(out) == 1 and out[0].collection_source == "VIEWSTATS" and out[0].week == date(2020, 1, 5)


def test_coverage_without_expected_weeks(spark):
    p = panel(spark, [("a", date(2020, 1, 5), 1, 1, 1)])
    assert A.entity_coverage(p, 0).first().coverage == 0.0
    assert A.entity_coverage(p, 1).first().mean_grade == 4.0


def test_preservation_counts_copies(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    after = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    got = {(r.k, r.change, r.copies) for r in setops.preservation_check(df, after, ["k", "v"]).collect()}
    assert got == {("a", "lost", 1), ("c", "added", 1)}


def test_rule_registry(spark):
    from pyspark.sql.functions import col, when

    rule = Q.Rule("odd_views", "custom", "low", "basic", lambda df, p, ctx: (df, when(col("views") % p["of"] == 1, 1).otherwise(0), None),
                  "odd view counts", {"of": 2})
    Q.register(rule)
    try:
        p = W.deltas(panel(spark, [("a", date(2020, 1, 5), 1, 1, 1), ("a", date(2020, 1, 12), 2, 1, 1)]))
        got = {r.rule_name: r.affected_records for r in Q.validate(p, "basic")[1].collect()}
        assert got["odd_views"] == 1
        assert "odd_views" not in {r.name for r in Q.select_rules("basic", {"odd_views": {"enabled": False}})}
    finally:
        Q.REGISTRY.pop("odd_views")


def test_materialized_validation_agrees(spark):
    p = W.deltas(panel(spark, [("a", date(2020, 1, 5 + 7 * i), 10 ** i, 1, 1) for i in range(4)]))
    plain, kept = Q.validate(p), Q.validate(p, materialize=True)
    for a, b in zip(plain, kept):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_repeated_right_sides_do_not_multiply(spark):
    from weekloom.operators import joins, series
    left = spark.createDataFrame([("a", "x", date(2020, 1, 5), 5, 6)], "channel string, category string, week date, subs bigint, views bigint")
    twice = spark.createDataFrame([("a", "n1", "c1", "k1", 7, 8, 20), ("a", "n2", "c2", "k2", 9, 8, 30)],
                                  "channel string, channel_name string, category string, legacy_key string, current_subs bigint, current_views bigint, current_count bigint")
    got = joins.attach_metadata(left, twice).collect()
    assert [(r.channel_name, r.category) for r in got] == [("n2", "c2")]
    assert [r.source_key for r in joins.resolve_source_key(left.withColumn("handle", F.lit("@h")), twice).collect()] == ["k2"]
    assert joins.reconcile_current(left, twice).count() == 1
    assert joins.point_to_point_growth(left, twice, "2020-01-05", "2020-01-05").count() == 1
    obs = spark.createDataFrame([("a", date(2020, 1, 1), 3)], OBS)
    assert series.extrapolate_to_current(obs, twice, "2020-02-10").filter("NOT interpolated").count() == 1


@pytest.mark.parametrize("fmt", ["parquet", "tsv", "json"])
def test_publish_reads_what_it_wrote(spark, tmp_path, fmt):
    from weekloom.plans.panel import publish
    rows = panel(spark, [("a", date(2020, 1, 5), 1, 2, 3), ("b", date(2021, 1, 3), 4, 5, 6)]).withColumn("datetime", F.col("week").cast("timestamp"))
    counts = publish(rows, str(tmp_path / fmt), fmt, t="datetime").collect()
    assert sum(r["count"] if "count" in r.asDict() else r.n for r in counts) == 2


def test_late_rows_of_a_stream(spark, tmp_path):
    """Several micro-batches: late rows go to the side output, and both outputs together are the input."""
    from weekloom.streaming import observations as SO
    days = [date(2020, 1, 1), date(2020, 2, 1), date(2020, 1, 2), date(2020, 1, 31), date(2020, 3, 1), date(2020, 2, 1)]
    for i, d in enumerate(days):
        spark.createDataFrame([(i, d)], "n long, obs_date date").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("n long, obs_date date").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    SO.stream_late(stream, str(tmp_path / "good"), str(tmp_path / "late"), str(tmp_path / "ckpt")).awaitTermination()
    good = {r.n for r in spark.read.schema("n long, obs_date date").parquet(str(tmp_path / "good/data")).collect()}
    late = {r.n for r in spark.read.schema("n long, obs_date date").parquet(str(tmp_path / "late")).collect()}
    assert (good, late) == ({0, 1, 3, 4}, {2, 5})


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_quantile_of_small_and_large_groups(spark, p):
    from weekloom.operators.quantiles import exact_quantile
    df = spark.range(31_000).selectExpr("CASE WHEN id < 7 THEN CAST(id % 3 AS STRING) ELSE 'big' END AS k", "CAST(pmod(id * 7919, 10007) AS DOUBLE) AS v")
    want = {r.k: r.q for r in df.groupBy("k").agg(F.percentile("v", p).alias("q")).collect()}
    got = {r.k: r.quantile for r in exact_quantile(df, ["k"], "v", p).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_schema_rules(spark):
    rows = [("a", date(2020, 1, 5), "5", 6), ("a", date(2020, 1, 5), "n/a", 6), ("a", date(2020, 1, 12), None, 7)]
    df = spark.createDataFrame(rows, "channel string, week date, videos string, subs bigint").withColumn("views", F.col("subs"))
    got = {r.rule_name: (r.passed, r.affected_records) for r in Q.validate(df, "basic", [])[1].collect()}
    assert got["required_fields"] == (False, 3) and got["data_types"] == (False, 1) and got["unique_weeks"] == (False, 1)
    assert got["important_completeness"] == (False, 4)      # category in every row, videos in one


def test_repeated_weeks_are_reduced_first(spark):
    """A hot entity that repeats its weeks: the checked panel has one row a week, the repeats are counted, results equal those of the reduced panel."""
    rows = [("hot", date(2020, 1, 5 + 7 * (i % 3)), 100 + i, 10 + i, "API", "good" if i % 5 else "excellent") for i in range(300)] + [("b", date(2020, 1, 5), 1, 1, "API", "good"), ("b", None, 1, 1, "API", "good"), (None, date(2020, 1, 5), 1, 1, "API", "good")]
    df = W.deltas(spark.createDataFrame(rows, "channel string, week date, views long, subs long, collection_source string, data_quality_flag string").withColumn("videos", F.lit(1).cast("long")))
    flagged, results, metrics = Q.validate(df, "comprehensive", reduce=True)
    assert flagged.columns == df.columns and flagged.count() == 6
    hot = sorted((r.week, r.views, r.data_quality_flag) for r in flagged.filter("channel = 'hot'").collect())
    assert len(hot) == 3 and {r[2] for r in hot} <= {"excellent", "fair"}
    found = {r.rule_name: (r.affected_records, r.affected_channels) for r in results.collect()}
    assert found["unique_weeks"] == (297, 1) and metrics.first().total_records == 6
    once = {r.rule_name: r.affected_records for r in Q.validate(Q.reduced_weeks(df).drop(Q.COPIES), "comprehensive")[1].collect()}
    assert {n: v[0] for n, v in found.items() if n != "unique_weeks"} == {n: v for n, v in once.items() if n != "unique_weeks"}
