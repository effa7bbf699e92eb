"""Shapes of physical plans."""

import re

import pytest

from checks import fixtures as X
from checks.q_streams import _stream  # noqa: F401  (import check)
from weekloom.operators import joins as J, junctions, projections, quality as Q, ranking as R, windows as W
from weekloom.sources import read_panel, write_panel

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("panel"))
    X.full_panel(spark, SF).withColumn("datetime", X.F.col("week").cast("timestamp")).drop("week").write.mode("overwrite").parquet(path + "/p")
    return spark.read.parquet(path + "/p").withColumn("week", X.F.col("datetime").cast("date"))


def test_window_chain_shares_one_exchange(stored):
    df = W.deltas(stored)
    df = W.growth_rates(df)
    df = W.iqr_outliers(df)
    df = W.zscore_outliers(df)
    df = W.cross_source_consistency(df)
    df = junctions.flag_junctions(df, X.JUNCTIONS)
    assert exchanges(df) == 1


def test_validation_is_one_exchange_and_one_sort(stored):
    flagged, results, _ = Q.validate(stored, junctions=X.JUNCTIONS)
    assert exchanges(flagged) == 1 and exchanges(results) == 1


def test_dedup_combines_before_the_shuffle(stored):
    text = plan(R.dedup_weekly(stored.drop("week")))
    assert "partial_max" in text and "Window" not in text


def test_snapshots_limit_before_the_shuffle(spark):
    text = plan(R.top_snapshots(X.snapshot_index(spark, SF), X.INDEX_END))
    assert text.count("WindowGroupLimit") == 2


def test_growth_is_top_k_without_self_join(stored):
    text = plan(J.point_to_point_growth(stored, None, X.J1, X.J2))
    assert "TakeOrderedAndProject" in text and "Join" not in text


def test_range_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "panel")
    write_panel(X.full_panel(spark, SF).withColumn("datetime", X.F.col("week").cast("timestamp")), path)
    text = plan(read_panel(spark, path, "parquet", X.J1, X.J2).select("channel", "views", "datetime"))
    assert "PartitionFilters: [isnotnull(year" in text.replace("\n", "") or "year#" in text.split("PartitionFilters")[1][:120]
    assert "GreaterThanOrEqual(datetime" in text
    schema = text.split("ReadSchema: ")[1].split(">")[0]
    assert "delta_views" not in schema and "category" not in schema


def test_filter_range_pushes_down(spark):
    li = X.table(spark, SF, "lineitem")
    text = plan(projections.filter_range(li, X.J1, X.J2, "l_shipdate").select("l_suppkey"))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in text


def test_no_cross_joins_or_row_udfs(spark):
    import __spark_entry__ as entry

    for name in ("c5_dense_spine", "c8_nearest_join", "c10_overlap_compare", "c13_peer_deviation", "e20_interpolate_weekly", "i13_impute", "d1_dataset_summary"):
        text = plan(entry.queries()[name](spark, SF))
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert word not in text, (name, word)


def test_combined_series_is_one_pass(spark, tmp_path):
    from checks.q_pages import _dygraph
    from weekloom.operators import extract as E

    _dygraph(spark, SF).write.parquet(str(tmp_path / "points"))
    points = spark.read.parquet(str(tmp_path / "points"))
    text = plan(E.combine_series(points, E.pick_series(E.series_profile(points))))
    assert len(re.findall(r"Exchange hashpartitioning", text)) <= 6 and len(re.findall("Join", text)) == 1


def test_missing_runs_lay_no_weeks_out(spark):
    text = plan(J.missing_runs(X.panel(spark, SF), X.entities(spark, SF), *X.SPINE))
    assert "Generate" not in text and "sequence" not in text


def test_growth_medians_hold_no_group(spark):
    """No window orders the rows of a (category, week): windows are over buckets of counts."""
    text = plan(J.peer_deviation(X.panel(spark, SF)))
    for part in text.split("Window [")[1:]:
        assert "growth" not in part.split("\n")[0]


def test_panel_parts_follow_the_rows(spark, monkeypatch):
    """Windows over the panel work on parts of bounded rows, also where small shuffles are put together."""
    whole = X.panel(spark, SF)
    monkeypatch.setattr(X, "ITEMS_A_TASK", 1000, raising=False)
    cut = X.full_panel(spark, SF)
    items = X.table(spark, SF, "lineitem").count()
    # a panel too large to be broadcast
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert X.full_panel(spark, SF).rdd.getNumPartitions() == -(-items // 1000) > 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert whole.exceptAll(cut.select(whole.columns)).isEmpty() and whole.count() == cut.count()
