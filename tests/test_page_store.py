"""Pages are fetched where they lie; key filters grow with their keys."""

import re

import pytest
from pyspark.sql import functions as F

from checks import fixtures as X
from weekloom import plans
from weekloom.functions.key_filter import MOST_BITS, filter_bits, key_filter
from weekloom.sources import fetch_pages, open_page_store, write_page_store


def pages(spark, n=2000):
    return spark.range(n).select(F.concat(F.lit("c"), F.col("id") % 40).alias("channel"), F.format_string("2001%010d", "id").alias("snapshot_ts"),
                                 F.lit("u").alias("url"), F.concat(F.lit("<p>"), F.repeat(F.col("id").cast("string"), 30)).alias("html"))


def moved(df) -> list[str]:
    """Columns of every exchange of a plan."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return [m.group(1) for m in re.finditer(r"\) (?:Broadcast)?Exchange\nInput \[\d+\]: \[(.*?)\]\n", text, re.S)]


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store"))
    write_page_store(pages(spark), path + "/s", buckets=6)
    return path + "/s"


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_no_exchange_carries_html(spark, store, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        opened = open_page_store(spark, store)
        for n in (0, 1, 700, 2000):
            picks = pages(spark).filter(F.substring("snapshot_ts", 5, 10).cast("int") < n).select("channel", "snapshot_ts")
            got = opened.fetch(picks.unionByName(picks))
            columns = moved(got)
            assert columns and not any("html" in c for c in columns)
            assert got.count() == n and got.select("html").distinct().count() == n
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_plans_move_no_html(spark, store):
    index = pages(spark).select("channel", F.col("snapshot_ts").alias("timestamp"), F.lit("200").alias("statuscode"), F.lit("o").alias("original"), F.lit("d").alias("digest"))
    opened = open_page_store(spark, store)
    charts = plans.pages_to_observations(index, opened, X.INDEX_END, n=None)
    uploads = plans.uploads_to_observations(index, opened, spark.createDataFrame([("c1", 5)], "channel string, current_count long"), X.AS_OF)
    for out in (*charts.values(), *uploads.values()):
        assert not any("html" in c for c in moved(out))


def test_store_in_a_new_catalog_and_appended(spark, store):
    opened = open_page_store(spark, store)
    name = re.search(r"page_store_[0-9a-f]{32}", opened.pages._jdf.queryExecution().toString()).group(0)
    spark.sql(f"DROP TABLE {name}")
    again = open_page_store(spark, store)
    picks = pages(spark, 10).select("channel", "snapshot_ts")
    assert again.buckets == 6 and again.fetch(picks).count() == 10 and not any("html" in c for c in moved(again.fetch(picks)))
    more = write_page_store(pages(spark, 5).withColumn("channel", F.lit("new")), store, mode="append")
    assert more.fetch(spark.createDataFrame([("new", "20010000000003"), (None, "20010000000003")], "channel string, snapshot_ts string")).count() == 1
    assert more.pages.count() == 2005


def test_store_without_layout_is_refused(spark, tmp_path):
    with pytest.raises(Exception, match="layout"):
        open_page_store(spark, str(tmp_path))
    with pytest.raises(ValueError, match="missing"):
        write_page_store(pages(spark).drop("snapshot_ts"), str(tmp_path / "x"))


def test_frames_are_filtered_before_their_shuffle(spark):
    some = pages(spark).withColumn("__piece", F.lit(1))
    picks = pages(spark, 90).select("channel", "snapshot_ts")
    got = fetch_pages(some, picks.unionByName(picks))
    assert got.count() == 90 and got.columns == some.columns
    text = got._jdf.queryExecution().optimizedPlan().toString()
    # the filter's join lies below the join with the choice, on the side of the pages
    assert re.search(r"Join Inner, \(\(channel.*Join Inner, \(?\(?.*__piece", text, re.S)


@pytest.mark.parametrize("n", [0, 1, 5000, 40000])
def test_key_filter(spark, n):
    keys = spark.range(n).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, None).otherwise("x").alias("s"))
    made = key_filter(keys, "k", "s")
    every = spark.range(100000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, None).otherwise("x").alias("s"))
    passed = made.passes(every, "k", "s")
    assert passed.filter(F.col("k") < n).count() == n
    assert passed.filter(F.col("k") >= n).count() <= 0.08 * (100000 - n)
    # the filter grows with its keys, its broadcast has a bound
    assert made.pieces.count() <= 2 ** (made.bits - 15) and (n == 0 or 2 ** made.bits >= 16 * n)


def test_filter_bits():
    assert [filter_bits(n) for n in (0, 1, 2048, 2049, 1 << 20, 1 << 40)] == [15, 15, 15, 16, 24, MOST_BITS]
