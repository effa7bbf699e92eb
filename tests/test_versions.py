"""Published versions, resumed runs, fingerprints."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weekloom import plans
from weekloom.operators import setops
from weekloom.sources import storage
from weekloom.sources import versions as V

PANEL = "channel string, week date, views bigint, subs bigint, collection_source string, data_quality_flag string"


def panel(spark, n, shift=0):
    return spark.range(n).select(F.concat(F.lit("c"), F.col("id") % 7).alias("channel"), F.date_add(F.lit("2020-01-05").cast("date"), (F.col("id") * 7).cast("int")).alias("week"),
                                 (F.col("id") + shift).alias("views"), F.col("id").alias("subs"), F.lit("API").alias("collection_source"), F.lit("good").alias("data_quality_flag"))


def test_lost_and_repeated_runs(spark, tmp_path):
    path = str(tmp_path / "p")
    assert V.current(spark, path) is None
    with pytest.raises(ValueError, match="nothing published"):
        V.read_version(spark, path)
    plans.publish(panel(spark, 20), path, run="one")
    first = V.current(spark, path)
    assert (first["number"], first["rows"]) == (0, 20) and first["fingerprint"] == setops.fingerprint(panel(spark, 20)).first().fingerprint
    broken = panel(spark, 50).withColumn("subs", F.when(F.col("subs") == 49, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("subs")))
    with pytest.raises(Exception, match="lost"):
        plans.publish(broken, path, run="two")
    assert V.current(spark, path) == first and V.read_version(spark, path).count() == 20
    plans.publish(panel(spark, 50), path, run="two")
    second = V.current(spark, path)
    assert (second["number"], second["run"], second["rows"]) == (1, "two", 50)
    # repeated: the version stays, whatever the run would write now
    plans.publish(panel(spark, 3), path, run="one")
    plans.publish(panel(spark, 3), path, run="two")
    assert V.current(spark, path) == second and len(V.manifests(spark, path)) == 2
    assert V.read_version(spark, path, "one").count() == 20
    assert V.remove_old_versions(spark, path, keep=1) == ["one"] and V.read_version(spark, path).count() == 50


@pytest.mark.parametrize("fmt", ["tsv", "json"])
def test_formats(spark, tmp_path, fmt):
    path = str(tmp_path / "p")
    V.publish_version(panel(spark, 9), path, "r", fmt)
    got = V.read_version(spark, path)
    assert got.dtypes == panel(spark, 9).dtypes and Counter(got.collect()) == Counter(panel(spark, 9).collect())


def test_files_appear_in_one_step(spark, tmp_path):
    path = str(tmp_path / "m" / "0.json")
    assert storage.put_new(spark, path, "a") and not storage.put_new(spark, path, "b")
    assert storage.read_text(spark, path) == "a" and [n for n in storage.names(spark, str(tmp_path / "m")) if not n.startswith(".")] == ["0.json"]


def test_parts_are_done_once(spark, tmp_path):
    seen = []

    def work(part):
        seen.append(1)
        if len(seen) == 2:
            raise RuntimeError("lost")
        return part.withColumn("n", F.lit(len(seen)))
    rows = panel(spark, 40).select("channel").distinct()
    with pytest.raises(RuntimeError):
        V.run_in_parts(rows, work, str(tmp_path), "r", 3)
    out = V.run_in_parts(rows, work, str(tmp_path), "r", 3)
    assert len(seen) == 4 and sorted(r.channel for r in out.collect()) == [f"c{i}" for i in range(7)]
    assert V.run_in_parts(rows, work, str(tmp_path), "r", 3).count() == 7 and len(seen) == 4


def rows_of(seed, n):
    rng = random.Random(seed)
    return [(rng.choice(["a", "b", None]), rng.choice([None, "x", "y"]), rng.randint(0, 4)) for _ in range(n)]


KINDS = "p string, q string, n int"


def test_preservation_against_counts(spark):
    for seed in range(4):
        a, b = rows_of(seed, 200), rows_of(seed, 200)[:190] + rows_of(seed + 50, 8)
        want = {(*r, "lost"): c for r, c in (Counter(a) - Counter(b)).items()} | {(*r, "added"): c for r, c in (Counter(b) - Counter(a)).items()}
        for by in (None, ["p"]):
            for bits in (1, 9, 16):
                got = setops.preservation_check(spark.createDataFrame(a, KINDS), spark.createDataFrame(b, KINDS), ["p", "q", "n"], by, bits=bits)
                assert {(r.p, r.q, r.n, r.change): r.copies for r in got.collect()} == want


def test_equal_inputs_shuffle_sums_only(spark, tmp_path):
    spark.createDataFrame(rows_of(1, 500), KINDS).write.parquet(str(tmp_path / "a"))
    a = spark.read.parquet(str(tmp_path / "a"))
    got = setops.preservation_check(a, a.repartition(3), ["p", "q", "n"])
    assert got.count() == 0
    got.collect()
    text = got._jdf.queryExecution().executedPlan().toString()
    final = text[: text.index("== Initial Plan ==")]
    # no range differs, so the comparison of rows is gone from the plan that ran
    assert "BroadcastHashJoin" not in final


def test_fingerprints_tell_places_of_nulls_and_copies(spark):
    def of(rows):
        return setops.fingerprint(spark.createDataFrame(rows, KINDS)).first().fingerprint
    assert of([("a", None, 1)]) != of([(None, "a", 1)])
    assert of([("a", "b", 1)] * 2) != of([("a", "b", 1)]) and of([]) == "0:0:0"
    assert of(rows_of(3, 50)) == of(list(reversed(rows_of(3, 50))))


def test_trees_find_the_changed_ranges(spark):
    a, b = rows_of(5, 300), rows_of(5, 300)
    b[7] = ("a", "new", 9)
    trees = [setops.fingerprint_tree(spark.createDataFrame(x, KINDS), ["p", "q", "n"], bits=12) for x in (a, b)]
    changed = setops.changed_ranges(*trees).collect()
    assert {r.level for r in changed} == {0, 1, 2} and len([r for r in changed if r.level == 2]) in (1, 2)
    assert setops.changed_ranges(trees[0], trees[0]).count() == 0
    assert trees[0].filter("level = 0").first().rows == 300
