"""The ordered history of a delta stream, and merging late rows into a stored panel."""

import random
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from weekloom.operators.windows import deltas
from weekloom.streaming import backfill as B
from weekloom.streaming.stateful import DeltaProcessor, PackedDeltas, stream_deltas

DAY = 86_400_000
EPOCH = date(1970, 1, 1)


class Weeks(dict):
    def iterator(self):
        return iter([(k, v) for k, v in self.items()])

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]


class Handle:
    def __init__(self):
        self.weeks, self.timers = Weeks(), set()

    def getMapState(self, *_):
        return self.weeks

    def listTimers(self):
        return iter(list(self.timers))

    def deleteTimer(self, t):
        self.timers.discard(t)

    def registerTimer(self, t):
        self.timers.add(t)


class Times:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def play(arrivals, lateness, horizon):
    """Rows out of the processor when (week, views) lists arrive one after the other; the watermark follows the newest week."""
    handle = Handle()
    p = DeltaProcessor(lateness, horizon)
    p.init(handle)
    watermark, out = 0, []

    def settle():
        while due := [t for t in handle.timers if t <= watermark]:
            for t in due:
                handle.timers.discard(t)
            out.extend(p.handleExpiredTimer(("c",), Times(watermark), None))
    for weeks in arrivals:
        seen = [(d, v) for d, v in weeks if (d - EPOCH).days * DAY > watermark or not watermark]
        if seen:
            out.extend(p.handleInputRows(("c",), iter([Row(week=d, views=v, subs=v) for d, v in seen]), Times(watermark)))
        watermark = max(watermark, max((d - EPOCH).days for d, _ in weeks) * DAY - horizon * DAY)
        settle()
    return out, handle


@pytest.mark.parametrize("seed", range(12))
def test_histories_end_as_the_batch(seed):
    rng = random.Random(seed)
    start = date(2020, 1, 5)
    weeks = [(start + timedelta(days=7 * i + (seed % 3 == 0) * rng.randint(0, 2)), rng.randint(0, 1000)) for i in rng.sample(range(80), 50)]
    # arrivals in time order, each row up to five weeks late
    by = {}
    for d, v in weeks:
        by.setdefault((d - start).days // 21 + rng.choice([0, 0, 0, 1]), []).append((d, v))
    arrivals = [by[k] for k in sorted(by)] + [[(date(2030, 1, 6), 0)]]
    out, handle = play(arrivals, 3, 70)
    best = {}
    for r in out:
        assert r.revision == (best[r.week].revision + 1 if r.week in best else 0)      # numbered without gaps
        best[r.week] = r
    ordered = sorted(weeks)
    for (d, v), (pd, pv) in zip(ordered, [(None, None)] + ordered[:-1]):
        r = best[d]
        assert (r.views, r.delta_views, r.gap_days) == (v, 0 if pd is None else v - pv, None if pd is None else (d - pd).days)
        assert r.view_growth_hit == (pd is not None and (v - pv) / (pv + 1) > 0.5) and r.off_rhythm == (r.gap_days is not None and not 4 <= r.gap_days <= 10)
    assert len(best) == len(weeks)
    # what is kept: the last released week and the one that waits
    assert len([v for v in handle.weeks.values() if v[2]]) == 1 and len(handle.weeks) == 2 and len(handle.timers) == 1


def test_calls_to_the_state_do_not_grow_with_the_weeks(monkeypatch):
    calls = []
    for name in ("iterator", "updateValue", "removeKey"):
        monkeypatch.setattr(Weeks, name, lambda self, *a, f=getattr(Weeks, name): calls.append(1) or f(self, *a))

    def count(n):
        calls.clear()
        out, _ = play([[(date(2000, 1, 2) + timedelta(days=7 * i), i) for i in range(n)], [(date(2030, 1, 6), 0)]], 3, 60)
        assert len(out) == n
        return len(calls)
    assert count(400) == count(40) < 20


def test_packed_rows_give_the_same_weeks():
    rows = [(date(2020, 1, 5), 5, 1), (date(2020, 1, 12), 0, 7), (date(2020, 1, 26), -4, 2), (None, 1, 1)]
    plain, packed = DeltaProcessor(3, 60), PackedDeltas(3, 60)
    now = Times((date(2020, 2, 2) - EPOCH).days * DAY)
    for p in (plain, packed):
        p.init(Handle())
    want = list(plain.handleInputRows(("c",), iter([Row(week=d, views=v, subs=s) for d, v, s in rows]), now))
    got = list(packed.handleInputRows(("c",), iter([Row(packed=d and f"{(d - EPOCH).days},{v},{s}") for d, v, s in rows]), now))
    assert len(want) == 3 and len(got) == 1 and got[0].channel == "c"
    assert list(zip(*got[0][1:])) == [((r.week - EPOCH).days, *r[2:]) for r in want]
    assert plain.handle.weeks == packed.handle.weeks


def test_a_stream_of_nulls(spark, tmp_path):
    d = date(2020, 1, 5)
    rows = [("a", d, 5, 1), ("a", d + timedelta(days=7), None, 9), ("a", None, 3, 3), (None, d, 2, None), ("z", date(2030, 1, 6), 0, 0)]
    spark.createDataFrame(rows, "channel string, week date, views bigint, subs bigint").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("channel string, week date, views bigint, subs bigint").parquet(str(tmp_path / "in"))
    out = stream_deltas(stream.withColumn("event_time", F.col("week").cast("timestamp")).withWatermark("event_time", "60 days"))
    out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    got = spark.read.schema(out.schema).parquet(str(tmp_path / "out"))
    assert got.dtypes[:2] == [("channel", "string"), ("week", "date")] and got.columns[-1] == "revision"
    assert sorted(map(tuple, got.select("channel", "week", "views", "subs", "delta_views", "delta_subs", "gap_days").collect()), key=lambda r: (str(r[0]), r[1])) == [
        (None, d, 2, 0, 0, 0, None), ("a", d, 5, 1, 0, 0, None), ("a", d + timedelta(days=7), 0, 9, -5, 8, 7)]


def test_rows_that_repeat_or_have_no_week():
    d = date(2020, 1, 5)
    out, _ = play([[(d, 5), (d, 9), (d + timedelta(days=7), 8)], [(d, 7), (date(2021, 1, 3), 1)]], 3, 400)
    assert [(r.week, r.views, r.revision) for r in out if r.week < date(2020, 6, 1)] == [(d, 5, 0), (d + timedelta(days=7), 8, 0)]


SCHEMA = "channel string, obs_date date, views bigint, subs bigint"


def observations(seed, n):
    rng = random.Random(seed)
    return [(f"c{rng.randint(0, 30)}", date(2019, 12, 1) + timedelta(days=rng.randint(0, 800)), rng.randint(0, 99), rng.randint(0, 9)) for _ in range(n)]


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_merging_equals_the_batch_and_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "panel")
    first, late = observations(1, 900), [("c3", date(2020, 3, 4), 500, 1), ("c3", date(2020, 3, 5), 400, 2), ("new", date(2021, 2, 2), 1, 1), (None, date(2020, 1, 1), 1, 1), ("c4", None, 1, 1)]
    B.merge_observations(spark, path, spark.createDataFrame(first, SCHEMA), buckets=6)
    before = files(path + "/data")
    rows = spark.createDataFrame(late, SCHEMA)
    got = B.merge_observations(spark, path, rows)
    every = spark.createDataFrame(first + late[:3], SCHEMA)
    want = deltas(B.weekly_rows(every), ["views", "subs"], "channel", "week")
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    after = files(path + "/data")
    bucket = {r.channel: r.b for r in spark.createDataFrame([("c3",), ("new",)], "channel string").select("channel", F.pmod(F.hash("channel"), F.lit(6)).alias("b")).collect()}
    changed = {f.rsplit("/", 1)[0] for f in set(before) ^ set(after)} | {f.rsplit("/", 1)[0] for f in before if after.get(f, before[f]) != before[f]}
    allowed = {f"bucket={bucket['c3']}/year={y}" for y in (2020, 2021, 2022)} | {f"bucket={bucket['new']}/year={y}" for y in (2021, 2022)}
    assert changed and changed <= allowed
    # once more: nothing changes
    again = B.merge_observations(spark, path, rows)
    assert sorted(map(tuple, again.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert B.merge_observations(spark, path, rows.limit(0)).count() == want.count()


def test_backfill_takes_each_batch_once(spark, tmp_path):
    path, late = str(tmp_path / "panel"), str(tmp_path / "late")
    B.merge_observations(spark, path, spark.createDataFrame(observations(2, 300), SCHEMA), buckets=4)
    spark.createDataFrame(observations(3, 20), SCHEMA).write.parquet(f"{late}/batch=1")
    spark.createDataFrame(observations(4, 20), SCHEMA).write.parquet(f"{late}/batch=4")
    assert B.run_backfill(spark, path, late, SCHEMA) == [1, 4]
    assert B.run_backfill(spark, path, late, SCHEMA) == []
    spark.createDataFrame(observations(5, 20), SCHEMA).write.parquet(f"{late}/batch=5")
    assert B.run_backfill(spark, path, late, SCHEMA) == [5]
    every = spark.createDataFrame(observations(2, 300) + observations(3, 20) + observations(4, 20) + observations(5, 20), SCHEMA)
    want = deltas(B.weekly_rows(every), ["views", "subs"], "channel", "week")
    got = B.read_merged(spark, path, every)
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
