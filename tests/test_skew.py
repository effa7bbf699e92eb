"""Operators against brute force when one key holds most of the rows."""

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekloom.operators import joins as J, ranking as R
from weekloom.operators.quantiles import approx_quantile, exact_quantile, merge_cells, quantile_cells


@pytest.mark.parametrize("p", [0.25, 0.5, 0.9])
def test_exact_quantile_large_group_with_ties(spark, p):
    rng = np.random.default_rng(7)
    hot = np.where(rng.random(40_000) < 0.4, 0.0, rng.normal(size=40_000))
    small = rng.normal(size=7)
    rows = [("hot", i, float(v)) for i, v in enumerate(hot)] + [("small", i, float(v)) for i, v in enumerate(small)]
    df = spark.createDataFrame(rows, "g string, i bigint, v double")
    got = {r.g: r.q for r in exact_quantile(df, ["g"], "v", p, "q", spread=["i"]).collect()}
    assert got["hot"] == pytest.approx(np.quantile(hot, p), abs=1e-12)
    assert got["small"] == pytest.approx(np.quantile(small, p), abs=1e-12)


def test_nearest_join_hot_key(spark):
    rnd = random.Random(3)
    day0 = date(2000, 1, 1)
    left = sorted({("hot", day0 + timedelta(days=rnd.randrange(4000))) for _ in range(1500)} | {("cold", day0)})
    right = sorted({("hot", day0 + timedelta(days=rnd.randrange(4000))) for _ in range(90)})
    values = {kt: i + 1 for i, kt in enumerate(right)}
    ldf = spark.createDataFrame(left, "channel string, t date")
    rdf = spark.createDataFrame([(k, t, v) for (k, t), v in values.items()], "channel string, t date, v bigint")
    got = {(r.channel, r.t): r.v for r in J.nearest_join(ldf, rdf, "v", tol_days=9).collect()}
    want = {}
    for k, t in left:
        near = [(abs((t - rt).days), rt, v) for (rk, rt), v in values.items() if rk == k and abs((t - rt).days) <= 9]
        want[(k, t)] = min(near)[2] if near else 0
    assert got == want


def test_positions_across_buckets(spark):
    rows = [("hot", f"{20200101 + d % 28}{h:06d}", f"d{d:04d}{h}") for d in range(300) for h in range(3)] + [("cold", "20200101000000", "x")]
    df = spark.createDataFrame(rows, "channel string, timestamp string, digest string")
    got = R.position_in_key(df, "channel", ["timestamp", "digest"], F.substring("timestamp", 1, 8).cast("int")).collect()
    hot = sorted([r for r in got if r.channel == "hot"], key=lambda r: r.pos)
    assert [r.pos for r in hot] == list(range(900)) and {r.total for r in hot} == {900}
    assert [(r.timestamp, r.digest) for r in hot] == sorted((t, d) for k, t, d in rows if k == "hot")


def test_spread_keeps_exact_positions(spark):
    rows = [("a", f"202001{1 + i // 2:02d}0000{i:02d}", "o", "200", f"{i:03d}") for i in range(37)] + [("b", f"2020010{i}000000", "o", "200", str(i)) for i in range(1, 5)]
    df = spark.createDataFrame(rows, "channel string, timestamp string, original string, statuscode string, digest string")
    got = R.spread_snapshots(df).collect()
    assert sorted(r.pos for r in got if r.channel == "a") == sorted({int(i * 37 / 10) for i in range(10)})
    assert sum(r.channel == "b" for r in got) == 4


@pytest.mark.parametrize("n,part_rows", [(6000, 500), (6000, 10**6), (40, 1)])
def test_positions_with_one_busy_day(spark, n, part_rows):
    """One entity and one day hold most rows, stamps repeat or cannot be read: parts stay even, positions stay exact."""
    rng = random.Random(4)
    rows = []
    for i in range(n):
        hot = i % 3 != 0
        stamp = "20200101" + f"{rng.randint(0, 86399):06d}" if hot else rng.choice(["20200102000000", "oops", None, f"2021{rng.randint(0, 10**9)}"])
        rows.append(("hot" if hot or i % 2 else f"c{i % 5}", stamp, f"d{rng.randint(0, 40)}"))
    rows += rows[: n // 10]
    df = spark.createDataFrame(rows, "channel string, timestamp string, digest string")
    got = R.position_in_key(df, "channel", ["timestamp", "digest"], part_rows=part_rows)
    want = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or "", r[2])):
        want.setdefault(r[0], []).append(r)
    assert sorted((r.channel, r.pos, r.timestamp or "", r.digest, r.total) for r in got.collect()) == sorted(
        (c, i, r[1] or "", r[2], len(rs)) for c, rs in want.items() for i, r in enumerate(rs))


def test_parts_of_a_hot_entity_are_even(spark):
    df = spark.range(20000).select(F.lit("hot").alias("channel"), F.lit("20200101").alias("timestamp"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    sizes = sorted(r["count"] for r in R.parts_of(df, "channel", ["timestamp", "digest"], part_rows=1000).groupBy("_part").count().collect())
    assert len(sizes) >= 15 and sizes[-1] <= 3 * sizes[len(sizes) // 2]


@pytest.mark.parametrize("limit", [1, 7, 65536])
def test_exact_quantile_over_rounds(spark, limit):
    """Hard values, null and hot groups; a small limit forces every round of counting."""
    rng = random.Random(limit)
    rows = [("hot", rng.choice([rng.gauss(0, 1), rng.uniform(1, 1.0001), 0.25, 0.25])) for _ in range(3000)]
    rows += [(None, rng.choice([-1e300, -1e-300, 0.0, 5e-324, 1e300, 3.5])) for _ in range(40)] + [("one", 7.0), ("two", -2.0), ("two", 3.0), ("none", None)]
    rows += [("ties", 1.5)] * 50 + [("near", 1.0 + i * 2.0**-52) for i in range(64)]
    df = spark.createDataFrame([(g, v, i) for i, (g, v) in enumerate(rows)], "g string, v double, i int").repartition(5)
    for p in (0.0, 0.31, 0.5, 1.0):
        got = {r.g: r.q for r in exact_quantile(df, ["g"], "v", p, "q", spread=["i"], limit=limit).collect()}
        want = {g: float(np.quantile([v for h, v in rows if h == g and v is not None], p)) for g in ("hot", None, "one", "two", "ties", "near")}
        assert set(got) == set(want)
        for g in want:
            assert got[g] == pytest.approx(want[g], rel=1e-12, abs=1e-320), (g, p)


def test_sketches_of_parts_are_kept_and_merged(spark):
    rng = random.Random(9)
    rows = [(rng.choice("ab"), rng.lognormvariate(0, 2) * rng.choice([1, -1])) for _ in range(4000)]
    parts = [spark.createDataFrame(rows[i::3], "g string, v double") for i in range(3)]
    cells = merge_cells(*[quantile_cells(p, ["g"], "v") for p in parts], keys=["g"])
    whole = spark.createDataFrame(rows, "g string, v double")
    assert sorted(map(tuple, cells.collect())) == sorted(map(tuple, quantile_cells(whole, ["g"], "v").select(cells.columns).collect()))
    for p in (0.1, 0.5, 0.95):
        want = {g: float(np.quantile([v for h, v in rows if h == g], p)) for g in "ab"}
        assert {r.g: r.quantile for r in exact_quantile(whole, ["g"], "v", p, cells=cells).collect()} == pytest.approx(want)
        near = {r.g: r.quantile for r in approx_quantile(cells, ["g"], p).collect()}
        assert all(abs(near[g] - want[g]) <= 0.1 * abs(want[g]) for g in "ab")
