"""Deltas and weekly checks on arrival, with an ordered history per entity in RocksDB."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_FIELDS = {"day": "int", "views": "bigint", "subs": "bigint", "delta_views": "bigint", "delta_subs": "bigint", "gap_days": "int", "off_rhythm": "boolean",
           "sub_growth_hit": "boolean", "view_growth_hit": "boolean", "late": "boolean", "revision": "int"}
_PACKED = "channel string, " + ", ".join(f"{name} array<{kind}>" for name, kind in _FIELDS.items())
_WEEK = Row("channel", "week", *list(_FIELDS)[1:])
_LISTS = Row("channel", *_FIELDS)
_DAY = 86_400_000
_EPOCH = date(1970, 1, 1)


def use_rocksdb(spark: SparkSession) -> None:
    """State of queries that start from now on lives in RocksDB, outside of the heap; running and restarted ones keep theirs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


class DeltaProcessor(StatefulProcessor):
    """One entity's weeks in order: those that wait for the release, and those released within the horizon.

    A week is released when the newest event time is more than ``lateness`` days past it. The stream's watermark lies
    ``horizon`` days behind the newest event, so rows that old still arrive here: a late one gets its delta from the
    history, and the released week behind it comes out again with the next ``revision``. Weeks beyond the horizon are
    dropped but for the latest, from which the next delta is taken.

    The state has two entries at most, the weeks that wait and the released ones, each with a list for each field: every
    call to the state is a message to the JVM and back, so their number must not grow with the weeks.
    """

    def __init__(self, lateness: int, horizon: int):
        self.lateness, self.horizon = lateness, horizon

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.weeks = handle.getMapState("weeks", "done boolean", "days array<int>, views array<bigint>, released boolean, subs array<bigint>, revisions array<int>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        yield from self._rows(key[0], self._advance(self._arrived(rows), timerValues.getCurrentWatermarkInMs()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._rows(key[0], self._advance({}, timerValues.getCurrentWatermarkInMs()))

    def close(self) -> None:
        pass

    @staticmethod
    def _arrived(rows) -> dict[int, tuple]:
        arrived = {}
        for r in rows:
            if r.week is not None:
                arrived.setdefault((r.week - _EPOCH).days, (r.views or 0, r.subs or 0))
        return arrived

    @staticmethod
    def _rows(channel: str, weeks: list[tuple]) -> Iterator[Row]:
        for day, *rest in weeks:
            yield _WEEK(channel, _EPOCH + timedelta(days=day), *rest)

    def _advance(self, arrived: dict[int, tuple], watermark: int) -> list[tuple]:
        """Takes in what arrived; the weeks that come out, as values of ``_FIELDS``."""
        watermark = max(watermark, 0)
        before = {k[0]: tuple(v) for k, v in self.weeks.iterator()}
        held = {day: (views, subs, done, revision) for days, all_views, done, all_subs, revisions in before.values()
                for day, views, subs, revision in zip(days, all_views, all_subs, revisions)}
        released = [d for d, v in held.items() if v[2]]
        newest_released = max(released) if released else None
        late = set()
        for day, (views, subs) in arrived.items():
            if day not in held:                                    # the first arrival of a week counts
                is_late = newest_released is not None and day < newest_released
                held[day] = (views, subs, is_late, 0)
                if is_late:
                    late.add(day)
        limit = watermark // _DAY + self.horizon - self.lateness
        days = sorted(held)
        out = []
        for i, day in enumerate(days):
            views, subs, done, revision = held[day]
            if done and day not in late:
                # its neighbour is new
                if i == 0 or days[i - 1] not in late:
                    continue
                revision += 1
            elif not done and day >= limit:
                continue
            held[day] = (views, subs, True, revision)
            out.append(self._week(day, held[day], (days[i - 1], held[days[i - 1]]) if i else None, day in late))
        # history ends at the watermark, but for the week before it
        old = [d for d in sorted(held) if held[d][2] and d < watermark // _DAY][:-1]
        for d in old:
            del held[d]
        for done in (False, True):
            part = sorted((d, v) for d, v in held.items() if v[2] == done)
            if part:
                value = ([d for d, _ in part], [v[0] for _, v in part], done, [v[1] for _, v in part], [v[3] for _, v in part])
                if before.get(done) != value:
                    self.weeks.updateValue((done,), value)
            elif done in before:
                self.weeks.removeKey((done,))
        self._schedule(held, watermark)
        return out

    def _schedule(self, held: dict[int, tuple], watermark: int) -> None:
        """One timer: when the next week is due, or when the second oldest released one passes out of the horizon."""
        due = [(d + 1 - self.horizon + self.lateness) * _DAY for d, v in held.items() if not v[2]]
        released = sorted(d for d, v in held.items() if v[2])
        due += [(d + 1) * _DAY for d in released[1:2]]
        wanted = {max(min(due), watermark + 1)} if due else set()
        there = set(self.handle.listTimers())
        for timer in there - wanted:
            self.handle.deleteTimer(timer)
        for timer in wanted - there:
            self.handle.registerTimer(timer)

    @staticmethod
    def _week(day: int, now: tuple, before: tuple | None, late: bool) -> tuple:
        views, subs, _, revision = now
        gap, dv, ds, view_hit, sub_hit = None, 0, 0, False, False
        if before is not None:
            gap, dv, ds = day - before[0], views - before[1][0], subs - before[1][1]
            view_hit = before[1][0] != -1 and dv / (before[1][0] + 1) > 0.5
            sub_hit = before[1][1] != -1 and ds / (before[1][1] + 1) > 0.2
        return day, views, subs, dv, ds, gap, gap is not None and (gap < 4 or gap > 10), sub_hit, view_hit, late, revision


class PackedDeltas(DeltaProcessor):
    """The same over packed rows, as Spark converts every cell of a row in Python.

    A row's fields come in one string ``packed`` ("day,views,subs"; null without a week); what a call gives out is one
    row with a list for each field.
    """

    @staticmethod
    def _arrived(rows) -> dict[int, tuple]:
        arrived = {}
        for r in rows:
            packed = r.packed
            if packed is not None:
                day, views, subs = packed.split(",")
                arrived.setdefault(int(day), (int(views), int(subs)))
        return arrived

    @staticmethod
    def _rows(channel: str, weeks: list[tuple]) -> Iterator[Row]:
        if weeks:
            yield _LISTS(channel, *map(list, zip(*weeks)))


def stream_deltas(stream: DataFrame, key: str = "channel", lateness_days: int = 3, horizon_days: int = 60) -> DataFrame:
    """Deltas and limit hits per entity and week as rows arrive.

    Input: (channel, week, views, subs, event_time with a watermark of ``horizon_days``), one row per entity and week
    (``stream_dedup``). A week comes out once ``lateness_days`` have passed; a row that arrives after a later week of
    its entity was released comes out at once with ``late`` set, and the week behind it again with the next
    ``revision``. For each (entity, week) the row of the highest revision counts (``latest_revision``), and those rows
    equal the batch operators over all rows that were not older than the horizon when they arrived.
    The state is one small ordered history per entity, in RocksDB; each release and each expiry has its timer.
    """
    if horizon_days < lateness_days:
        raise ValueError("horizon_days must be at least lateness_days")
    use_rocksdb(stream.sparkSession)
    count = [F.coalesce(F.col(c).cast("bigint"), F.lit(0)).cast("string") for c in ("views", "subs")]
    packed = F.concat(F.unix_date(F.col("week").cast("date")).cast("string"), F.lit(","), count[0], F.lit(","), count[1])
    rows = stream.select(F.col(key).alias("channel"), packed.alias("packed"), "event_time")
    out = rows.groupBy("channel").transformWithState(PackedDeltas(lateness_days, horizon_days), outputStructType=_PACKED, outputMode="append", timeMode="EventTime")
    weeks = out.select("channel", F.inline(F.arrays_zip(*_FIELDS)))
    return weeks.select("channel", F.date_from_unix_date("day").alias("week"), *list(_FIELDS)[1:])


def latest_revision(emitted: DataFrame, key: str = "channel", t: str = "week") -> DataFrame:
    """The standing row of each entity and week; combines in the map task."""
    rest = [c for c in emitted.columns if c not in (key, t)]
    best = emitted.groupBy(key, t).agg(F.max(F.struct("revision", *[c for c in rest if c != "revision"])).alias("_r"))
    return best.select(key, t, *[F.col(f"_r.{c}").alias(c) for c in rest])


def delta_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The history a delta query keeps, read from its checkpoint: (channel, week, views, subs, released, revision)."""
    reader = spark.read.format("statestore").option("stateVarName", "weeks")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    v, w = F.col("user_map_value"), F.col("w")
    weeks = reader.load(checkpoint).select(F.col("key.channel").alias("channel"), v["released"].alias("released"),
                                           F.explode(F.arrays_zip(v["days"], v["views"], v["subs"], v["revisions"])).alias("w"))
    return weeks.select("channel", F.date_add(F.lit(_EPOCH), w["days"]).alias("week"), w["views"].alias("views"), w["subs"].alias("subs"),
                        "released", w["revisions"].alias("revision"))
