"""Splittable JSON: equal to a whole parse at every split point; open records survive reading and writing."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from weekloom import sources as IO
from weekloom.sources import json_records as J


def value(rng, depth=0):
    r = rng.random()
    if r < 0.3:
        return rng.choice(['a"b', "\\", 'x\\"y}]{[,', "", "é😀}", "\n},{", '{"a":1}', "[[", "]"])
    if r < 0.5:
        return rng.randint(-9, 99)
    if r < 0.6 or depth > 2:
        return rng.choice([None, True, 1.5])
    if r < 0.8:
        return {rng.choice('abcd"\\}'): value(rng, depth + 1) for _ in range(rng.randint(0, 3))}
    return [value(rng, depth + 1) for _ in range(rng.randint(0, 3))]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rng = random.Random(2)
    rows = [{"id": i, "v": value(rng), "w": value(rng)} for i in range(120)]
    lists = [["digest", "timestamp"], *([f"d{i}", rng.choice(["20190101", "a]b", '"],[', "\\"])] for i in range(150))]
    docs = {"pretty": (json.dumps(rows, indent=2), rows), "one": (json.dumps(rows), rows), "raw": (json.dumps(rows, ensure_ascii=False), rows), "single": (json.dumps(rows[0], indent=1), rows[:1]),
            "lines": ("\n".join(json.dumps(r) for r in rows) + "\n", rows), "noend": ("\n".join(json.dumps(r) for r in rows), rows), "empty": ("", []), "none": (" [ ] \n", []),
            "bom": ("﻿" + json.dumps(rows[:3]), rows[:3])}
    path = tmp_path_factory.mktemp("json")
    for kind, files in (("objects", docs), ("lists", {"a": (json.dumps(lists), lists), "b": (json.dumps(lists[:40], indent=3) + "\n", lists[:40])})):
        (path / kind).mkdir()
        for name, (text, _) in files.items():
            (path / kind / f"{name}.json").write_text(text)
    return str(path), docs, lists


def sized(spark, size):
    for key, text in (("maxPartitionBytes", str(size)), ("openCostInBytes", "0"), ("minPartitionNum", "1")):
        spark.conf.set(f"spark.sql.files.{key}", text)


@pytest.fixture
def splits(spark):
    yield lambda size: sized(spark, size)
    for key in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{key}")


def same(a, b):
    return sorted(json.dumps(x, sort_keys=True) for x in a) == sorted(json.dumps(x, sort_keys=True) for x in b)


@pytest.mark.parametrize("size", [10**9, 3001, 701, 97, 31])
def test_records_at_every_split(spark, folder, splits, size):
    path, docs, _ = folder
    splits(size)
    got = {}
    for r in J.read_json_records(spark, f"{path}/objects").select("file", F.to_json("record").alias("j")).collect():
        got.setdefault(os.path.basename(r.file)[:-5], []).append(json.loads(r.j))
    for name, (_, rows) in docs.items():
        assert same(got.get(name, []), rows), name


@pytest.mark.parametrize("size", [10**9, 500, 37])
def test_index_arrays_at_every_split(spark, folder, splits, size):
    path, _, lists = folder
    splits(size)
    got = [(r.digest, r.timestamp) for r in IO.read_snapshot_index(spark, f"{path}/lists").collect()]
    assert sorted(got) == sorted(tuple(r) for r in lists[1:] + lists[1:40])


def test_many_tasks_read_one_file(spark, folder, splits):
    path, docs, _ = folder
    splits(1000)
    text, rows = docs["one"]
    lines = spark.read.option("lineSep", "}").text(f"{path}/objects/one.json")
    assert lines.rdd.getNumPartitions() >= len(text) // 1000
    assert J.read_json_records(spark, f"{path}/objects/one.json").count() == len(rows)


def test_steps_agree_with_a_plain_scan():
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choices('ab"\\[]{},', k=rng.randint(0, 30)))
        for start in (J.OUT, J.TEXT, J.ESCAPE):
            state, depth = start, 0
            for c in text:
                if state == J.ESCAPE:
                    state = J.TEXT
                elif state == J.TEXT:
                    state = J.OUT if c == '"' else J.ESCAPE if c == "\\" else J.TEXT
                elif c == '"':
                    state = J.TEXT
                elif c != "\\":
                    depth += (c in "[{") - (c in "]}")
            # a backslash outside of strings is no JSON, so only texts without one are compared there
            if not ("\\" in text and start == J.OUT):
                plain = J._step(text, start)
                if "\\" not in text:
                    assert plain == (state, depth)


RECORD = [{"channel_id": "c1", "channel_name": "", "current_metrics": {"subscriber_count": "12", "own": [1, {"x": None}]}, "collection_metadata": {"deep": {"er": "}"}}, "extra": {"a": [1]}, "history": None},
          {"id": " c2 ", "channel_name": "two", "keywords": ["k"], "validation_flags": ["f"]}, "text", 7, None, {"channel_name": "nobody"}, {"channel_id": " "}]


@pytest.mark.parametrize("fmt", ["lines", "array"])
def test_open_records(spark, tmp_path, fmt):
    (tmp_path / "in.json").write_text(json.dumps(RECORD))
    got = IO.read_entities(spark, str(tmp_path / "in.json"), "json")
    rows = {r.channel_id: r for r in got.drop("record", "collection_metadata").collect()}
    assert set(rows) == {"c1", "c2"}
    one = rows["c1"]
    assert (one.channel_name, one.category, one.status, one.current_metrics.subscriber_count, one.history.total_data_points, one.keywords) == ("Channel_c1", "Other", "unknown", 12, 0, [])
    assert (rows["c2"].keywords, rows["c2"].validation_flags, rows["c2"].processing_status) == (["k"], ["f"], "pending")
    IO.write_entities(got, str(tmp_path / "out"), "p", fmt=fmt)
    back = {r.i: json.loads(r.j) for r in IO.read_entities(spark, str(tmp_path / "out" / "p"), "json").select(F.col("channel_id").alias("i"), F.to_json("record").alias("j")).collect()}
    assert back["c1"]["current_metrics"]["own"] == [1, {"x": None}] and back["c1"]["extra"] == {"a": [1]} and back["c1"]["collection_metadata"] == {"deep": {"er": "}"}}
    assert back["c2"]["id"] == " c2 " and back["c2"]["channel_id"] == "c2" and back["c1"]["current_metrics"]["video_count"] == 0


def test_json_panel_needs_no_schema_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([("a", "x", "2020-01-05", "7", 1, 2, 3, 4, 5, "active", 9, "good")], "channel string, category string, datetime string, views string, delta_views long, subs long, delta_subs long, videos long, delta_videos long, activity string, total_longform_views long, data_quality_flag string").write.json(path)
    got = IO.read_panel(spark, path, "json").first()
    assert (got.views, got.total_longform_views) == (7, 9) and str(got.datetime.date()) == "2020-01-05"
    spark.createDataFrame([("a",)], "channel string").write.json(path + "2")
    with pytest.raises(ValueError, match="missing"):
        IO.read_panel(spark, path + "2", "json")


def test_index_lines_are_written_batch_by_batch():
    import pyarrow as pa

    from checks.q_io import _listed
    read = []

    def batches(n):
        for i in range(n):
            read.append(i)
            yield pa.RecordBatch.from_pydict({"value": [f'["{i}"]'] if i != 1 else []}, pa.schema([("value", pa.string())]))
    out = _listed(batches(4))
    next(out)
    assert read == [0]
    lines = [v for b in _listed(batches(4)) for v in b.column(0).to_pylist()]
    assert json.loads("".join(lines)) == [["digest", "timestamp", "original", "statuscode"], ["0"], ["2"], ["3"]]
    assert not list(_listed(batches(0)))
