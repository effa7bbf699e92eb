"""JSON documents read in splits: one array per file, one object per file, or one object per line.

A file is read as fragments between closing brackets, which Spark's line reader can start anywhere and on any file
system. Whether a bracket counts depends on everything before it, so the files are scanned twice. The first scan sums up
each split for both cases, that it begins outside or inside a string: how it ends, and by how much the depth changes.
Those sums, one row for each split, are put together in order and tell every split its true state. The second scan cuts
the elements; one that crosses splits is sent as pieces, at most two for each split, and put together again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_ESCAPED = re.compile(r"\\.", re.DOTALL)
_SPACE = " \t\r\n﻿"
#: State at the start of a split: outside a string, inside one, inside one after a backslash.
OUT, TEXT, ESCAPE = 0, 1, 2

_SUMS = "file string, start long, root string, opening string, end_out int, depth_out long, end_text int, depth_text long, end_escape int, depth_escape long"
_STATES = "file string, start long, state int, depth long, root string, opening string"
#: Longest first element that is handed to all splits of its file.
OPENING_CHARS = 1 << 16


def _step(text: str, state: int) -> tuple[int, int]:
    """(state after ``text``, change of depth), given the state before it."""
    if state == ESCAPE:
        if not text:
            return ESCAPE, 0
        text, state = text[1:], TEXT
    if "\\" in text:
        text = _ESCAPED.sub("", text)
    pending = text.endswith("\\")
    parts = text.split('"')
    depth = 0
    for part in parts[state::2]:
        depth += part.count("[") + part.count("{") - part.count("]") - part.count("}")
    after = (state + len(parts) - 1) % 2
    return (ESCAPE if pending and after == TEXT else after), depth


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, str, bool]]:
    """(row, fragment, whether it is the first of its split)."""
    last = None
    for batch in batches:
        rest = [n for n in batch.schema.names if n != "value"]
        columns = [batch.column(n).to_pylist() for n in rest]
        for value, *values in zip(batch.column("value").to_pylist(), *columns):
            row = dict(zip(rest, values))
            here = (row["file"], row["start"])
            yield row, value, here != last
            last = here


def _sums(sep: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ends, depths, opening, held = None, None, None, None, 0

        def row():
            return pa.RecordBatch.from_pylist([{"file": now["file"], "start": now["start"], "root": root, "opening": opening, "end_out": ends[0], "depth_out": depths[0],
                                                "end_text": ends[1], "depth_text": depths[1], "end_escape": ends[2], "depth_escape": depths[2]}], schema=_schema(_SUMS))
        for given, value, first in _splits(batches):
            if first:
                if now is not None:
                    yield row()
                now, ends, depths, opening, parts, held, root = given, [OUT, TEXT, ESCAPE], [0, 0, 0], None, [], 0, None
            if root is None and given["start"] == 0 and value.strip(_SPACE):
                root = value.strip(_SPACE)[0]
            elif root is None and given["start"] == 0 and value == "":
                root = sep
            text = value + sep
            for i in range(3):
                ends[i], change = _step(text, ends[i])
                depths[i] += change
            if given["start"] == 0 and opening is None and held <= OPENING_CHARS:
                parts.append(text)
                held += len(text)
                if ends[OUT] == OUT and depths[OUT] <= (root == "["):
                    opening = _bare("".join(parts), root == "[")
        if now is not None:
            yield row()
    return run


def _bare(text: str, drop_bracket: bool) -> str:
    """An element without what stands before it."""
    text = text.lstrip(_SPACE)
    if drop_bracket and text.startswith("["):
        text = text[1:]
    return text.lstrip(_SPACE + ",")


def _enter(sums: pa.Table) -> pa.Table:
    """States of all splits of one file, from the sums in order."""
    rows = sorted(sums.to_pylist(), key=lambda r: r["start"])
    state, depth, out = OUT, 0, []
    first = rows[0]
    for r in rows:
        out.append({"file": r["file"], "start": r["start"], "state": state, "depth": depth, "root": first["root"], "opening": first["opening"]})
        name = ("out", "text", "escape")[state]
        state, depth = r[f"end_{name}"], depth + r[f"depth_{name}"]
    return pa.Table.from_pylist(out, schema=_schema(_STATES))


#: Kinds of pieces: an element that lies in one split; the part that continues an element of a split before; the part that begins one.
WHOLE, HEAD, TAIL = 0, 1, 2
_PIECES = "file string, start long, nr long, kind int, opening string, text string"


def _pieces(sep: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, parts, state, depth, kind, nr, closed = [], None, [], OUT, 0, HEAD, 0, False

        def add(last: bool) -> None:
            nonlocal nr, kind, parts
            text = "".join(parts)
            parts = []
            if last and kind == WHOLE:
                kind = TAIL
            # a beginning is sent even if blank: what continues it in the next split must not go to another element
            if text.strip(_SPACE + ",") or kind != WHOLE:
                out.append({"file": now["file"], "start": now["start"], "nr": nr, "kind": kind, "opening": now["opening"], "text": text})
                nr += 1
            kind = WHOLE
        for given, value, first in _splits(batches):
            if first:
                if now is not None:
                    add(True)
                now, parts, nr = given, [], 0
                state, depth, closed = given["state"], given["depth"], given["root"] == "[" and given["start"] > 0 and given["depth"] <= 0
                kind = WHOLE if given["start"] == 0 else HEAD
                inside, begun = given["root"] == "[", given["start"] > 0
            if closed:
                continue
            text = value + sep
            state, change = _step(text, state)
            depth += change
            if not begun and value.strip(_SPACE):
                # the bracket of the array itself
                begun = True
                text = _bare(text, inside)
            if inside and begun and state == OUT and depth <= 0:
                # the array's end, which is this fragment's bracket or lies before it
                parts.append(text[: text.rfind("]", 0, len(text) - 1 if sep != "]" else len(text))])
                closed = True
            else:
                if not inside and depth < 0:
                    text, depth = value, 0                 # the file ended without a last bracket
                parts.append(text)
                if state == OUT and depth == (1 if inside else 0):
                    add(False)
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema=_schema(_PIECES))
                out = []
        if now is not None:
            add(True)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_schema(_PIECES))
    return run


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in ddl.split(", ")])


def json_elements(spark: SparkSession, path: str, sep: str = "}") -> DataFrame:
    """(file, opening, text): the elements of every JSON document at ``path`` as text, a comma between several in one row.

    ``sep`` is the bracket that ends an element: ``}`` for objects, ``]`` for arrays. ``opening`` is the first element
    of the file, null if it is longer than ``OPENING_CHARS``. An object that is the whole document, and objects one
    after the other, are elements themselves. The table of states has one row for each split and is broadcast; splits
    are of ``spark.sql.files.maxPartitionBytes``, so it has a row for each 128 MB by default.
    Defined results: an empty file or array has no element; text that is no JSON comes out as it is; compressed files are one split.
    """
    lines = spark.read.option("lineSep", sep).text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    sums = lines.mapInArrow(_sums(sep), _SUMS)
    states = sums.groupBy("file").applyInArrow(_enter, _STATES)
    known = lines.join(F.broadcast(states), ["file", "start"])
    pieces = known.select("value", "file", "start", "state", "depth", "root", "opening").mapInArrow(_pieces(sep), _PIECES)
    whole = pieces.filter(F.col("kind") == WHOLE).select("file", "opening", "text")
    # pieces belong to the split in which their element begins: the latest one with a beginning, else the first
    order = Window.partitionBy("file").orderBy("start", "nr")
    owner = F.last(F.when((F.col("kind") == TAIL), F.col("start")), ignorenulls=True).over(order)
    crossing = pieces.filter(F.col("kind") != WHOLE).withColumn("owner", owner)
    joined = (crossing.groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("start", "nr", "text"))).alias("parts"), F.first("opening").alias("opening"))
              .select("file", "opening", F.array_join("parts.text", "").alias("text")))
    return whole.unionByName(joined).filter(F.trim(F.translate("text", ",\r\n\t﻿", "     ")) != "")


def read_json_records(spark: SparkSession, path: str, sep: str = "}") -> DataFrame:
    """(file, record): every element of the JSON documents at ``path`` as a VARIANT, whatever its fields.

    ``record`` is null where an element is no JSON.
    """
    return records_of(json_elements(spark, path, sep)).select("file", "record")


def records_of(elements: DataFrame) -> DataFrame:
    """``elements`` with each text's elements as rows of ``record`` (VARIANT)."""
    listed = F.try_parse_json(F.concat(F.lit("["), F.regexp_replace("text", r"^[\s,\x{FEFF}]+|[\s,]+$", ""), F.lit("]")))
    rows = elements.withColumn("__list", F.variant_get(listed, "$", "array<variant>"))
    return rows.select("*", F.explode_outer("__list").alias("record")).drop("__list", "text")


def merged_json(record: Column, typed: Column) -> Column:
    """JSON text of ``record`` (an object VARIANT or null) with the fields of the struct ``typed`` in place of its own.

    Fields of ``typed`` are written even if null, as the record's form is fixed.
    """
    fields = "map<string,variant>"
    own = F.coalesce(F.try_variant_get(record, "$", fields), F.create_map().cast(fields))
    new = F.variant_get(F.parse_json(F.to_json(typed, {"ignoreNullFields": "false"})), "$", fields)
    return F.to_json(F.map_concat(F.map_filter(own, lambda k, v: ~F.map_contains_key(new, k)), new), {"ignoreNullFields": "false"})
