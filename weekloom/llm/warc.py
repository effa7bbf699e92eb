"""WARC archives: a writer with revisit records and a splittable reader.

Writer: every task writes gzip members, one for each record, to a file of its own in the archive folder
and reports it; only reported files belong to the archive, so an attempt that was lost leaves nothing
behind that is read. Of records with an equal payload of at least ``min_bytes`` bytes the one with the
smallest id is the response, the others are revisits that name it and carry no payload.

Reader: files are cut into byte ranges, each a task's work wherever the ranges of a file fall. A task looks
for the gzip magic from its first byte on, takes a place for a member only if its decoded start is a
WARC header and what follows its end is another member or the file's end, and owns the records that
start inside its range, reading the last one to its end beyond the range. Memory holds one record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom.llm.common import shared_folder, stored

MAGIC = b"\x1f\x8b\x08"
#: Bytes of a range, and tasks that read ranges at most; with more ranges a task has several.
RANGE_BYTES, MOST_TASKS = 8 << 20, 50_000
CHUNK = 1 << 18
#: Fixed values of the format.
VERSION, HTTP_OK = "WARC/1.1", "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"


@F.arrow_udf(T.StringType())
def payload_digest(payloads: pa.Array) -> pa.Array:
    """Upper-case base32 of the SHA-1 of the payload; null counts as empty."""
    return pa.array([base64.b32encode(hashlib.sha1(p or b"").digest()).decode() for p in payloads.to_pylist()], pa.string())


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri:
        uri = "file://" + (uri[5:] if uri.startswith("file:") else uri)
    return fs.FileSystem.from_uri(uri)


def _line(value: str | None) -> str:
    """A header value: percent-encodes what would break the line."""
    return "".join(c if c >= " " and c != "%" else f"%{ord(c):02X}" for c in value or "")


def record_bytes(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One record. Revisits hold the HTTP header only and state the payload's length."""
    revisit = refers_to is not None
    http = f"{HTTP_OK}Content-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{ID_PREFIX}{'' if page_id is None else page_id}>", f"WARC-Target-URI: {_line(url)}",
            "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += [f"WARC-Refers-To: <{ID_PREFIX}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def member(record: bytes, level: int = 4) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def write_archive(pages: DataFrame, folder: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes one record for each row of ``pages``; returns the manifest (path, bytes, records).

    Ids must be integers. Defined results: a null html is an empty payload; a null url an empty target;
    rows with a null id are responses, as a reference could not name them apart, and no revisit refers to
    them unless no other row has the payload; a repeated id with an equal payload is response in each of its rows that
    bears the smallest id; an empty table gives an empty manifest.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    digests = stored(rows.select("id", F.length("payload").alias("size"), payload_digest("payload").alias("digest")), "payload-digests")
    # only digests that more than one id bears are joined with the pages
    first = stored(digests.filter(F.col("size") >= min_bytes).groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
                   .filter("first < last").select("digest", "first"), "first-payloads")
    named = rows.withColumn("digest", payload_digest("payload")).join(first, "digest", "left")
    plan = named.select("id", "url", "payload", "digest", F.when((F.length("payload") >= min_bytes) & (F.col("id") > F.col("first")), F.col("first")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(folder)
        store.create_dir(root, recursive=True)
        name, out, size, count = f"{root}/part-{uuid.uuid4().hex}.warc.gz", None, 0, 0
        for batch in batches:
            for r in zip(*(batch.column(i) for i in range(5))):
                page_id, url, payload, digest, refers_to = (x.as_py() for x in r)
                out = out or store.open_output_stream(name, compression=None)   # else the name's .gz would compress it again
                data = member(record_bytes(page_id, url, payload, digest, refers_to))
                out.write(data)
                size, count = size + len(data), count + 1
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [name], "bytes": [size], "records": [count]}, pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))
    # the manifest is written once: reading it again does not write the archive again
    return stored(plan.mapInArrow(write, "path string, bytes long, records long"), "manifest")


class _Source:
    """Chunks of a file from a position on."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size

    def at(self, pos: int, n: int = CHUNK) -> bytes:
        return self.file.read_at(min(n, max(0, self.size - pos)), pos)


def _member_at(source: _Source, pos: int) -> tuple[bytes, int] | None:
    """(record, end) of the gzip member at ``pos``, or None if there is no WARC record.

    The first decoded bytes decide before the rest is read.
    """
    unpack, parts, first = zlib.decompressobj(31), [], True
    at = pos
    while not unpack.eof:
        data = source.at(at, 4096 if first else CHUNK)
        if not data:
            return None
        try:
            out = unpack.decompress(data)
        except zlib.error:
            return None
        at += len(data)
        if out and first:
            if not out.startswith(b"WARC/1."):
                return None
            first = False
        parts.append(out)
    end = at - len(unpack.unused_data)
    after = source.at(end, len(MAGIC))
    if after and after != MAGIC[: len(after)]:
        return None
    return b"".join(parts), end


def _next_magic(source: _Source, pos: int, stop: int) -> int:
    """Next place in [pos, stop) where the magic starts, or ``stop``."""
    while pos < stop:
        data = source.at(pos, min(CHUNK, stop - pos) + len(MAGIC) - 1)
        found = data.find(MAGIC)
        if found >= 0 and pos + found < stop:
            return pos + found
        pos += max(1, len(data) - len(MAGIC) + 1)
    return stop


def records_in(source: _Source, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """Records whose member starts in [start, stop)."""
    pos = start
    while (pos := _next_magic(source, pos, stop)) < stop:
        got = _member_at(source, pos)
        if got is None:
            pos += 1
        else:
            yield pos, got[0]
            pos = got[1]


def parse_record(record: bytes) -> dict:
    """Type, ids, target, and the payload's length and digest: measured for a response, as stated for a revisit."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response":
        digest, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
        if digest != stated:
            raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    else:
        digest, size, payload = stated, int(http.decode().rpartition("Content-Length: ")[2]), None

    def number(value: str) -> int | None:
        text = value.strip("<>").removeprefix(ID_PREFIX)
        return int(text) if text else None
    return {"id": number(fields["warc-record-id"]), "record_type": fields["warc-type"], "url": fields.get("warc-target-uri"), "payload_bytes": size, "payload_digest": digest,
            "refers_to": number(fields["warc-refers-to"]) if "warc-refers-to" in fields else None, "payload": payload}


RECORD = "id long, record_type string, url string, payload_bytes long, payload_digest string, refers_to long"


def read_archive(manifest: DataFrame, payloads: bool = False, range_bytes: int = RANGE_BYTES, complete: bool = True) -> DataFrame:
    """Records of the files in ``manifest``(path, bytes, records), with their payload (null for revisits) if asked for.

    Reads the archive at once, and fails if a file gave another number of records than the manifest names.
    With ``complete=False`` reading is lazy, ``records`` is not needed, and a damaged member is passed over, as reading
    resumes at the next one. No files give no rows.
    """
    if complete and "records" not in manifest.columns:
        raise ValueError("the manifest has no column records to hold the archive against; complete=False reads without")
    starts = manifest.select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))).alias("start"))
    # a range a task: with a number given, adaptive execution does not put the small rows of ranges together again
    n_ranges = manifest.agg(F.sum(F.greatest(F.ceil(F.col("bytes") / range_bytes), F.lit(1)))).first()[0] or 1
    ranges = starts.repartition(min(int(n_ranges), MOST_TASKS), F.col("path"), F.col("start"))
    schema = RECORD + (", payload binary" if payloads else "") + ", path string"
    kinds = [("id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())]
    arrow = pa.schema(kinds + [("payload", pa.binary())] * payloads + [("path", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                store, path = open_folder(r["path"])
                with store.open_input_file(path) as file:
                    found, held = [], 0
                    for _, record in records_in(_Source(file, r["bytes"]), r["start"], min(r["bytes"], r["start"] + range_bytes)):
                        found.append({k: v for k, v in parse_record(record).items() if k in arrow.names} | {"path": r["path"]})
                        held += len(record) if payloads else 200
                        if held > 8 * CHUNK:
                            yield pa.RecordBatch.from_pylist(found, arrow)
                            found, held = [], 0
                    if found:
                        yield pa.RecordBatch.from_pylist(found, arrow)
    got = ranges.mapInArrow(read, schema)
    if complete:
        got = stored(got, "records")
        _hold_against(manifest, got)
    return got.drop("path")


def _hold_against(manifest: DataFrame, got: DataFrame) -> None:
    """Fails if the records of a file are not as many as its manifest says."""
    wanted = manifest.groupBy("path").agg(F.sum("records").alias("records"))
    counts = wanted.join(got.groupBy("path").agg(F.count(F.lit(1)).alias("n")), "path", "left").select("path", "records", F.coalesce("n", F.lit(0)).alias("n"))
    wrong = counts.filter(~F.col("records").eqNullSafe(F.col("n"))).orderBy("path")
    if first := wrong.limit(10).collect():
        raise ValueError(f"{wrong.count()} files of the archive are damaged: " + ", ".join(f"{r.path} gave {r.n} of {r.records} records" for r in first))


def archive_folder(pages: DataFrame) -> str:
    return shared_folder(pages.sparkSession, "warc")
