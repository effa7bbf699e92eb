"""Operators over pages and conversations: brute force, exact round trips, split points."""

import base64
import hashlib
import random
import zlib
from pathlib import Path

import pytest

from weekloom.llm import chat, url_filter, warc

PAGE = "page_id long, url string, html string, host string, subject string, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], PAGE)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:at], rest[at:]
    end = min((rest.find(c) for c in "?#" if c in rest), default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


URLS = [None, "", "no scheme", "http://", "http://ORG", "http://org/", "https://a.b.org/x?y", "http://xorg/", "http://example.org/es/1", "http://www.example.org/es", "http://m.example.org/en/123", "http://example.org/en/2",
        "http://É.com/fr/", "ftp://a.com/de/#t", "http://a.com?x=/fr/", "http://a.com/FR/", "x://y://z.org/", "http://www.cheap-pills.net/a", "http://cheap-pills.org/", "http://a.com/cheap-pills./",
        "http://b.org/\nline", "http://user:pw@example.org/es/", "http://example.org:80/es/"] * 2


@pytest.mark.parametrize("block", [1, 2, 100])
def test_url_filter(spark, block):
    got = url_filter.filter_urls(pages(spark, [(i, u, "") for i, u in enumerate(URLS)]), block_rules=block).collect()
    assert len(got) == len(URLS)
    for r in got:
        host, path = split(URLS[r.page_id])
        best = None
        for rule in url_filter.LISTED:
            h, p = rule.pattern.split("/", 1)
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule.pattern) > len(best.pattern)):
                best = rule
        verdict = best.action if best else "block" if any(x in host + path for x in ("cheap-pills.", "cheap-meds.", "online-casino.")) else "allow"
        assert (r.host, r.path, r.rule if r.rank == 1 else None, r.verdict) == (host, path, best and best.pattern, verdict), URLS[r.page_id]


def test_url_rules_are_fetched_by_their_rarest_token(spark):
    rules = [url_filter.Rule("block", "com/de/"), url_filter.Rule("allow", "org/"), url_filter.Rule("block", "*x*y")]
    index = url_filter.indexed(rules, {"com": 9, "de": 2, "org": 5})
    assert {t: [r.pattern for r in rs] for t, rs in index.items()} == {"de": ["com/de/"], "org": ["org/"], "": ["*x*y"]}
    assert url_filter.filter_urls(pages(spark, []).limit(0)).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(pages(spark, [(1, "http://a.org/", None)]), rules=()).collect()} == {"allow"}


HARD = ["", "\\", "\\\\", "</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\n", "<|>", "<\\|im_end|>", "\\<|", "a\nb\r\n", "é😀", "<</SYS>><<SYS>>", "\\n", "<s", "s>"]


def test_escape_is_reversible():
    rng = random.Random(3)
    alphabet = ["\\", "<", "|", ">", "/", "s", "[", "]", "I", "N", "S", "T", "\n", "n", "<|im_end|>", "</s>"]
    for text in HARD + ["".join(rng.choices(alphabet, k=rng.randint(0, 12))) for _ in range(3000)]:
        hidden = chat.escape(text)
        assert chat.unescape(hidden) == text
        assert not any(c in hidden for c in chat.CONTROL)
        assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


def test_conversations_come_back(spark):
    rows = [(c, t, ["user", "assistant", None, "system"][(c + t) % 4], HARD[(c * 5 + t) % len(HARD)]) for c in range(6) for t in range(1 + c * 7)]
    rows += [(50, None, "user", None), (50, 1, "assistant", "tie b"), (50, 1, "assistant", "tie a"), (50, 1, "assistant", "tie a"), (None, 0, "user", "nobody")]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, node int")
    got = {r.conv: r for r in chat.format_trees(chat.thread_of(turns)).collect()}
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert got.keys() == want.keys()
    for c, said in want.items():
        assert chat.parse_turns(got[c].formatted) == said
        assert [chat.unescape(got[c].formatted[s.start : s.end]) for s in got[c].loss] == [t for r, t in said if r == "assistant"]
        assert got[c].depth == len(said)
    assert chat.format_trees(chat.thread_of(turns.limit(0))).count() == 0


def test_reply_trees(spark):
    rng = random.Random(8)
    rows = []
    for conv in range(5):
        for n in range(1, 60):
            rows.append((conv, n, rng.choice([None, 0, 999] + list(range(max(1, n - 4), n))) if n > 1 else None, "user", f"{conv}.{n}", round(rng.random(), 3) if n % 7 else None))
    rows += [(9, 1, 2, "user", "cycle", 1.0), (9, 2, 1, "user", "cycle", 1.0), (9, 3, 2, "user", "below", 1.0), (9, 4, 4, "user", "self", 1.0), (9, None, 1, "user", "nameless", 1.0), (9, 5, None, "user", "whole", None)]
    tree = spark.createDataFrame(rows + [rows[0]], "conv long, node long, parent long, role string, text string, score double")
    got = {}
    for r in chat.format_trees(tree, branches=2).collect():
        got[(r.conv, r.rank)] = [t for _, t in chat.parse_turns(r.formatted)]
    want = {}
    for conv in {r[0] for r in rows}:
        nodes = {r[1]: r for r in rows if r[0] == conv and r[1] is not None}
        paths = []
        for leaf in set(nodes) - {r[2] for r in nodes.values()}:
            path, seen, at = [], set(), leaf
            while at in nodes and at not in seen:
                seen.add(at)
                path.append(at)
                at = nodes[at][2]
            if at not in seen:
                paths.append((-sum(nodes[x][5] or 0 for x in path) / len(path), -len(path), leaf, path[::-1]))
        for rank, p in enumerate(sorted(paths)[:2], 1):
            want[(conv, rank)] = [nodes[x][4] for x in p[3]]
    assert got == want


def test_no_tree_of_a_conversation_is_lost(spark):
    rows = [(1, 1, None, 0.9), (1, 2, 1, 0.9), (1, 3, 1, 0.1), (1, 4, 77, 0.2), (1, 5, 4, 0.3), (1, 6, 4, 0.2), (1, 7, 88, 0.0), (2, 1, None, None)]
    tree = spark.createDataFrame([(c, n, p, "user", f"{c}.{n}", s) for c, n, p, s in rows], "conv long, node long, parent long, role string, text string, score double")

    def paths(**how):
        return sorted((r.conv, r.leaf, r.rank, r.depth) for r in chat.format_trees(tree, **how).collect())
    assert paths(branches=1, per_root=True) == [(1, 2, 1, 2), (1, 5, 1, 2), (1, 7, 1, 1), (2, 1, 1, 1)]
    assert paths(branches=None, per_root=True) == [(1, 2, 1, 2), (1, 3, 2, 2), (1, 5, 1, 2), (1, 6, 2, 2), (1, 7, 1, 1), (2, 1, 1, 1)]
    assert paths() == [(1, 2, 1, 2), (1, 3, 2, 2), (1, 5, 3, 2), (1, 6, 4, 2), (1, 7, 5, 1), (2, 1, 1, 1)]
    assert paths(branches=1) == [(1, 2, 1, 2), (2, 1, 1, 1)]


def test_warc_round_trip(spark):
    rng = random.Random(4)
    rows = [(i, f"http://h/{i}\r\nX: %41é" if i % 9 == 0 else f"http://h/{i}", rng.choice([None, "", "same", f"page {i} é" * rng.randint(1, 900), "twice" + str(i % 5)])) for i in range(200)]
    rows += [(200, None, "".join(chr(rng.randrange(32, 1000)) for _ in range(200_000))), (None, "http://n", "same"), (None, "http://n", "only nameless"), (3, "http://again", rows[3][2])]
    table = pages(spark, rows).repartition(3)
    manifest = warc.write_archive(table, warc.archive_folder(table))
    assert manifest.agg({"records": "sum"}).first()[0] == len(rows)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        refers = first[h or ""] if i is not None and i > first[h or ""] else None
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if refers is not None else "response", refers))
    for size in (997, 1 << 16, 1 << 30):   # every split gives each record once
        got = [(r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archive(manifest, range_bytes=size).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    texts = {r.id: bytes(r.payload).decode() for r in warc.read_archive(manifest, payloads=True).collect() if r.record_type == "response" and r.id is not None}
    assert all(texts[i] == (h or "") for i, _, h in rows if i in texts)
    assert warc.read_archive(warc.write_archive(table.limit(0), warc.archive_folder(table))).count() == 0


def test_small_payloads_are_all_responses(spark):
    table = pages(spark, [(1, "u", "abc"), (2, "u", "abc"), (3, "u", "longer text"), (4, "u", "longer text")])
    got = {r.id: r.refers_to for r in warc.read_archive(warc.write_archive(table, warc.archive_folder(table), min_bytes=5)).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 3}


class _Bytes:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at : at + n]


def test_reader_passes_over_what_is_no_record():
    one, two = (warc.member(warc.record_bytes(i, "u", b"payload", "D", None)) for i in (1, 2))
    other = zlib.compressobj(9, zlib.DEFLATED, 31)
    plain = other.compress(b"no record") + other.flush()
    head = b"junk\x1f\x8b\x08junk"
    data = head + one + plain + two[:-9] + two
    starts = [at for at, _ in warc.records_in(warc._Source(_Bytes(data), len(data)), 0, len(data))]
    assert starts == [len(head), len(data) - len(two)]


@pytest.mark.parametrize("damage", ["inside", "cut"])
def test_damaged_archive_fails(spark, damage):
    table = pages(spark, [(i, f"http://h/{i}", f"page {i} " * 50) for i in range(60)]).repartition(2)
    manifest = warc.write_archive(table, warc.archive_folder(table))
    assert warc.read_archive(manifest).count() == 60
    path = Path(manifest.orderBy("path").first().path)
    data = bytearray(path.read_bytes())
    if damage == "cut":
        del data[-5:]
    else:
        data[len(data) // 2] ^= 0xFF
    path.write_bytes(data)
    with pytest.raises(ValueError, match=f"1 files .*{path.name} gave"):
        warc.read_archive(manifest)
    assert 0 < warc.read_archive(manifest, complete=False).count() < 60
    with pytest.raises(ValueError, match="no column records"):
        warc.read_archive(manifest.drop("records"))


def test_ranges_are_dealt_to_as_many_tasks(spark):
    """Rows of ranges are tiny; adaptive execution would put them all into one task."""
    files = spark.createDataFrame([(f"/nowhere/{i}", 100 << 20) for i in range(12)], "path string, bytes long")
    got = warc.read_archive(files, complete=False)
    plan = got._jdf.queryExecution().executedPlan().toString()
    n = 12 * -(-(100 << 20) // warc.RANGE_BYTES)
    assert f", {n}), REPARTITION_BY_NUM" in plan
