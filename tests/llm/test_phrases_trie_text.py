"""Phrases, prefix tries and page texts against plain Python, over hard rows."""

import hashlib
import html as H
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import low
from weekloom.llm import html_text, phrases, trie

PIECE, WORD = re.compile("[.,;:!?\x0a-\x0d]"), re.compile("[^\x20\x09]+")


def brute_phrases(rows, least, max_len, top, covered):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in PIECE.split(low(text)):
            ws = WORD.findall(piece)
            n[lang] += len(ws)
            for k in range(1, max_len + 1):
                f[lang].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            if any(100 * b >= covered * a for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            cuts = [(1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def phrase_rows(seed=3, n=400):
    rng = random.Random(seed)
    words = ["a", "B", "çà", "dé", "e1", "f-f", "G", "zz", " ", "😀x", "'"]
    rows = []
    for i in range(n):
        text = "".join(rng.choices(words, [9, 7, 5, 4, 3, 2, 2, 1, 1, 1, 1])[0] + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "\r\n", " ; ", "\x0b"]) for _ in range(rng.randint(0, 40)))
        rows.append((rng.choice(["en", "en", "en", "de", None, "und", ""]), text))
    return rows + [(None, None), ("en", ""), ("xx", None), ("en", "..."), ("en", "hot word " * 3000), ("de", "x" * 5000)] + rows[:50]


@pytest.mark.parametrize("max_len,least,shards,block", [(3, 10, 4, 600), (2, 3, 3, 1 << 23), (4, 5, 2, 300)])
def test_phrases(spark, max_len, least, shards, block):
    rows = phrase_rows(max_len)
    docs = spark.createDataFrame([(*r, 1, 2, 3, "q") for r in rows], "lang string, text string, n long, k1 long, length int, key string").repartition(5)
    got = phrases.collocations(docs, least=least, max_len=max_len, top=60, shards=shards, block_bytes=block, open_bytes=4 * block)
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, least, max_len, 60, 50)


def test_phrases_without_documents(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(empty).count() == 0
    assert phrases.collocations(spark.createDataFrame([("en", None), ("en", " ")], "lang string, text string"), top=None).count() == 0


def test_phrase_counts_take_one_full_cycle():
    """Whatever is published when: every phrase is counted in each shard at most once, and in all of them once its parts are known."""
    rng = random.Random(1)
    blocks = [phrases._block([" ".join(rng.choices("abcdefgh", k=50)).encode()], "en", s, 0) for s in range(3)]

    class Held:
        def __init__(self, bits, keys):
            self.value = bytearray(1 << bits - 3)
            for places in phrases._places(keys, bits):
                for p in places.tolist():
                    self.value[p >> 3] |= 1 << (p & 7)
    read = [(np.frombuffer(b["keys"], np.uint64), np.frombuffer(b["ids"], np.int32)) for b in blocks]
    everything = np.unique(np.concatenate([k for k, _ in read]))
    pairs = Counter()
    for keys, ids in read:
        words = keys[np.where(ids < 0, ~ids, ids)]
        pairs.update(zip(words[:-1].tolist(), words[1:].tolist()))
    # half of the words are published after step 0, the others after step 2
    published = {1: [(0, 15, Held(15, everything[::2])), (2, 15, Held(15, everything[1::2]))], 2: []}
    counted = Counter()
    for step in range(3 + 3):
        seen = {1: [x for x in published[1] if x[0] < step], 2: []}
        for length, _, columns, counts in phrases.count_block(*read[step % 3], step, 3, 3, seen):
            if length == 2:
                counted.update(dict(zip(zip(*(c.tolist() for c in columns)), counts.tolist())))
    assert counted == pairs


def test_phrases_that_pass_a_bitmap_early_are_counted_in_all_shards():
    """A pair that passes by chance before its own words are published starts no cycle of the phrases around it."""
    rng = random.Random(2)
    blocks = [phrases._block([" ".join(rng.choices("abcdefgh", k=80)).encode()], "en", s, 0) for s in range(3)]

    class Held:
        def __init__(self, keys=None):
            self.value = bytearray((b"\xff" if keys is None else b"\x00") * (1 << 12))
            for places in () if keys is None else phrases._places(keys, 15):
                for p in places.tolist():
                    self.value[p >> 3] |= 1 << (p & 7)
    read = [(np.frombuffer(b["keys"], np.uint64), np.frombuffer(b["ids"], np.int32)) for b in blocks]
    everything = np.unique(np.concatenate([k for k, _ in read]))
    triples = Counter()
    for keys, ids in read:
        words = keys[np.where(ids < 0, ~ids, ids)].tolist()
        triples.update(zip(words[:-2], words[1:-1], words[2:]))
    published = {1: [(0, 15, Held(everything[::2])), (2, 15, Held(everything[1::2]))], 2: [(1, 15, Held())]}
    counted = Counter()
    for step in range(8):
        seen = {length: [x for x in published[length] if x[0] < step] for length in published}
        for length, _, columns, counts in phrases.count_block(*read[step % 3], step, 3, 3, seen):
            if length == 3:
                counted.update(dict(zip(zip(*(c.tolist() for c in columns)), counts.tolist())))
    assert counted == triples


def test_long_regular_words_differ():
    """Thue and Morse's words have equal polynomials modulo 2^64, whatever the base."""
    word = b"a"
    for _ in range(12):
        word += word.translate(bytes.maketrans(b"ab", b"ba"))
    other = word.translate(bytes.maketrans(b"ab", b"ba"))
    assert sorted(phrases._block([word + b" hot", other + b" hot"], "en", 0, 0)["words"].to_pylist()) == sorted(w.decode() for w in (word, other, b"hot"))


def test_hashes_of_long_words_and_passes(monkeypatch):
    text = b" ".join(bytes([97 + i % 26]) * (i % 50 + 1) for i in range(500)) + b" " + b"q" * 300 + b" " + b"q" * 300
    whole = phrases._block([text], "en", 0, 0)
    monkeypatch.setattr(phrases, "PASS_BYTES", 128)
    phrases._powers.cache_clear()
    parts = phrases._block([text], "en", 0, 0)
    phrases._powers.cache_clear()
    assert set(whole["words"].to_pylist()) == set(parts["words"].to_pylist()) and len(parts["words"]) == len(set(text.split()))


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5((hashlib.md5(role.encode()).hexdigest() + hashlib.md5(text.encode()).hexdigest()).encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, role, digest, text))
    own = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - c % 100, [])[:h] + ts[h:]
    nodes = defaultdict(lambda: {"members": [], "ends": []})
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            nodes[tuple(ts[:d])]["members"].append(c)
        nodes[tuple(ts)]["ends"].append(c)
    children = Counter(p[:-1] for p in nodes if p)
    leaves, saved = Counter(), Counter()
    for p, v in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(v["members"]) - 1) * len(p[-1][1]) if p else 0
    return sorted((min(v["members"]), len(p), -1 if not p else min(nodes[p[:-1]]["members"]), len(v["members"]), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(v["ends"]))).encode()).hexdigest()) for p, v in nodes.items())


def trie_of(spark, rows, **options):
    turns = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "conv_id long, turn long, role string, text string, ids string, conv long, key long").repartition(3)
    conv = F.col("conv")
    built = trie.with_openings(trie.sequences(turns), conv - conv % 100, F.crc32(conv.cast("string").cast("binary")) % 6, 5)
    return sorted((r.conv, r.depth, -1 if r.parent_conv is None else r.parent_conv, r.n_convs, r.n_children, r.n_leaves, r.saved, r.ends)
                  for r in trie.prefix_trie(built, **options).collect())


def trie_rows():
    rng = random.Random(8)
    rows = []
    for c in rng.sample(range(900), 260):
        for t in range(rng.randint(1, 7)):
            rows.append((c, None if t == 0 and c % 7 == 0 else t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "hello", "é😀", None, "x" * 40, "ok"])))
    rows += [(c, t, "user", "same") for c in range(1000, 1090) for t in range(6)]            # one large group of equal conversations
    rows += [(2000, t, "user", str(t % 3)) for t in range(300)]                              # a long one
    rows += [(2001, 1, "b", "tie"), (2001, 1, "a", "tie"), (2001, 1, "a", "tie"), (None, 1, "user", "nobody")]
    return rows + rows[:40]


@pytest.mark.parametrize("options", [{}, {"block_turns": 9, "bucket": 7}, {"block_turns": 1}])
def test_prefix_trie(spark, options):
    rows = trie_rows()
    assert trie_of(spark, rows, **options) == brute_trie(rows)


def test_prefix_trie_edges(spark):
    assert trie_of(spark, []) == []
    assert trie_of(spark, [(None, 1, "user", "x")]) == []
    one = [(107, 1, "user", "x")]
    assert trie_of(spark, one) == brute_trie(one)
    # blocks whose last conversation is the start of the next block's first
    chain = [(c, t, "user", "y") for c in range(10, 30) for t in range(c)]
    assert trie_of(spark, chain, block_turns=1) == brute_trie(chain)


def test_ternary_tree_is_balanced():
    block = trie.Block([([i, 5], [1, 1], 1, i, "") for i in range(1023)])

    def height(at):
        most, waiting = 0, [(block.eq[at], 1)]
        while waiting:
            i, d = waiting.pop()
            if i >= 0:
                most = max(most, d)
                waiting += [(block.lo[i], d + 1), (block.hi[i], d + 1)]
        return most
    assert height(0) == 10


STORY = ["The ferry left at nine with forty people aboard, and the harbour was quiet again soon after.", "Nobody on the pier had seen the weather turn so fast, said the harbour master on Monday.", "Rain."]
BODY = "".join(f"<p>{p}</p>" for p in STORY)
JUNK = '<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News of the whole world today</a></li></ul></nav>'

PAGES = [
    ("article", f"<html><head><title>T</title><style>p{{}}</style></head><body>{JUNK}<article><h1>Ferry</h1>{BODY}</article><footer>&copy; Ferry News, all rights reserved, since 1901.</footer></body></html>", ["Ferry", *STORY]),
    ("no end tags", f"<body>{JUNK}<article><h1>Ferry<p>{STORY[0]}<p><b>{STORY[1]}<p>{STORY[2]}</article><footer>contact us", ["Ferry", *STORY]),
    ("div soup", f'<body><div class="top-nav"><a href="/">Home</a> <a href="/n">News</a></div><div id="wrap"><div><h1>Ferry</h1>{BODY}</div></div><div class="sidebar">{BODY.upper()}</div><div class="footer">{STORY[0]}</div></body>', ["Ferry", *STORY]),
    ("comments", f'<body><main><h1>Ferry</h1>{BODY}<section id="comments"><h2>Comments</h2><article class="comment"><p>{STORY[1]} I agree!</p></article></section></main></body>', ["Ferry", *STORY]),
    ("notices, forms, adverts", f'<body><div class="cookie-banner"><p>{STORY[0]}</p><button>Accept</button></div><form action="/s"><label>Search</label><input name="q"></form><article>{BODY}<div class="ad">Buy our boats, they are very good boats indeed.</div><aside><p>{STORY[1]}</p></aside></article><div role="alert">{STORY[0]}</div></body>', STORY),
    ("form around the page", f'<body><form id="aspnet"><div class="menu"><a href="/">Home</a></div><article>{BODY}</article></form></body>', STORY),
    ("spaces and references", "<article><p>a&nbsp;&amp;\n\n b&#233;&eacute;&#x1F600; <b>x</b>y<br>z &am &amp</p>\n<p> </p></article>", ["a & béé😀 xy z &am &"]),
    ("scripts", "<body><script>var t='</p>';if(a<b){}</script><article><p>one</p><script>x</script><p>two</p><noscript>no</noscript></article><style>a{}</style><!-- c --><![CDATA[ d ]]></body>", ["one", "two"]),
    ("hidden", f'<body><article>{BODY}<p hidden>secret</p><p style="display: none">secret</p><p aria-hidden="true">secret</p></article></body>', STORY),
    ("header in an article", f"<body><header><h1>Site</h1><p>{STORY[0]}</p></header><article><header><h1>Ferry</h1></header>{BODY}</article></body>", ["Ferry", *STORY]),
    ("lists and tables", "<article><h2>Boats</h2><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table><blockquote>q</blockquote></article>", ["Boats", "one", "two", "a", "b", "c", "q"]),
    ("no container", f"<body>{JUNK}<h1>Ferry</h1>{BODY}<p>{STORY[0]} Again.</p>{JUNK}</body>", ["Ferry", *STORY, STORY[0] + " Again."]),
    ("names of wrappers", f'<body class="no-sidebar"><div class="main-nav"><p>{STORY[0]}</p></div><div class="content-sidebar-wrap"><div class="page-with-sidebar has-ad"><div class="post-content">{BODY}<div class="article-footer">{STORY[1]}</div><p class="alert alert-info">{STORY[0]}</p></div></div></div><div class="ad-slot">{STORY[0]}</div><div id="comment-list">{BODY}</div></body>', STORY),
    ("plain text", "just  some\n text", ["just some text"]),
    ("only boilerplate", f"<body>{JUNK}<footer>x</footer></body>", []),
    ("cut off", "<body><article><p>one two</p><p>three <a href='", ["one two", "three"]),
    ("strange marks", "<article><p>1 < 2 <! odd> <![weird[x]]> & 3</p></article>", None),
    ("null", None, []), ("empty", "", []), ("spaces", " \n ", []),
]


@pytest.mark.parametrize("name,page,blocks", PAGES, ids=[p[0] for p in PAGES])
def test_main_text(name, page, blocks):
    text = html_text.main_text(page)
    if blocks is None:
        assert text.startswith("1 < 2") and text.endswith("3")
    else:
        assert text.split("\n") == (blocks or [""])


def test_smoothing_and_clusters():
    assert html_text.smoothed([5.0]) == [5.0] and html_text.content_lines([]) == []
    flat = html_text.smoothed([0, 0, 9, 0, 0])
    assert flat[2] == max(flat) and flat[1] == pytest.approx(flat[3]) and flat[0] > 0


def test_deep_and_long_pages():
    assert html_text.main_text("<div>" * 50000 + "deep" + "</div>" * 50000) == "deep"
    assert len(html_text.main_text("<article>" + "<p>word word</p>" * 20000 + "</article>").split("\n")) == 20000


def test_pages_of_the_tables(spark):
    """All given pages have one layout, which a pattern can read."""
    path = "/root/testdata/sf0.01/pages.parquet"
    rows = pq.read_table(path).to_pandas()
    got = {r.page_id: r for r in html_text.extract_text(spark.read.parquet(path).withColumn("text", F.lit("x"))).collect()}
    assert len(got) == len(rows)
    for page_id, url, page in rows[["page_id", "url", "html"]].itertuples(index=False):
        inside = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
        blocks = [" ".join(H.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>|<br>", inside)]
        expected = "\n".join(b for b in blocks if b)
        assert (got[page_id].url, got[page_id].text, got[page_id].n_chars) == (url, expected, len(expected))


def test_pages_keep_other_columns(spark):
    pages = spark.createDataFrame([(1, None, "<p>a</p>"), (1, None, "<p>a</p>"), (None, "u", None)], "page_id long, lines string, html string")
    got = html_text.extract_text(pages).collect()
    assert Counter((r.page_id, r.text, r.n_chars) for r in got) == {(1, "a", 1): 2, (None, "", 0): 1} and got[0].__fields__ == ["page_id", "lines", "html", "text", "n_chars"]
    assert html_text.extract_text(pages.limit(0)).count() == 0
