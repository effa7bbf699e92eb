"""Operators over documents against brute force, with nulls, repeats, ties, empty tables and clashing columns."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from weekloom.llm import components, decontaminate, exact_dedup, fuse, lm_score, mixing, near_dedup, pii, toxicity
from weekloom.llm.common import text_key, without

SCHEMA = "doc_id long, text string, digest string, side string, id string, n string, h string"


def frame(spark, rows):
    """Documents with extra columns that bear names the operators use inside."""
    return spark.createDataFrame([(*r, "x", "y", "z", "w", "v") for r in rows], SCHEMA)


def texts(seed=0, n=40):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 60))) for _ in range(n // 4)]
    out = [None, "", "  \t\n ", "One", "one", "ONE two", "one two", "é É", "É É", "x " * 3000]
    for b in base:
        ws = b.split()
        out.append(b)
        out.append(b.upper())
        ws[rng.randrange(len(ws))] = "changed"
        out.append(" ".join(ws))
        out.append(b + " tail " + " ".join(rng.choices(vocabulary, k=2)))
    rows = list(enumerate(out)) + [(None, out[10]), (None, "nameless"), (5, out[5]), (7, "another text under a known id")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n", [0, 1, 2, 7, 100, 5000])
def test_fuse_filter_knows_its_keys(n):
    keys = np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64)
    built = fuse.build(np.concatenate([keys, keys[:1]]))
    assert fuse.contains(keys, *built).all()
    other = np.random.default_rng(n + 1).integers(0, 1 << 63, 20_000).astype(np.uint64)
    assert fuse.contains(other, *built).mean() < 0.002


@pytest.mark.parametrize("parts", ["halves", "no snapshot", "no batch"])
def test_exact_dedup(spark, parts):
    rows = texts()
    docs = frame(spark, rows)
    empty = docs.limit(0)
    split = {"halves": exact_dedup.halves(docs), "no snapshot": (empty, docs), "no batch": (docs, empty)}[parts]
    got = sorted(((r.id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_dedup(*split, shard_keys=8).collect()), key=str)
    groups = {}
    for d, t in rows:
        groups.setdefault(brute.low(t), []).append(d)
    want = []
    for d, t in rows:
        ids = groups[brute.low(t)]
        keep = max((i for i in ids if i is not None), default=None)
        want.append((d, keep, len(ids), d == keep, hashlib.sha256(brute.low(t).encode()).hexdigest()))
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80), (2, 50)])
def test_near_duplicates(spark, words, percent):
    rows = texts(3, 60)
    got = sorted(((r.id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(frame(spark, rows), words, percent).collect()), key=str)
    want = [(d, n, c, d == c) for d, n, c in brute.near(rows, words, percent)]
    assert got == sorted(want, key=str)


def test_near_duplicates_in_a_large_bucket(spark, monkeypatch):
    """One group with members on either side of the threshold, dealt over several blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for d in range(150):
        ws = list(base)
        for _ in range(rng.choice([1, 2, 3, 4, 6, 9])):
            ws[rng.randrange(len(ws))] = f"r{rng.random()}"
        rows.append((d, " ".join(ws)))
    got = {r.id: r.component_id for r in near_dedup.near_duplicates(frame(spark, rows), 3, 85).collect()}
    assert got == {d: c for d, _, c in brute.near(rows, 3, 85)}


def test_near_duplicates_hand_on_no_pairs_of_a_large_group(spark, monkeypatch):
    """Many members short of the threshold are held against all others, in groups of several sizes; rows follow the members, not their pairs."""
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 4000)
    monkeypatch.setattr(near_dedup, "PART", 32)
    made, stored = [], near_dedup.stored

    def counted(df, name):
        made.append((name, stored(df, name)))
        return made[-1][1]
    monkeypatch.setattr(near_dedup, "stored", counted)
    rng = random.Random(8)
    rows = []
    for size in (240, 40, 3, 2):
        base = [f"s{size}w{i}" for i in range(150)]
        for _ in range(size):
            ws = list(base)
            for at in rng.sample(range(150), rng.choice([1, 2, 4, 5, 5])):
                ws[at] = f"r{rng.random()}"
            rows.append((len(rows), " ".join(ws)))
    got = {r.id: r.component_id for r in near_dedup.near_duplicates(frame(spark, rows), 3, 85).collect()}
    assert got == {d: c for d, _, c in brute.near(rows, 3, 85)}
    assert max(frame.count() for name, frame in made if name in ("pairs", "links", "more")) <= near_dedup.FIRST * len(rows)


def test_near_duplicates_of_nothing(spark):
    assert near_dedup.near_duplicates(frame(spark, []).limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 140)] + [(0, i) for i in range(1, 30)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    want = {x: find(x) for x in list(root) if find(x) != x}
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == want


def test_decontaminate(spark):
    rng = random.Random(2)
    words = [f"k{i}" for i in range(30)] + ["é", "ß1"]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 2, 3, 9, 10, 11, 25])))) for i in range(12)] + [(None, " ".join(words[:12])), (3, "k1-k2"), (20, None), (21, " .,! "), (22, "K5 k6, k7")]
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, w string")
    rows = texts(4)
    for d in range(60):
        parts = [" ".join(rng.choices(words, k=rng.randint(0, 20))), rng.choice(items)[1] or "", " ".join(rng.choices(words, k=5))]
        rows.append((1000 + d, ". ".join(parts).replace("k1 ", "K1--")))
    wins = brute.windows(items)
    got = sorted(((r.id, r.n_words, r.n_hit, list(r.item_list)) for r in decontaminate.decontaminate(frame(spark, rows), bench, bits=8).collect()), key=str)
    assert got == sorted(((d, *brute.hits(t, wins)) for d, t in rows), key=str)
    none = decontaminate.decontaminate(frame(spark, rows), bench.limit(0))
    assert none.count() == len(rows) and none.filter("n_hit > 0").count() == 0
    assert decontaminate.decontaminate(frame(spark, rows).limit(0), bench).count() == 0


def test_pii(spark):
    rows = texts(6)[:10] + list(enumerate([
        "mail a@b.c_x@d.e.f, ..@x.y and a@b", "1.2.3.4.5.6.7.8 999.1.1.1 007.0.0.255", "4111 1111 1111 1111, 4111-1111-1111-1112 0" + "0" * 40, "call +49 (0)30 1234567 or +1 2", "é 😀 a@b.co +12 345 678 90",
        "1 " * 20_000, "a" * 50_000, "9" * 60_000, "IBAN GB82 WEST 1234 5698 7654 32 or DE89370400440532013000, not DE89370400440532013001", "x@y.z " * 700, "+" * 1000 + "1" * 12], start=100))
    found = pii.find_pii(frame(spark, rows)).select("doc_id", "text", "pii", pii.span_list(F.filter("pii", lambda s: s["kind"] != "iban")).alias("base"))
    for r in found.collect():
        assert r.base == ",".join(brute.pii(r.text)), r.doc_id
        for s in r.pii:
            assert 0 < s.end - s.start and s.kind in {k.name for k in pii.KINDS}
            if s.kind == "iban":
                assert r.text[s.start : s.end] in ("GB82 WEST 1234 5698 7654 32", "DE89370400440532013000")
    assert found.select(F.explode("pii").alias("s")).filter("s.kind = 'iban'").count() == 2
    assert pii.find_pii(frame(spark, rows).limit(0)).count() == 0


def mix_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size long, weight string, target string")


def test_mixing(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["a", "b", "c", "d", None, "é"]), 1, "x", "y") for i in range(3000)] + [(None, None, "a", 1, "x", "y"), (1, "w w", "empty?", 1, "x", "y"), (5000, "", "void", 1, "x", "y")]
    got = mixing.mixed(mix_frame(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes, targets, taken = {}, {}, {}
    for r in got:
        assert r.mix_size == len((r.text or "").split()) and 0 <= r.mix_copies <= 2
        sizes[r.source] = sizes.get(r.source, 0) + r.mix_size
        taken[r.source] = taken.get(r.source, 0) + r.mix_size * r.mix_copies
        targets[r.source] = r.mix_target
    # the contract's sharing, written as a loop
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(names)}
    want, left, free = {}, 1.5 * sum(sizes.values()), set(names)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            want[s], left = 2.0 * sizes[s], left - 2 * sizes[s]
        free -= over
    want |= share
    for s in names:
        assert abs(targets[s] - want[s]) < 1e-6 * max(1, want[s]), s
        if sizes[s] > 1000:
            assert abs(taken[s] - targets[s]) < 0.1 * targets[s] + 100
    again = {(r.doc_id, r.text): r.mix_copies for r in mixing.mixed(mix_frame(spark, rows).repartition(5)).collect()}
    assert again == {(r.doc_id, r.text): r.mix_copies for r in got}
    assert mixing.emitted(mixing.mixed(mix_frame(spark, rows))).count() == sum(r.mix_copies for r in got)
    assert mixing.mixed(mix_frame(spark, []).limit(0)).count() == 0


def toxic_tables(spark, n=600):
    rng = random.Random(11)
    words = [f"t{i}" for i in range(300)]
    docs, labels = [], []
    for d in range(n):
        y = int(rng.random() < 0.2)
        ws = rng.choices(words, k=rng.randint(20, 80))
        if y:
            for _ in range(3):
                ws[rng.randrange(len(ws))] = rng.choice(["nasty", "vileness", "vilely"])
        docs.append((d, " ".join(ws)))
        labels.append((d, y))
    return docs, labels


def test_toxicity_learns_and_is_exact(spark):
    docs, labels = toxic_tables(spark)
    table = frame(spark, docs + [(None, None), (9000, ""), (9001, "unknown words only")])
    index = toxicity.fit(table, spark.createDataFrame(labels + [(0, None), (7777, 1), (None, 1)], "doc_id long, toxic int"), per_class=200)
    scored = {(r.doc_id, r.text): r for r in toxicity.score(table, index).collect()}
    assert len(scored) == len(docs) + 3 and all(0 <= r.toxicity.score <= 1 for r in scored.values())
    held = [d for d in labels if d[0] is not None and __import__("zlib").crc32(str(d[0]).encode()) % 5 == 0]
    right = sum((scored[(d, docs[d][1])].toxicity.score >= 0.5) == bool(y) for d, y in held)
    assert right / len(held) > 0.93
    assert not any(i in {str(d) for d, _ in held} for i in index.ids)
    # the blocks give what a full scan gives
    flat = np.concatenate(list(index.weights), axis=1)[:, : len(index.labels)]
    for d, t in docs[:60]:
        at, w = index.query(t)
        who, sim = index.nearest(at, w)
        full = w @ flat[at] if len(at) else np.zeros(len(index.labels))
        best = np.lexsort((np.arange(len(full)), -full))[: toxicity.NEIGHBOURS]
        assert np.allclose(full[best][full[best] > 0], sim)


def test_toxicity_without_labels(spark):
    docs = frame(spark, [(1, "a b"), (2, None)])
    for labels in ([], [(1, 0), (2, 0)], [(5, 1)]):
        index = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert {r.toxicity.score for r in toxicity.score(docs, index).collect()} <= {0.0, toxicity.score(docs, index).first().toxicity.score}
        assert toxicity.score(docs, index).filter("toxicity.score >= 0.5").count() == 0


def test_lm_score(spark):
    rng = random.Random(13)
    left, right = [f"l{i}" for i in range(40)], [f"r{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(left if i % 3 else right, k=rng.randint(1, 40)))) for i in range(90)] + [(None, None), (500, " \t"), (501, "L1 l2")]
    labels = [(i, int(i % 3 > 0)) for i in range(60)] + [(None, 1), (3, None), (1, 1)]
    table = frame(spark, docs)
    target = lm_score.labelled(table, spark.createDataFrame(labels, "doc_id long, quality int"))
    got = {(r.doc_id, r.text): r.lm for r in lm_score.score(table, target, table.repartition(4)).collect()}

    ids = lm_score.WordIds()
    bucket = {w: ids[w] for w in [lm_score.START] + [x.encode() for x in left + right]}

    def chain(text):
        return [bucket[lm_score.START]] + [bucket[w] for w in (text or "").lower().encode().split()]

    def model(texts):
        ones, twos = {}, {}
        for t in texts:
            c = chain(t)
            for w in c if len(c) > 1 else []:
                ones[w] = ones.get(w, 0) + 1
            for p in lm_score.pair_ids(np.array(c, dtype=np.uint64)).tolist():
                twos[p] = twos.get(p, 0) + 1
        return ones, twos
    good = {d for d, q in labels if q == 1}
    a, b = model([t for d, t in docs if d in good]), model([t for _, t in docs])
    scale = sum(a[0].values()) / sum(b[0].values())
    for d, t in docs:
        c, r = chain(t), got[(d, t)]
        assert r.n_tokens == len(c) - 1
        if len(c) == 1:
            assert (r.ce_target, r.ce_background, r.score) == (None, None, 0.0)
            continue
        ce = []
        for (ones, twos), f in ((a, 1.0), (b, scale)):
            n, loss = sum(ones.values()) * f, 0.0
            pairs = lm_score.pair_ids(np.array(c, dtype=np.uint64)).tolist()
            for v, w, p in zip(c, c[1:], pairs):
                one = (ones.get(w, 0) * f + lm_score.DELTA) / (n + lm_score.DELTA * 2**lm_score.WORD_BITS)
                loss -= np.log((twos.get(p, 0) * f + lm_score.MU * one) / (ones.get(v, 0) * f + lm_score.MU))
            ce.append(loss / (len(c) - 1))
        assert np.allclose([r.ce_target, r.ce_background, r.score], [*ce, ce[1] - ce[0]], rtol=1e-5)
    assert np.mean([got[d].score for d in docs[:90] if d[0] % 3]) > np.mean([got[d].score for d in docs[:90] if not d[0] % 3]) + 0.2
    assert lm_score.score(table.limit(0), target.limit(0), table.limit(0)).count() == 0


@pytest.mark.parametrize("vocabulary", [1000.0, None])
def test_lm_score_counts_every_ngram_apart(spark, vocabulary):
    """300,000 words and as many bigrams: buckets of any fixed number of bits below would share counts."""
    rng = random.Random(29)
    docs = [(i, " ".join(f"w{i * 1500 + k}" for k in range(1500)) + " " + " ".join(rng.choices(["a", "b", "c"], k=20))) for i in range(200)]
    docs += [(900, "a b never met"), (901, "w1 w3 w5 w7"), (902, docs[0][1])]
    table = frame(spark, docs).repartition(3, "doc_id")
    target = table.filter("doc_id % 2 = 0")
    asked = frame(spark, docs[:3] + docs[200:] + [(903, "nowhere seen"), (904, None)])
    got = {r.doc_id: r.lm for r in lm_score.score(asked, target, table, vocabulary=vocabulary).collect()}

    def model(texts):
        ones, twos = {}, {}
        for t in texts:
            c = [None, *t.split()]
            for w in c:
                ones[w] = ones.get(w, 0) + 1
            for p in zip(c, c[1:]):
                twos[p] = twos.get(p, 0) + 1
        return ones, twos
    a, b = model([t for d, t in docs if d % 2 == 0]), model([t for _, t in docs])
    size = vocabulary or len(b[0]) + 1
    scale = sum(a[0].values()) / sum(b[0].values())
    for d, t in docs[:3] + docs[200:] + [(903, "nowhere seen")]:
        c, ce = [None, *t.split()], []
        for (ones, twos), f in ((a, 1.0), (b, scale)):
            n, loss = sum(ones.values()) * f, 0.0
            for v, w in zip(c, c[1:]):
                one = (ones.get(w, 0) * f + lm_score.DELTA) / (n + lm_score.DELTA * size)
                loss -= np.log((twos.get((v, w), 0) * f + lm_score.MU * one) / (ones.get(v, 0) * f + lm_score.MU))
            ce.append(loss / (len(c) - 1))
        assert np.allclose([got[d].ce_target, got[d].ce_background, got[d].score], [*ce, ce[1] - ce[0]], rtol=1e-9)
    assert (got[904].n_tokens, got[904].ce_target, got[904].score) == (0, None, 0.0)


def test_columns_with_the_names_of_helpers(spark):
    """Operators that keep a table's columns do so whatever these are called."""
    rows = [(i, f"word{i % 3} and more of it {i}", f"s{i % 2}", 1, 2, 3, 4, 5, "t", 6) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, k1 long, k2 long, __source long, __id long, __key long, __text_key string, __copy long")
    scored = lm_score.score(docs, docs.limit(3), docs)
    assert scored.columns == [*docs.columns, "lm"] and {(r.k1, r.k2, r.n) for r in scored.selectExpr("k1", "k2", "lm.n_tokens AS n").collect()} == {(1, 2, 6)}
    mix = mixing.mixed(docs)
    assert [c for c in mix.columns if not c.startswith("mix_")] == docs.columns and {r["__source"] for r in mix.collect()} == {3}
    assert mixing.emitted(mix).columns == docs.columns
    gone = docs.filter("doc_id < 4").select("doc_id", text_key(docs.text).alias("text_key"))
    left = without(docs, gone)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == list(range(4, 12))


def test_documents_without_an_id_toss_by_their_text(spark):
    rows = [(None, " ".join([f"w{i}"] * 10), "s") for i in range(600)] + [(i, "a b c", "other") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    copies = [r.mix_copies for r in mixing.mixed(docs).filter("source = 's'").collect()]
    target = mixing.mixed(docs).filter("source = 's'").first()
    assert len(set(copies)) == 2 and abs(10 * sum(copies) - target.mix_target) < 0.1 * target.mix_target
