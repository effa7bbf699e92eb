"""Every stage of the pipeline on its own input against brute force, and the registered queries against SQL."""

import random
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from scripts.check_oracles import TABLES, compare
from tests.llm import brute
from weekloom.llm import mixing, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(21)
    words = [f"p{i}" for i in range(400)]
    docs, labels = [], []
    for d in range(260):
        y = int(rng.random() < 0.25)
        ws = rng.choices(words, k=rng.randint(12, 60))
        if y:
            for _ in range(4):
                ws[rng.randrange(len(ws))] = rng.choice(["nasty", "vile"])
        docs.append((d, " ".join(ws), f"s{d % 4}" if d % 9 else None))
        labels.append((d, 1, y))
    items = [(i, " ".join(rng.choices(words, k=14))) for i in range(4)]
    clean = [r for r in docs if labels[r[0]][2] == 0]
    for n, (_, text, source) in enumerate(clean[:40]):
        docs.append((1000 + n, text.upper() if n % 2 else text, source))
        docs.append((2000 + n, text + " tail", source))
        docs.append((3000 + n, " ".join(text.split()[:6]) + " " + rng.choice(items)[1], source))
    docs += [(None, None, None), (None, "no name", "s1"), (4000, "", "s1"), (4001, " ", "s2"), (7, docs[7][1], docs[7][2])]
    path = str(tmp_path_factory.mktemp("tables"))
    table = spark.createDataFrame([(d, t, "en", s, len(t or ""), "x", "y") for d, t, s in docs], "doc_id long, text string, lang string, source string, n_chars long, digest string, text_key string")
    table.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def expected(spark, name, docs, path):
    """The rows that a stage keeps, as (id, text) pairs with their number."""
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    pairs = [(d, t) for d, t, _ in rows]
    if name == "toxicity":
        index = toxicity.fit(docs, spark.read.parquet(f"{path}/labels.parquet"))
        return Counter(p for p in pairs if index.score(p[1])[0] < 0.5)
    if name == "exact_dedup":
        top = {}
        for d, t in pairs:
            if d is not None:
                top[brute.low(t)] = max(d, top.get(brute.low(t), d))
        return Counter(p for p in pairs if p[0] == top.get(brute.low(p[1])))
    if name == "near_dedup":
        return Counter(p for p, (d, _, c) in zip(pairs, brute.near(pairs, 5, 80)) if d == c)
    if name == "decontaminate":
        wins = brute.windows([(r.item_id, r.text) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()])
        return Counter(p for p in pairs if not brute.hits(p[1], wins)[1])
    out = Counter()
    for r in mixing.mixed(docs).collect():
        out[(r.doc_id, r.text)] += r.mix_copies
    return +out


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        want = expected(spark, name, docs, folder)
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns
        before = docs.count()
        path = f"{folder}/out-{name}"
        kept.write.parquet(path)
        docs = spark.read.parquet(path)
        got = Counter((r.doc_id, r.text) for r in docs.collect())
        assert got == want, name
        if name != "mixing":
            assert 0 < docs.count() < before, name
    whole = Counter((r.doc_id, r.text) for r in corpus_pipeline.run(spark, folder).collect())
    assert whole == Counter((r.doc_id, r.text) for r in docs.collect())


def test_stages_on_nothing(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", ["op1_url_filter", "op2_near_dedup", "op3_decontaminate", "op4_chat", "op5_pii", "op6_mixing", "op8_exact_dedup", "op10_warc"])
def test_matches_sql(spark, con, name):
    message = compare(entry.queries()[name](spark, SF), con.sql(entry.oracle_sql()[name]))
    assert message.startswith("ok"), message


def test_toxicity_on_held_out_labels(spark):
    found = {r.doc_id: r for r in entry.queries()["op7_toxicity"](spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    held = [r for r in labels if found[r.doc_id].held_out]
    assert held and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found.values())
    assert sum(found[r.doc_id].predicted == r.toxic for r in held) / len(held) > 0.9
