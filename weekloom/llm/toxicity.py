"""Toxicity scores from the nearest labelled examples.

Method: a bounded, balanced sample of labelled documents is the set of examples. Texts are TF-IDF vectors
over words and word beginnings (which catch inflected forms); the vocabulary is the terms that tell the
classes apart in the sample, by chi-square, and its most frequent ones, which keep a document's length
in view. A block-max inverted index holds each term's weights in blocks of examples with their maxima: a
query's upper bounds per block decide which blocks are scored, and blocks stop being scored when none left can
reach the k-th best, so the k nearest by cosine are exact. Votes weigh with the squared similarity and
are calibrated on the examples themselves, each scored without its own vote.

The fitted model is bounded by ``EXAMPLES`` and ``VOCABULARY`` (about 10 MB at most), whatever the
corpus, and is broadcast. Scoring is one pass over the documents without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom.llm.common import stored

#: Bounds of the fitted model: examples of each class, terms by chi-square, terms by frequency.
EXAMPLES, TELLING, FREQUENT = 2048, 512, 64
#: Least number of examples with a term.
LEAST = 5
NEIGHBOURS, BLOCK, AT_ONCE = 10, 64, 16
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
PREFIXES = (4, 5, 6)
WORDS_KEPT = 1 << 18


def words_of(text: str | None) -> Counter:
    return Counter(WORD.findall((text or "").lower()))


def terms_of_word(word: str) -> list[str]:
    """The word and its first 4, 5 and 6 letters, marked by ``^``, where it is longer."""
    return [word] + [f"^{word[:n]}" for n in PREFIXES if len(word) > n]


def counted(words: Counter) -> Counter:
    out: Counter = Counter()
    for word, n in words.items():
        for term in terms_of_word(word):
            out[term] += n
    return out


@F.arrow_udf(T.MapType(T.StringType(), T.IntegerType()))
def term_counts(texts: pa.Array) -> pa.Array:
    return pa.array([list(counted(words_of(t.as_py())).items()) for t in texts], pa.map_(pa.string(), pa.int32()))


@dataclass
class Index:
    """Block-max inverted index. ``weights[b, t]`` are the weights of term t in the examples of block b, ``top[t, b]`` their maximum."""

    terms: dict[str, int]
    idf: np.ndarray
    weights: np.ndarray
    top: np.ndarray
    labels: np.ndarray
    ids: list[str]
    prior: float
    share: float                      # of toxic examples
    slope: float = 1.0
    shift: float = 0.0
    bare: float = 0.0                 # score of a text without a known term
    cache: dict = field(default_factory=dict, repr=False)

    def query(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and unit weights of a text."""
        if len(self.cache) > WORDS_KEPT:
            self.cache.clear()
        tf: dict[int, int] = {}
        for word, n in words_of(text).items():
            known = self.cache.get(word)
            if known is None:
                known = self.cache[word] = tuple(self.terms[t] for t in terms_of_word(word) if t in self.terms)
            for t in known:
                tf[t] = tf.get(t, 0) + n
        at = np.fromiter(sorted(tf), dtype=np.int64, count=len(tf))
        w = (1 + np.log([tf[t] for t in at])) * self.idf[at] if len(at) else np.empty(0)
        return at, w / max(float(np.linalg.norm(w)), 1e-12)

    def nearest(self, at: np.ndarray, w: np.ndarray, k: int = NEIGHBOURS, leave: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of highest cosine above 0, ties by place; ``leave`` is not among them."""
        bound = w @ self.top[at]
        order = np.argsort(-bound, kind="stable")
        who, score = np.empty(0, dtype=np.int64), np.empty(0)
        for start in range(0, len(order), AT_ONCE):
            blocks = order[start : start + AT_ONCE]
            least = score[k - 1] if len(score) >= k else 0.0
            blocks = blocks[bound[blocks] >= least - 1e-6]
            if not len(blocks) or bound[blocks[0]] <= 0:
                break
            dots = w @ self.weights[blocks[:, None], at]
            b, j = np.nonzero(dots >= max(least, 1e-300))
            new = blocks[b] * BLOCK + j
            ok = (new != leave) & (new < len(self.labels))
            who, score = np.concatenate([who, new[ok]]), np.concatenate([score, dots[b, j][ok]])
            best = np.lexsort((who, -score))[:k]
            who, score = who[best], score[best]
        return who, score

    def vote(self, who: np.ndarray, score: np.ndarray) -> float:
        """Share of the toxic votes, classes brought to their frequency among all labels."""
        w = score**2
        toxic = float(w[self.labels[who] == 1].sum()) / self.share * self.prior
        clean = float(w[self.labels[who] == 0].sum()) / (1 - self.share) * (1 - self.prior)
        return (toxic + 1e-4 * self.prior) / (toxic + clean + 1e-4)

    def score(self, text: str | None) -> tuple[float, list[tuple[str, float, int]]]:
        at, w = self.query(text)
        who, sim = self.nearest(at, w) if len(at) else (np.empty(0, dtype=np.int64), np.empty(0))
        if not len(who):
            return self.bare, []
        z = self.slope * _logit(self.vote(who, sim)) + self.shift
        return 1 / (1 + math.exp(-z)), [(self.ids[i], float(s), int(self.labels[i])) for i, s in zip(who, sim)]


def _logit(p: float) -> float:
    p = min(max(p, 1e-4), 1 - 1e-4)
    return math.log(p / (1 - p))


def _calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression of y on x by Newton steps, with a light pull to slope 1 and shift 0."""
    beta = np.array([1.0, 0.0])
    X = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(X @ beta, -30, 30)))
        grad = X.T @ (weight * (p - y)) + 0.1 * (beta - [1.0, 0.0])
        hess = X.T @ (X * (weight * p * (1 - p))[:, None]) + 0.1 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta = beta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return max(float(beta[0]), 0.05), float(beta[1])


def learnable(id_col: str):
    """Rows whose label may be learnt: crc32 of the id as text is no multiple of 5."""
    return F.crc32(F.col(f"`{id_col}`").cast("string")) % 5 != 0


def sampled_examples(docs: DataFrame, labels: DataFrame, per_class: int, id_col: str, text_col: str, label_col: str) -> tuple[DataFrame, float]:
    """(id, label, text) of up to ``per_class`` documents of each class, and the share of toxic labels.

    Ids are drawn by their MD5; a threshold on it keeps what is sorted near ``per_class`` rows however many labels there are.
    """
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")).filter("doc_id IS NOT NULL AND label IN (0, 1)").filter(learnable("doc_id"))
             .groupBy("doc_id").agg(F.max("label").cast("int").alias("label")))
    known = stored(known.join(docs.select(F.col(id_col).alias("doc_id")), "doc_id", "left_semi"), "labels")
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 13), 16, 10).cast("double") / float(1 << 52)
    picks = [known.filter(F.col("label") == y).withColumn("draw", draw).filter(F.col("draw") < min(1.0, (per_class + 8 * math.sqrt(per_class)) / n) + (1.0 if n <= per_class else 0.0))
             .orderBy("draw", "doc_id").limit(per_class).select("doc_id", "label") for y, n in sorted(sizes.items())]
    if not picks:
        return known.select("doc_id", "label", F.lit("").alias("text")), 0.0
    chosen = picks[0] if len(picks) == 1 else picks[0].unionByName(picks[1])
    got = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id")  # at most 2 * per_class rows
    one = got.groupBy("doc_id").agg(F.max("label").alias("label"), F.min(F.coalesce("text", F.lit(""))).alias("text"))
    return stored(one, "examples"), sizes.get(1, 0) / sum(sizes.values())


def fit(docs: DataFrame, labels: DataFrame, per_class: int = EXAMPLES, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Index:
    """The index over a bounded sample of the learnable labelled documents.

    What comes to the driver: the vocabulary and the examples' weights in it, both bounded.
    """
    examples, prior = sampled_examples(docs, labels, per_class, id_col, text_col, label_col)
    terms = stored(examples.select("doc_id", "label", F.explode(term_counts("text")).alias("term", "tf")), "terms")
    sizes = {r.label: r.n for r in examples.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = float(sizes.get(1, 0)), float(sizes.get(0, 0))
    n = n1 + n0
    df = terms.groupBy("term").agg(F.sum("label").cast("double").alias("a"), F.sum(1 - F.col("label")).cast("double").alias("b")).withColumn("df", F.col("a") + F.col("b")).filter(F.col("df") >= LEAST)
    gap = F.col("a") * (n0 - F.col("b")) - F.col("b") * (n1 - F.col("a"))
    df = stored(df.withColumn("chi", gap * gap * n / (F.col("df") * (n - F.col("df")) * n1 * n0 + 1.0)), "df")
    vocabulary = {r.term: r.df for part in (df.orderBy(F.desc("chi"), "term").limit(TELLING), df.orderBy(F.desc("df"), "term").limit(FREQUENT)) for r in part.select("term", "df").collect()}
    names = sorted(vocabulary)
    number = {t: i for i, t in enumerate(names)}
    idf = np.log(max(n, 1) / np.array([vocabulary[t] for t in names])) + 0.1 if names else np.empty(0)
    known = terms.join(terms.sparkSession.createDataFrame([(t,) for t in names], "term string"), "term") if names else terms.limit(0)
    labelled = {str(r.doc_id): r.label for r in examples.select("doc_id", "label").collect()}
    vectors: dict[str, list[tuple[int, int]]] = {i: [] for i in labelled}
    for r in known.select("doc_id", "term", "tf").toLocalIterator():
        vectors[str(r.doc_id)].append((number[r.term], r.tf))
    return built(vectors, labelled, number, idf, prior)


def built(vectors: dict[str, list[tuple[int, int]]], labelled: dict[str, int], number: dict[str, int], idf: np.ndarray, prior: float) -> Index:
    """Examples with alike leading terms stand together, so that block maxima are tight."""
    rows = []
    for i, counts in vectors.items():
        at = np.array([t for t, _ in counts], dtype=np.int64)
        w = (1 + np.log([c for _, c in counts])) * idf[at] if counts else np.empty(0)
        rows.append((i, at, w / max(float(np.linalg.norm(w)), 1e-12)))
    rows.sort(key=lambda r: (labelled[r[0]], tuple(r[1][np.argsort(-r[2], kind="stable")[:3]]), r[0]))
    blocks = max(1, -(-len(rows) // BLOCK))
    weights = np.zeros((blocks, max(1, len(number)), BLOCK))
    for j, (_, at, w) in enumerate(rows):
        weights[j // BLOCK, at, j % BLOCK] = w
    y = np.array([labelled[i] for i, _, _ in rows], dtype=np.int64)
    share = float(y.mean()) if len(y) else 0.5
    index = Index(number, idf, weights, np.ascontiguousarray(weights.max(axis=2).T), y, [i for i, _, _ in rows], prior, min(max(share, 1e-3), 1 - 1e-3))
    if not len(y) or share in (0.0, 1.0):
        index.bare = prior
        index.slope, index.shift = 0.0, _logit(prior)
        return index
    near = [index.nearest(at, w, leave=j) if len(at) else (np.empty(0, dtype=np.int64), np.empty(0)) for j, (_, at, w) in enumerate(rows)]
    weight = np.where(y == 1, prior / share, (1 - prior) / (1 - share))
    has = np.array([len(who) > 0 for who, _ in near])
    if has.any():
        x = np.array([_logit(index.vote(*near[j])) for j in np.flatnonzero(has)])
        index.slope, index.shift = _calibrate(x, y[has].astype(float), weight[has])
    bare = weight[~has]
    index.bare = float(((bare * y[~has]).sum() + prior) / (bare.sum() + 1))
    return index


SCORED = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("evidence", T.ArrayType(T.StructType([
    T.StructField("doc_id", T.StringType()), T.StructField("similarity", T.DoubleType()), T.StructField("label", T.IntegerType())])))])


def score(docs: DataFrame, index: Index, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with a column ``out``: struct(score, evidence), evidence being the nearest examples with similarity and label.

    Defined results: null and empty texts, and texts without a known term, get the share of toxic ones
    among such examples; without any label, or with labels of one class only, every text gets the share
    of toxic labels (0 without labels); repeated rows are scored alike; an existing column ``out`` is
    replaced. Labels that contradict each other count as toxic; labels of missing documents are not used.
    """
    sent = docs.sparkSession.sparkContext.broadcast(index)
    evidence = pa.list_(pa.struct([("doc_id", pa.string()), ("similarity", pa.float64()), ("label", pa.int32())]))

    @F.arrow_udf(SCORED)
    def scored(texts: pa.Array) -> pa.Array:
        model = sent.value
        found = [model.score(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays([pa.array([s for s, _ in found], pa.float64()),
                                           pa.array([[{"doc_id": i, "similarity": x, "label": y} for i, x, y in e] for _, e in found], evidence)], ["score", "evidence"])
    return docs.withColumn(out, scored(F.col(f"`{text_col}`")))
