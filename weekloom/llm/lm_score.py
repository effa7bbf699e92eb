"""Language-model scores: cross-entropy difference between a target and a background model.

Method: two bigram models over one vocabulary, one of the target documents and one of all documents,
the background's counts scaled to the target's size so that both are smoothed alike. A document's score is
the mean over its tokens of background loss minus target loss: above 0 it is more like the target.

Words and bigrams are counted one by one, under 64-bit keys; the tables grow with the corpus, so no task
and not the driver holds a whole one. A task cuts its texts into blocks and sends each distinct n-gram of a
block once, with its count, to the shard of its key, hence a common n-gram weighs no more than the number of
blocks. A shard adds up its keys and answers each block with the counts of the n-grams it asked for, in
the order of their keys; the block's words, sent on beside them, then meet the counts of all its n-grams.
Scores are joined to the documents by a 128-bit key of the text.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.functions.bitmap import bitmap_of, in_bitmap
from weekloom.llm.common import stored, text_key, unused

U = np.uint64
#: log2 of the vocabulary size that smoothing takes by default; counts do not depend on it.
WORD_BITS = 18
#: Additive smoothing of word counts, and the weight of the word model in a pair's.
DELTA, MU = 0.05, 20.0
#: Tokens of a block, and bytes of text a shard; both bound what a task holds, and shards grow in number with the texts.
BLOCK_TOKENS = 1 << 21
SHARD_BYTES, LEAST_SHARDS = 1 << 24, 256
WORDS_KEPT = 1 << 17
START = b"\x00start"
#: What a row of an exchange is about, and which of the three inputs it stands for.
WORDS, PAIRS, CHAIN, TEXTS = range(4)
TARGET, BACKGROUND, ASKED = 1, 2, 4


class WordIds(dict):
    """64-bit key of each word; forgets all when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def token_ids(text: bytes | None, ids: WordIds) -> np.ndarray:
    """Keys of the start mark and of the text's words (A-Z lower-cased, split at ASCII white space)."""
    words = (text or b"").lower().split()
    return np.fromiter((ids[w] for w in [START, *words]), dtype=np.uint64, count=len(words) + 1)


def pair_ids(words: np.ndarray) -> np.ndarray:
    """64-bit keys of neighbours; as word keys are hashes, so is a sum of two of their multiples."""
    h = words[:-1] * U(0x9E3779B97F4A7C15) + (words[1:] >> U(32) | words[1:] << U(32))
    return h * U(0xD6E8FEB86659FD93)


def packed(numbers: np.ndarray) -> bytes:
    """Unsigned numbers by bytes of equal weight, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    width = int(numbers.max()).bit_length() + 7 >> 3 if len(numbers) else 0
    body = planes[:width].tobytes()
    return struct.pack("<IB", len(numbers), width) + (pa.compress(body, codec="zstd", asbytes=True) if body else b"")


def unpacked(data: bytes) -> np.ndarray:
    n, width = struct.unpack_from("<IB", data)
    planes = np.zeros((8, n), dtype=np.uint8)
    if n and width:
        planes[:width] = np.frombuffer(pa.decompress(data[5:], decompressed_size=n * width, codec="zstd", asbytes=True), dtype=np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys by their distances."""
    return packed(np.diff(keys, prepend=U(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64)


def by_count(counts: np.ndarray) -> np.ndarray:
    """Places of a block's words, the commonest first: as ranks the words of a chain pack best."""
    return np.argsort(-counts, kind="stable")


def pairs_of(chain: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pair keys, place of their first words) of texts joined to one chain; no pair reaches from one text into the next."""
    inside = np.ones(len(chain), dtype=bool)
    inside[np.cumsum(lengths + 1) - 1] = False
    places = np.flatnonzero(inside)
    return pair_ids(chain)[places], places


GATHERED = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("what", pa.int32()), ("roles", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _gather(roles: int, shard_bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of one task's texts: a block's distinct n-grams for each shard and, where scores are asked for, its chain of words and its texts."""
    def block_rows(number: int, names: list[tuple[int, int]], chains: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        chain, lengths = np.concatenate(chains), np.array([len(c) - 1 for c in chains], dtype=np.int64)
        texts = np.array(names, dtype=np.int64).reshape(-1).view(np.uint64)
        block = xxhash.xxh3_64_intdigest(struct.pack("<qq", TaskContext.get().partitionId(), number) + texts.tobytes()) - (1 << 63)
        words, index, n_words = np.unique(chain, return_inverse=True, return_counts=True)
        pairs, n_pairs = np.unique(pairs_of(chain, lengths)[0], return_counts=True)
        rows = []
        for what, keys, counts in ((WORDS, words, n_words), (PAIRS, pairs, n_pairs)):
            shards = (keys >> U(64 - shard_bits)).astype(np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                rows.append((int(shards[a]), block, what, roles, packed_keys(keys[a:b]), packed(counts[a:b])))
        if roles & ASKED:
            own = -1 - (block & 0xFFFFFFFF)
            rank = np.empty(len(words), dtype=np.int64)
            rank[by_count(n_words)] = np.arange(len(words))
            rows += [(own, block, CHAIN, roles, packed(rank[index]), packed(lengths)), (own, block, TEXTS, roles, packed(texts), packed(n_words))]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), GATHERED)], schema=GATHERED)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, number, names, chains, held = WordIds(), 0, [], [], 0
        for batch in batches:
            for text, *name in zip(*(batch.column(i) for i in range(3))):
                chain = token_ids(text.as_py(), ids)
                if len(chain) == 1:
                    continue
                names.append((name[0].as_py(), name[1].as_py()))
                chains.append(chain)
                held += len(chain)
                if held >= BLOCK_TOKENS:
                    yield from block_rows(number, names, chains)
                    number, names, chains, held = number + 1, [], [], 0
        if chains:
            yield from block_rows(number, names, chains)
    return gather


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    every, n = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    order = np.argsort(every, kind="stable")
    every, n = every[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    return every[first], np.add.reduceat(n, first)


def _looked_up(keys: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    known, counts = table
    if not len(known):
        return np.zeros(len(keys), dtype=np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, counts[at], 0)


ANSWERED = pa.schema([("block", pa.int64()), ("what", pa.int32()), ("shard", pa.int64()), ("keys", pa.binary()), ("target", pa.binary()), ("background", pa.binary()),
                      ("n_words", pa.int64()), ("in_target", pa.int64()), ("in_background", pa.int64())])


def _answer(table: pa.Table) -> pa.Table:
    """Counts of one shard's n-grams for each block that asked, and a row without block that sums up the shard's words; chains and texts pass."""
    rows = table.select(GATHERED.names).to_pylist()
    out = [(r["block"], r["what"], r["shard"], r["keys"], r["counts"], None, None, None, None) for r in rows if r["what"] in (CHAIN, TEXTS)]
    for what in (WORDS, PAIRS):
        mine = [(r, unpacked_keys(r["keys"])) for r in rows if r["what"] == what]
        target, background = (_summed([k for r, k in mine if r["roles"] & role], [unpacked(r["counts"]) for r, _ in mine if r["roles"] & role]) for role in (TARGET, BACKGROUND))
        for r, keys in mine:
            if r["roles"] & ASKED:
                out.append((r["block"], what, r["shard"], r["keys"] if what == WORDS else None, packed(_looked_up(keys, target)), packed(_looked_up(keys, background)), None, None, None))
        if mine and what == WORDS:
            out.append((None, what, None, None, None, None, len(np.union1d(target[0], background[0])), int(target[1].sum()), int(background[1].sum())))
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), ANSWERED)] if out else [pa.array([], f.type) for f in ANSWERED], schema=ANSWERED)


SCORES = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("n_tokens", pa.int64()), ("ce_target", pa.float64()), ("ce_background", pa.float64())])


def _scorer(in_target: int, in_background: int, vocabulary: float) -> Callable[[pa.Table], pa.Table]:
    scale = in_target / in_background if in_target and in_background else 1.0

    def losses(words: np.ndarray, pairs: np.ndarray, before: np.ndarray, at: np.ndarray, factor: float, total: float) -> np.ndarray:
        """Negative log probability of each distinct pair's second word, given the first."""
        one = (words[at] * factor + DELTA) / (total + DELTA * vocabulary)
        return -np.log((pairs * factor + MU * one) / (words[before] * factor + MU))

    def score_block(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(["what", "shard", "keys", "target", "background"]).to_pylist(), key=lambda r: (r["what"], r["shard"]))
        mine = {what: [r for r in rows if r["what"] == what] for what in range(4)}
        if any(len(mine[k]) != 1 for k in (CHAIN, TEXTS)):
            raise ValueError("a block of texts is missing or came twice")
        lengths, texts, n_words = unpacked(mine[CHAIN][0]["target"]).astype(np.int64), unpacked(mine[TEXTS][0]["keys"]), unpacked(mine[TEXTS][0]["target"]).astype(np.int64)
        index = by_count(n_words)[unpacked(mine[CHAIN][0]["keys"]).astype(np.int64)]
        keys = np.concatenate([unpacked_keys(r["keys"]) for r in mine[WORDS]])
        counted = {(what, side): np.concatenate([unpacked(r[side]) for r in mine[what]]).astype(np.float64) for what in (WORDS, PAIRS) for side in ("target", "background")}
        if len(keys) != len(n_words):
            raise ValueError("counts of some words of a block are missing")
        pairs, places = pairs_of(keys[index], lengths)
        distinct, first, inverse = np.unique(pairs, return_index=True, return_inverse=True)
        if len(distinct) != len(counted[PAIRS, "target"]):
            raise ValueError("counts of some pairs of a block are missing")
        before, at = index[places[first]], index[places[first] + 1]
        starts = np.cumsum(lengths) - lengths
        means = []
        for side, factor, total in (("target", 1.0, in_target), ("background", scale, in_background * scale)):
            loss = losses(counted[WORDS, side], counted[PAIRS, side], before, at, factor, total)
            means.append(np.add.reduceat(loss[inverse], starts) / lengths)
        names, one = np.unique(texts.view(np.int64).reshape(-1, 2), axis=0, return_index=True)
        return pa.Table.from_arrays([pa.array(names[:, 0]), pa.array(names[:, 1]), pa.array(lengths[one]), pa.array(means[0][one]), pa.array(means[1][one])], schema=SCORES)
    return score_block


def _names(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [text_key(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def score(docs: DataFrame, target: DataFrame, background: DataFrame, text_col: str = "text", out: str = "lm", vocabulary: float | None = float(1 << WORD_BITS),
          shards: int | None = None) -> DataFrame:
    """``docs`` with a column ``out``: struct(n_tokens, ce_target, ce_background, score).

    Words are smoothed over ``vocabulary`` words; None stands for the number of distinct words of target and
    background, and one more for all that neither has. ``shards`` follows from the bytes of ``docs`` and
    ``background``; only a target larger than both needs more.

    Defined results: a null or empty text has no tokens, null cross entropies and score 0; an empty
    target or background is a model of equal probabilities; repeated rows count as often as they come; an
    existing column ``out`` is replaced.
    """
    text = F.col(f"`{text_col}`")
    same = background is docs
    if shards is None:
        size = sum(d.agg(F.sum(F.octet_length(text))).first()[0] or 0 for d in ([docs] if same else [docs, background]))
        shards = max(LEAST_SHARDS, size // SHARD_BYTES)
    bits = max(1, int(shards - 1).bit_length())
    parts = None
    for frame, roles in [(target, TARGET), (docs, ASKED | BACKGROUND * same)] + [(background, BACKGROUND)] * (not same):
        part = frame.select(text.cast("binary").alias("text"), *_names(text)).mapInArrow(_gather(roles, bits), "shard long, block long, what int, roles int, keys binary, counts binary")
        parts = part if parts is None else parts.unionAll(part)
    answered = stored(parts.groupBy("shard").applyInArrow(_answer, "block long, what int, shard long, keys binary, target binary, background binary, n_words long, in_target long, in_background long"), "ngrams")
    met = answered.filter("block IS NULL").agg(F.sum("n_words").alias("n_words"), F.sum("in_target").alias("target"), F.sum("in_background").alias("background")).first()
    scorer = _scorer(met.target or 0, met.background or 0, (met.n_words or 0) + 1.0 if vocabulary is None else vocabulary)
    blocks = answered.filter("block IS NOT NULL").select("block", "what", "shard", "keys", "target", "background")
    # stored so that the join below is one of two plain exchanges, whose skewed parts adaptive execution splits
    scores = stored(blocks.groupBy("block").applyInArrow(scorer, "k1 long, k2 long, n_tokens long, ce_target double, ce_background double")
                    .groupBy("k1", "k2").agg(*(F.first(c).alias(f"__{c}") for c in ("n_tokens", "ce_target", "ce_background"))), "scores")
    k1, k2 = _names(text)
    values = ("n_tokens", "ce_target", "ce_background")
    n1, n2, m1, m2, *got = (unused(f"__{n}", docs) for n in ("k1", "k2", "m1", "m2", *values))
    named = docs.withColumn(n1, k1).withColumn(n2, k2)
    scores = scores.select(F.col("k1").alias(m1), F.col("k2").alias(m2), *[F.col(f"__{v}").alias(g) for v, g in zip(values, got)])
    value = F.struct(F.coalesce(got[0], F.lit(0)).cast("long").alias("n_tokens"), F.col(got[1]).alias("ce_target"), F.col(got[2]).alias("ce_background"),
                     F.coalesce(F.col(got[2]) - F.col(got[1]), F.lit(0.0)).alias("score"))
    return named.join(scores, (F.col(n1) == F.col(m1)) & (F.col(n2) == F.col(m2)), "left").withColumn(out, value).drop(n1, n2, m1, m2, *got)


def labelled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """Documents with a label 1; an id whose labels differ counts as 1.

    A bitmap of the ids drops most other documents at the scan, before the join shuffles texts.
    """
    good = labels.filter(F.col(label_col) == 1).select(F.col(id_col).cast(docs.schema[id_col].dataType).alias(id_col))
    known = bitmap_of(good.select(F.xxhash64(id_col).alias("h")), "h")
    return docs.filter(in_bitmap(F.xxhash64(id_col), known)).join(good, id_col, "left_semi")
