"""Near-duplicate documents by MinHash bands, odd sketches and exact checks.

Method: a document is its set of word shingles. Documents with equal sets form a class. MinHash samples of
a class are cut into bands, whose hashes are buckets, and all samples are folded into an odd sketch: a
bitmap of parities, so that the population count of the XOR of two sketches estimates the number of
samples in which they differ, precisely where similarity is high. A pair of one bucket is a candidate if
the sketches allow the wanted similarity (with a margin of ``SIGMAS`` standard deviations), and a
link if the full sets have it.

No bucket is expanded into all its pairs. First every class is compared with a random leader of each of
its buckets, at most one pair for each class and band. Linked classes become components. Only buckets
that then still hold more than one component are looked at again, inside tasks, block by block: sketches
of different components are compared, classes with a candidate get their full sets, and a task checks
its pairs on these. No pair leaves a task but links, of those at most one for each two components that
the task did not know to be linked.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom.functions.bitmap import bitmap_of, in_bitmap
from weekloom.llm.common import stored
from weekloom.llm.components import components

U = np.uint64
SAMPLES, SKETCH_BITS, BANDS = 1024, 4096, 30
#: A pair at the threshold is missed by all bands with at most this probability.
MISS = 1e-5
SIGMAS = 4.75
#: Members of a bucket that one task compares with as many others, and the shingles they may have together.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
#: Rows and shingles that small buckets bring together in one group.
PART, PART_SHINGLES = 256, 1 << 20
#: Leader pairs of a class that are checked before the blocks, best sketches first; the blocks look at all others.
FIRST = 3
#: Parts into which the rows of a leader of many are spread.
SALTS = 16
WORDS_KEPT = 1 << 17


def rows_per_band(similarity: float, bands: int = BANDS, miss: float = MISS) -> int:
    """The most rows a band may have so that a pair at ``similarity`` is missed with at most ``miss``."""
    r = 1
    while (1 - similarity ** (r + 1)) ** bands <= miss:
        r += 1
    return r


def sketch_cut(similarity: float, samples: int = SAMPLES, bits: int = SKETCH_BITS) -> int:
    """Largest population count of the XOR at which a pair may still have ``similarity``."""
    m = 2 * samples * (1 - similarity)
    load = m / bits
    mean = bits / 2 * (1 - math.exp(-2 * load))
    spread = (2 * math.sqrt(samples * similarity * (1 - similarity)) * math.exp(-2 * load)) ** 2 + bits / 4 * (1 - math.exp(-4 * load) * (1 + 4 * load))
    return math.ceil(mean + SIGMAS * math.sqrt(spread))


class _Words(dict):
    """64-bit hashes of words; forgets all when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_hashes(text: bytes | None, words: int, cache: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text's bytes; fewer words than a shingle has are one shingle."""
    found = (text or b"").lower().split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter((cache[w] for w in found), dtype=np.uint64, count=len(found))
    size = min(words, len(h))
    n = len(h) - size + 1
    x = np.full(n, size, dtype=np.uint64)
    for j in range(size):
        x = (x ^ h[j : j + n]) * U(0x9E3779B97F4A7C15)
        x ^= x >> U(29)
    return np.unique(x)


def _multipliers(samples: int) -> np.ndarray:
    return np.random.default_rng(20240607).integers(0, 1 << 32, samples, dtype=np.uint32) | np.uint32(1)


def minhash(shingles: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Minimum of each multiple of the mixed hashes; a few shingles at a time stay in the cache."""
    x = ((shingles * U(0xD6E8FEB86659FD93)) >> U(32)).astype(np.uint32)
    low, room = np.full(len(a), 0xFFFFFFFF, dtype=np.uint32), np.empty((64, len(a)), dtype=np.uint32)
    for at in range(0, len(x), 64):
        part = x[at : at + 64]
        product = np.multiply(part[:, None], a[None, :], out=room[: len(part)])
        np.minimum(low, product.min(axis=0), out=low)
    return low


def odd_sketch(sample: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmap of (place, value) as 64-bit integers."""
    h = (sample.astype(np.uint64) | (np.arange(len(sample), dtype=np.uint64) << U(32))) * U(0xFF51AFD7ED558CCD)
    h ^= h >> U(32)
    slot = ((h * U(0xC4CEB9FE1A85EC53)) >> U(64 - int(math.log2(bits)))).astype(np.int64)
    return np.packbits((np.bincount(slot, minlength=bits) & 1).astype(np.uint8)).view(np.int64)


def band_hashes(sample: np.ndarray, bands: int, rows: int) -> np.ndarray:
    cut = sample[: bands * rows].reshape(bands, rows).astype(np.uint64)
    h = np.arange(1, bands + 1, dtype=np.uint64)
    for j in range(rows):
        h = (h ^ cut[:, j]) * U(0x9E3779B97F4A7C15)
        h ^= h >> U(31)
    return h.view(np.int64)


SKETCHED = T.StructType([T.StructField("n", T.LongType()), T.StructField("node", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("sketch", T.ArrayType(T.LongType()))])


def _sketcher(words: int, samples: int, bits: int, bands: int, rows: int) -> Callable:
    a = _multipliers(samples)
    cache = _Words()

    @F.arrow_udf(SKETCHED)
    def sketch(texts: pa.Array) -> pa.Array:
        n, node, band, odd = [], [], [], []
        for text in texts:
            s = shingle_hashes(text.as_py(), words, cache)
            n.append(len(s))
            if not len(s):
                node.append(None)
                band.append(None)
                odd.append(None)
                continue
            node.append(xxhash.xxh3_128_digest(s.tobytes()))
            sample = minhash(s, a)
            band.append(band_hashes(sample, bands, rows))
            odd.append(odd_sketch(sample, bits))
        longs = pa.list_(pa.int64())
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(band, longs), pa.array(odd, longs)], ["n", "node", "bands", "sketch"])
    return sketch


def _setter(words: int) -> Callable:
    cache = _Words()

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def full_set(texts: pa.Array) -> pa.Array:
        return pa.array([shingle_hashes(t.as_py(), words, cache).view(np.int64) for t in texts], pa.list_(pa.int64()))
    return full_set


def _node_of() -> Callable:
    @F.arrow_udf(T.BinaryType())
    def node_of(sets: pa.Array) -> pa.Array:
        return pa.array([xxhash.xxh3_128_digest(s.values.to_numpy().tobytes()) for s in sets], pa.binary())
    return node_of


def _differ(x: str, y: str):
    """Population count of the XOR of two sketches."""
    return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q)).cast("int")), F.lit(0), lambda s, c: s + c)


def _sizes_fit(n, m, percent: int):
    """Sets of n and m elements can be as similar as wanted."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _wide(part: pa.Table, name: str) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    return part[name].combine_chunks().flatten().to_numpy().reshape(part.num_rows, -1)


def _candidates(part: pa.Table, label: np.ndarray, cut: int, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """A row and those rows of its bucket in other components whose sketches pass; a pair comes in the first bucket that it shares."""
    bucket, n, own, first, second = (part[c].to_numpy() for c in ("bucket", "n", "own", "first_block", "second_block"))
    sketch, bands = _wide(part, "sketch").view(np.uint64), _wide(part, "bands")
    order = np.argsort(bucket, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        one, two = first[rows[0]], second[rows[0]]
        left, right = rows[own[rows] == one], rows[own[rows] == two]
        for k, i in enumerate(left):
            at = right[k + 1 :] if one == two else right
            at = at[(label[at] != label[i]) & (100 * np.minimum(n[at], n[i]) >= percent * np.maximum(n[at], n[i]))]
            if len(at):
                at = at[bands[i][(bands[at] == bands[i]).argmax(axis=1)] == bucket[i]]
            if len(at):
                at = at[np.bitwise_count(sketch[at] ^ sketch[i]).sum(axis=1) <= cut]
            if len(at):
                yield i, at


def _labels(part: pa.Table) -> np.ndarray:
    return part["label"].combine_chunks().dictionary_encode().indices.to_numpy()


def _block_candidates(cut: int, percent: int) -> Callable[[pa.Table], pa.Table]:
    """Rows of a group that have a candidate in it."""

    def run(part: pa.Table) -> pa.Table:
        has = np.zeros(part.num_rows, dtype=bool)
        for i, at in _candidates(part, _labels(part), cut, percent):
            has[i] = has[at] = True
        return part.filter(pa.array(has))
    return run


def _block_links(cut: int, percent: int) -> Callable[[pa.Table], pa.Table]:
    """Links of a group that join components; pairs of components that are already joined in it are passed over."""

    def run(part: pa.Table) -> pa.Table:
        label = _labels(part)
        sets = part["set"].combine_chunks()
        size = sets.value_lengths().to_numpy()
        end = np.cumsum(size)
        shingles, ids = np.unique(sets.flatten().to_numpy(), return_inverse=True)
        inside = np.zeros(len(shingles), dtype=bool)
        root = np.arange(label.max() + 1)
        u, v = [], []
        for i, at in _candidates(part, label, cut, percent):
            at = at[root[label[at]] != root[label[i]]]
            if not len(at):
                continue
            mine = ids[end[i] - size[i] : end[i]]
            inside[mine] = True
            others = np.concatenate([ids[end[j] - size[j] : end[j]] for j in at])
            both = np.add.reduceat(inside[others], np.cumsum(size[at]) - size[at], dtype=np.int64)
            inside[mine] = False
            for j in at[100 * both >= percent * (size[i] + size[at] - both)]:
                x, y = root[label[i]], root[label[j]]
                if x != y:
                    root[root == y] = x
                    u.append(i)
                    v.append(j)
        node = part["node"].combine_chunks()
        return pa.table({"u": node.take(pa.array(u, pa.int64())), "v": node.take(pa.array(v, pa.int64()))})
    return run


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (),
                    samples: int = SAMPLES, bits: int = SKETCH_BITS, bands: int = BANDS) -> DataFrame:
    """One row for each row of ``docs``: id, the columns of ``carry``, n_shingles, component_id, kept.

    Two documents are linked if 100 * intersection >= ``percent`` * union of their sets of distinct
    shingles of ``words`` words (A-Z lower-cased, words split at ASCII white space). component_id is the
    smallest id of the component, kept says that the row bears it.

    Defined results: null or empty texts, and texts of white space, have no shingle and are linked with
    nothing; rows without an id belong to components like others but never name them, and are kept
    only where no row of the component has an id; repeated rows are one class and each gets its row.
    Other columns are not looked at. Very long texts are read whole; the work is linear in their length.
    """
    rows_in_band = rows_per_band(percent / 100, bands)
    cut = sketch_cut(percent / 100, samples, bits)
    sketch = _sketcher(words, samples, bits, bands, rows_in_band)
    wide = stored(docs.select(F.col(id_col).alias("id"), *carry, sketch(F.col(text_col).cast("binary")).alias("s")).select("id", *carry, "s.*"), "sketched")
    rows = wide.select("id", *carry, "n", "node")
    classes = stored(wide.filter("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "classes")

    # buckets with more than one class, each with a leader of its own choice
    spread = classes.select("node", "n", F.explode("bands").alias("bucket"))
    order = F.struct(F.hash("bucket", "node").alias("by"), "node")
    leaders = stored(spread.groupBy("bucket").agg(F.min(order).alias("lead"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles")).filter("size > 1")
                     .select("bucket", F.col("lead.node").alias("leader"), F.ceil(F.greatest(F.col("size") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks")), "leaders")
    members = stored(spread.drop("n").join(leaders, "bucket"), "members")
    crowd = members.select("node").distinct()
    shown = stored(classes.join(crowd, "node", "left_semi"), "shown")

    led = members.filter("node <> leader").select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    left = shown.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = shown.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    near = stored(led.join(left, "a").join(right, "b").filter(_sizes_fit(F.col("na"), F.col("nb"), percent)).withColumn("differ", _differ("sa", "sb"))
                  .filter(F.col("differ") <= cut).select("a", "b", "differ"), "near")
    # a class takes its best leaders first; a pair counts for either of its ends
    ends = near.select(F.col("a").alias("node"), "differ", "a", "b").unionByName(near.select(F.col("b").alias("node"), "differ", "a", "b"))
    # leaders of many are no followers here; their rows are spread over salts until they are gone
    hubs = ends.groupBy("node").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > bands).select("node", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    fewer = ends.withColumn("salt", F.pmod(F.hash("a", "b"), F.lit(SALTS))).join(hubs, ["node", "salt"], "left_anti")
    best = fewer.groupBy("node").agg(F.slice(F.sort_array(F.collect_list(F.struct("differ", "a", "b"))), 1, FIRST).alias("best"))
    chosen = best.select(F.explode("best").alias("p")).select("p.a", "p.b").distinct()

    full_set = _setter(words)

    def sets_of(nodes: DataFrame) -> DataFrame:
        """(node, set) of the classes in ``nodes``, from the texts of their representatives."""
        nodes = stored(nodes.distinct().join(shown.select("node", "rep"), "node"), "nodes")
        wanted = bitmap_of(nodes.select(F.xxhash64("rep").alias("h")), "h")
        texts = docs.select(F.col(id_col).alias("rep"), F.col(text_col).alias("text")).filter(in_bitmap(F.xxhash64("rep"), wanted))
        reps = nodes.select(F.col("rep").alias("want")).distinct()
        found = texts.join(reps, F.col("rep").eqNullSafe(F.col("want")), "left_semi").select(full_set(F.col("text").cast("binary")).alias("set"))
        return stored(found.withColumn("node", _node_of()("set")).join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets")

    def linked(pairs: DataFrame) -> DataFrame:
        """Pairs whose full sets are as similar as wanted; sets are made for the classes in ``pairs`` only."""
        pairs = stored(pairs, "pairs")
        sets = sets_of(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))))
        got = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("xa")), "a").join(sets.select(F.col("node").alias("b"), F.col("set").alias("xb")), "b")
        both = F.size(F.array_intersect("xa", "xb"))
        return stored(got.filter(100 * both >= percent * (F.size("xa") + F.size("xb") - both)).select(F.col("a").alias("u"), F.col("b").alias("v")), "links")

    links = linked(chosen)
    root = components(links)
    named = shown.join(root, "node", "left").select("node", "n", "sketch", "bands", F.coalesce("root", "node").alias("label"))
    named = stored(named, "named")
    homes = members.select("bucket", "node", "blocks").join(named.select("node", "label", "n"), "node")
    mixed = homes.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("bucket")
    mixed = stored(homes.drop("label").join(mixed, "bucket"), "mixed")
    held = mixed.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles")).first()
    parts = 1 + max(held.rows // PART, (held.shingles or 0) // PART_SHINGLES)
    # small buckets share groups, a large one is dealt over pairs of blocks
    alone = F.col("blocks") > 1
    own = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    dealt = mixed.drop("n").join(named, "node").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.when(alone, F.col("bucket")).otherwise(F.pmod(F.xxhash64("bucket"), F.lit(parts))).alias("part"), alone.alias("alone"),
        "bucket", "node", "n", "label", "sketch", "bands", "own", F.least("own", "other").alias("first_block"), F.greatest("own", "other").alias("second_block"))
    group = ["part", "alone", "first_block", "second_block"]
    close = stored(dealt.groupBy(*group).applyInArrow(_block_candidates(cut, percent), dealt.schema), "close")
    whole_sets = close.join(sets_of(close.select("node")), "node")
    more = stored(whole_sets.groupBy(*group).applyInArrow(_block_links(cut, percent), "u binary, v binary"), "more")
    links = links.unionByName(more)

    root = components(links)
    named = classes.select("node", "rep").join(root, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root"))
    lowest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    final = stored(named.join(lowest, "root").select("node", "component_id"), "components")
    whole = rows.filter("node IS NOT NULL").join(final, "node").unionByName(rows.filter("node IS NULL").withColumn("component_id", F.col("id")))
    return whole.select("id", *carry, F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
