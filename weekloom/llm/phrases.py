"""Phrase collocations of each language, mined by dynamic itemset counting.

Method: texts are encoded once into blocks, each with its own dictionary, and the blocks are dealt to shards. Then the
shards are scanned in a cycle. The first step counts words only; after every step the phrases that have reached the
threshold are published, and from the next step on a longer phrase is counted wherever both phrases within it, all but
its last and all but its first word, are published. Every phrase is counted for exactly one full cycle from the step
that activated it, so its count is exact; it is dropped at the end of its cycle if it stayed below the threshold. No
phrase can be missed: a frequent one has frequent parts, which are published within their own cycle.

What is published travels as one bitmap for each step and length, sized by the number of its phrases up to a bound. A
phrase that passes by chance is counted earlier than it need be, from a step that all tasks agree on, and dropped if
rare; it never counts as published before its own counting began, as no task would see the longer phrases around it
until then. So bitmaps decide about time, never about results. Blocks are counted inside tasks, counts are combined before
their shuffle, and a running count is one row for each phrase, whatever its frequency.

Words are 64-bit hashes of language and word. Frequent words are held against all words of the dictionaries, and mining
starts again with another seed if one hash stands for two.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekloom.llm.common import shared_folder, stored

#: Bytes of text in a block (a longer text is a block of its own), in all open blocks of a task, and in a pass over a block's bytes.
BLOCK_BYTES, OPEN_BYTES, PASS_BYTES = 5 << 20, 1 << 24, 1 << 20
SHARDS = 3
#: Longest word that is hashed as a polynomial.
LONG_BYTES = 64
#: log2 of the bits of a published bitmap: 16 bits a phrase between these bounds (16 MB at most).
LEAST_BITS, MOST_BITS = 15, 27
_PAGE = 15                                    # bits of a piece that Spark's bitmap functions build

#: Characters that end a piece, and those between words.
PIECE_ENDS, SPACES = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
NEVER = 1 << 30

_CLASS = np.zeros(256, np.uint8)
_CLASS[list(SPACES)] = 1
_CLASS[list(PIECE_ENDS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = 0x9E3779B97F4A7C15
ENCODED = "shard int, lang string, n_words long, keys binary, words array<string>, ids binary"
_ENCODED = pa.schema([("shard", pa.int32()), ("lang", pa.string()), ("n_words", pa.int64()), ("keys", pa.binary()), ("words", pa.list_(pa.string())), ("ids", pa.binary())])


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _number(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little")


@lru_cache(maxsize=2)
def _powers(seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A value for each byte, and the powers of an odd base and of its inverse for one pass."""
    values = np.array([_number(f"{seed}:{b}") for b in range(256)], np.uint64)
    base = _number(f"{seed}:base") | 1

    def powers(of: int) -> np.ndarray:
        out = np.full(PASS_BYTES + 1, of, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)
    return values, powers(base), powers(pow(base, -1, 1 << 64))


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Polynomial hashes of byte ranges, from prefix sums over passes of bounded size that end between words.

    Long ranges are hashed one by one: modulo 2^64 regular texts (Thue and Morse's) share a polynomial's value under every base.
    """
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, low + PASS_BYTES, "right")))
        high = int(ends[to - 1])
        if high - low > PASS_BYTES:                                # one word longer than a pass
            at = to
            continue
        values, up, down = _powers(seed)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(values[data[low:high]] * up[: high - low], out=sums[1:])
        a, b = starts[at:to] - low, ends[at:to] - low
        out[at:to] = (sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64) * np.uint64(_STEP)
        at = to
    for i in np.flatnonzero(ends - starts > min(LONG_BYTES, PASS_BYTES)):
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8, salt=str(seed).encode()).digest(), "little")
    return out


def _block(texts: list[bytes], lang: str, shard: int, seed: int) -> dict | None:
    """One block: its dictionary (hashes and words) and its words as ids; those that begin a piece are complemented."""
    data = _LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
    kinds = _CLASS[data]
    word = np.zeros(len(data) + 2, bool)
    word[1:-1] = kinds == 0
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return None
    stops = np.searchsorted(np.flatnonzero(kinds == 2), starts)
    begins = np.concatenate(([True], stops[1:] != stops[:-1]))
    hashes = _mixed(_hashes(data, starts, ends, seed) ^ np.uint64(_number(f"{seed}:lang:{lang}")))
    hashes[hashes == 0] = 1                                                    # 0 stands for no word
    keys, first, ids = np.unique(hashes, return_index=True, return_inverse=True)
    ids = ids.astype(np.int32).ravel()
    sizes = (ends - starts)[first]
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    places = np.arange(offsets[-1]) + np.repeat(starts[first] - offsets[:-1], sizes)
    words = pa.LargeStringArray.from_buffers(len(keys), pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data[places].tobytes())).cast(pa.string())
    return {"shard": shard, "lang": lang, "n_words": len(ids), "keys": keys.tobytes(), "words": words, "ids": np.where(begins, ~ids, ids).tobytes()}


def _encoder(seed: int, shards: int, block_bytes: int, open_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[str, list] = {}
        sizes: dict[str, int] = {}
        context = TaskContext.get()
        turn = context.partitionId() if context else 0

        def closed(lang: str) -> Iterator[pa.RecordBatch]:
            nonlocal turn
            row = _block(opened.pop(lang), lang, turn % shards, seed)
            sizes.pop(lang)
            if row is not None:
                turn += 1
                words = pa.ListArray.from_arrays(pa.array([0, len(row["words"])], pa.int32()), row["words"])
                yield pa.RecordBatch.from_arrays([words if f.name == "words" else pa.array([row[f.name]], f.type) for f in _ENCODED], schema=_ENCODED)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                opened.setdefault(lang, []).append(text.as_py())
                sizes[lang] = sizes.get(lang, 0) + len(opened[lang][-1])
                if sizes[lang] >= block_bytes:
                    yield from closed(lang)
                elif sum(sizes.values()) >= open_bytes:
                    yield from closed(max(sizes, key=sizes.get))
        for lang in list(opened):
            yield from closed(lang)
    return run


def encoded(docs: DataFrame, lang_col: str, text_col: str, seed: int, shards: int, block_bytes: int, open_bytes: int) -> DataFrame:
    """Blocks of ``docs``, stored by shard, so that a scan of a shard reads no other."""
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").cast("binary").alias("text")).filter("text IS NOT NULL")
    path = shared_folder(docs.sparkSession, "blocks")
    # rows are large: pages and row groups are measured at every row
    (rows.mapInArrow(_encoder(seed, shards, block_bytes, open_bytes), ENCODED).write.partitionBy("shard")
     .option("parquet.block.size", 1 << 24).option("parquet.page.size.row.check.min", 1).option("parquet.page.size.row.check.max", 1)
     .option("parquet.block.size.row.check.min", 1).option("parquet.block.size.row.check.max", 1).parquet(path))
    names = [f.split()[0] for f in ENCODED.split(", ")]
    return docs.sparkSession.read.schema(ENCODED).parquet(path).select(names)


def _phrase_key(keys: list[np.ndarray]) -> np.ndarray:
    """One 64-bit number for a phrase; only bitmaps use it."""
    out = keys[0]
    for k in keys[1:]:
        out = _mixed(out * np.uint64(_STEP) + k)
    return out


def _places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    return keys & mask, (keys >> np.uint64(32)) & mask


def _reached(keys: np.ndarray, published: list[tuple]) -> np.ndarray:
    """The step after which each phrase was published; NEVER if it was not."""
    out = np.full(len(keys), NEVER, np.int32)
    for step, bits, bitmap in published:
        table = np.frombuffer(bitmap.value, np.uint8)
        a, b = _places(keys, bits)
        found = (table[a >> np.uint64(3)] >> (a & np.uint64(7)).astype(np.uint8)) & (table[b >> np.uint64(3)] >> (b & np.uint64(7)).astype(np.uint8)) & 1
        out[(found == 1) & (out == NEVER)] = step
    return out


def count_block(keys: np.ndarray, ids: np.ndarray, step: int, shards: int, max_len: int, published: dict[int, list]) -> Iterator[tuple]:
    """(length, first step, key columns, counts) of the phrases of one block that are in their cycle at ``step``."""
    begins = ids < 0
    words = np.where(begins, ~ids, ids).astype(np.int64)
    if step < shards:
        yield 1, np.zeros(len(keys), np.int32), [keys], np.bincount(words, minlength=len(keys))
    here, local = np.arange(len(words)), words                     # places of known phrases of the length before, and their numbers
    reach = _reached(keys, published[1])
    for length in range(2, max_len + 1):
        if len(here) < 2:
            return
        # a phrase needs the shorter ones at its place and at the next one, inside one piece
        both = np.flatnonzero((here[1:] == here[:-1] + 1) & ~begins[here[1:] + length - 2])
        start = 1 + np.maximum(reach[local[both]], reach[local[both + 1]])
        known = start <= step
        both, start = both[known], start[known]
        if not len(both):
            return
        number = local[both] * len(keys) + words[here[both] + length - 1]
        here = here[both]
        _, first, local, counts = np.unique(number, return_index=True, return_inverse=True, return_counts=True)
        local = local.ravel()
        columns = [keys[words[here[first] + i]] for i in range(length)]
        active = start[first] + shards > step
        yield length, start[first][active], [c[active] for c in columns], counts[active]
        if length < max_len:
            # a phrase that passes a bitmap by chance may do so before it is looked at anywhere
            reach = np.maximum(_reached(_phrase_key(columns), published[length]), start[first])


def _counter(step: int, shards: int, max_len: int, published: dict[int, list], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, ids in zip(batch.column("keys"), batch.column("ids")):
                block = np.frombuffer(keys.as_buffer(), np.uint64), np.frombuffer(ids.as_buffer(), np.int32)
                for length, start, columns, counts in count_block(*block, step, shards, max_len, published):
                    columns = [c.view(np.int64) for c in columns] + [np.zeros(len(counts), np.int64)] * (max_len - length)
                    values = [*columns, 2 * start, counts.astype(np.int64)]
                    for at in range(0, len(counts), 1 << 16):
                        yield pa.RecordBatch.from_arrays([pa.array(v[at : at + (1 << 16)]) for v in values], schema=schema)
    return run


def _length(keys: list[str]) -> Column:
    """Words of a phrase: its columns that hold one."""
    return sum((F.col(k) != 0).cast("int") for k in keys[1:]) + F.lit(1)


def _published(fresh: DataFrame, keys: list[str], n: int):
    """A broadcast bitmap of at least ``n`` phrases; its size is bounded."""
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * n - 1).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(k).to_numpy(zero_copy_only=False).view(np.uint64) for k in keys]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(_places(_phrase_key(columns), bits)).view(np.int64))], ["place"])
    pieces = (fresh.select(*keys).mapInArrow(places, "place long").groupBy(F.shiftright("place", _PAGE).alias("piece"))
              .agg(F.call_function("bitmap_construct_agg", F.col("place").bitwiseAND(F.lit((1 << _PAGE) - 1))).alias("bits")).collect())
    table = bytearray(1 << bits - 3)
    size = 1 << _PAGE - 3
    for r in pieces:
        table[r.piece * size : (r.piece + 1) * size] = r.bits
    return bits, fresh.sparkSession.sparkContext.broadcast(bytes(table))


def _remove(path: str) -> None:
    system, inside = pa.fs.FileSystem.from_uri(path)
    if system.get_file_info(inside).type != pa.fs.FileType.NotFound:
        system.delete_dir(inside)


def _counted(spark: SparkSession, blocks: DataFrame, least: int, max_len: int, shards: int) -> tuple[DataFrame, dict[int, list]]:
    """(length, k1.., n) of all phrases of at least ``least`` occurrences, and the published bitmaps of each length.

    A running count is (k1.., state, n); ``state`` is twice the step that activated the phrase, and 1 more once it is
    published, so that the greatest state of its rows is the phrase's.
    """
    keys = [f"k{i}" for i in range(1, max_len + 1)]
    fields = [*(f"{k} long" for k in keys), "state int", "n long"]
    schema = pa.schema([(f.split()[0], pa.int32() if f.endswith("int") else pa.int64()) for f in fields])
    stores = ", ".join([*fields, "complete boolean"])
    root = shared_folder(spark, "phrases")
    published: dict[int, list] = {length: [] for length in range(1, max_len)}
    finished, carried, step, last = [], None, 0, -1
    length = _length(keys)
    is_fresh = (F.col("n") >= least) & (F.col("state") % 2 == 0) & (length < max_len)
    # what is published after step s is complete after step s + shards
    while step < shards or step <= last + shards:
        rows = blocks.filter(F.col("shard") == step % shards).select("keys", "ids").mapInArrow(_counter(step, shards, max_len, published, schema), ", ".join(fields))
        if carried is not None:
            rows = rows.unionByName(carried)
        complete = F.floor(F.col("state") / 2) + shards <= step + 1
        path = f"{root}/step-{step}"
        (rows.groupBy(*keys).agg(F.max("state").alias("state"), F.sum("n").alias("n")).withColumn("complete", complete)
         .filter(~F.col("complete") | (F.col("n") >= least)).write.partitionBy("complete").parquet(path))
        if step:
            _remove(f"{root}/step-{step - 1}/complete=false")                    # merged into this step's counts
        now = spark.read.schema(stores).option("basePath", path).parquet(path)
        fresh = now.filter(is_fresh)
        for r in sorted(fresh.groupBy(length.alias("length")).count().collect()):
            bits, bitmap = _published(fresh.filter(length == r.length), keys[: r.length], r["count"])
            published[r.length].append((step, bits, bitmap))
            last = step
        carried = now.filter(~F.col("complete")).select(*keys, (F.col("state") + is_fresh.cast("int")).alias("state"), "n")
        finished.append(now.filter("complete").select(length.alias("length"), *keys, "n"))
        step += 1
    _remove(f"{root}/step-{step - 1}/complete=false")
    out = finished[0]
    for part in finished[1:]:
        out = out.unionByName(part)
    return out, published


def _speller(published: list[tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, keys, words in zip(batch.column("lang").to_pylist(), batch.column("keys"), batch.column("words")):
                table = np.frombuffer(keys.as_buffer(), np.uint64)
                kept = np.flatnonzero(_reached(table, published) != NEVER)
                yield pa.RecordBatch.from_arrays([pa.array(table[kept].view(np.int64)), pa.array([lang] * len(kept), pa.string()), words.values.take(pa.array(kept))], ["key", "lang", "word"])
    return run


def _cut_score(left: Column, right: Column) -> Column:
    """floor(10^6 a^2 / (l r)), exact up to 10^14 occurrences."""
    a, l, r = (c.cast("decimal(14,0)") for c in (F.col("a"), left, right))
    return F.call_function("div", a * a * F.lit(1000000).cast("decimal(7,0)"), l * r)


def _ranked(found: DataFrame, top: int | None) -> DataFrame:
    """Ranks within each language, at most ``top``. Range parts are ranked by themselves and shifted by the rows of the parts
    before, so a language with most of the phrases is no single task."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    parts = stored(found.repartitionByRange("lang", *order).withColumn("part", F.spark_partition_id()), "ranges")
    sizes = parts.groupBy("lang", "part").count()
    earlier = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("before", F.coalesce(F.sum("count").over(earlier), F.lit(0))).drop("count")
    if top is not None:
        before = before.filter(F.col("before") < top)
    inside = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    ranked = parts.join(before, ["lang", "part"]).withColumn("rank", (F.col("before") + inside).cast("long"))
    return (ranked if top is None else ranked.filter(F.col("rank") <= top)).drop("part", "before")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 10, max_len: int = 3, top: int | None = 2000,
                 covered: int = 50, shards: int = SHARDS, block_bytes: int = BLOCK_BYTES, open_bytes: int = OPEN_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best ``top`` phrases (None: all) of 2 to ``max_len`` words of each language.

    A phrase of ``a`` >= ``least`` occurrences is cut where floor(10^6 a^2 / (l r)) is lowest, first cut on ties; a phrase is
    left out if a longer candidate around it has at least ``covered`` percent of its occurrences. ``n`` is the number of
    words of the language. Order: score, a, then the phrase by its bytes.
    Defined results: null and empty texts have no words, a null language is ``und``; repeated rows count as often as
    they come; without texts there are no rows; other columns are not looked at. One text must fit in a task.
    """
    spark = docs.sparkSession
    keys = [f"k{i}" for i in range(1, max_len + 1)]
    for seed in range(8):
        blocks = encoded(docs, lang_col, text_col, seed, shards, block_bytes, open_bytes)
        counted, published = _counted(spark, blocks, least, max_len, shards)
        spelled = (blocks.select("lang", "keys", "words").mapInArrow(_speller(published[1]), "key long, lang string, word string").groupBy("key")
                   .agg(F.min(F.struct("lang", "word")).alias("low"), F.max(F.struct("lang", "word")).alias("high")))
        frequent = counted.filter("length = 1").select(F.col("k1").alias("key"), F.col("n").alias("f"))
        words = stored(frequent.join(spelled, "key"), "words")
        if words.filter("low <> high").isEmpty():
            break
    else:
        raise ValueError("hashes of words collide under every seed")
    words = words.select("key", "f", F.col("low.lang").alias("lang"), F.col("low.word").alias("word"))
    phrases = {length: stored(counted.filter(F.col("length") == length).select(*keys[:length], F.col("n").alias("a")), f"phrases-{length}") for length in range(2, max_len + 1)}

    found = None
    for length, rows in phrases.items():
        mine = keys[:length]
        for i, k in enumerate(mine):
            rows = rows.join(words.select(F.col("key").alias(k), F.col("f").alias(f"f{i}_{i + 1}"), F.col("word").alias(f"w{i}"), *(["lang"] if not i else [])), k)
        for size in range(2, length):
            for a in {0, length - size}:
                part = phrases[size].select(*(F.col(k).alias(mine[a + i]) for i, k in enumerate(keys[:size])), F.col("a").alias(f"f{a}_{a + size}"))
                rows = rows.join(part, mine[a : a + size])
        best = F.array_min(F.array(*(F.struct(_cut_score(F.col(f"f0_{k}"), F.col(f"f{k}_{length}")).alias("score"), F.lit(k).alias("cut"), F.col(f"f0_{k}").alias("l"), F.col(f"f{k}_{length}").alias("r"))
                                     for k in range(1, length))))
        rows = rows.withColumn("best", best)
        # the most frequent longer phrase around each one
        around = None
        for longer in range(length + 1, max_len + 1):
            for a in range(longer - length + 1):
                part = phrases[longer].select(*(F.col(keys[a + i]).alias(k) for i, k in enumerate(mine)), F.col("a").alias("longer"))
                around = part if around is None else around.unionByName(part)
        if around is not None:
            rows = rows.join(around.groupBy(*mine).agg(F.max("longer").alias("longer")), mine, "left").filter(
                F.col("longer").isNull() | (F.lit(100).cast("decimal(3,0)") * F.col("longer") < F.lit(covered).cast("decimal(3,0)") * F.col("a")))
        rows = rows.select("lang", F.concat_ws(" ", *(f"w{i}" for i in range(length))).alias("phrase"), "a", "best.l", "best.r", "best.score")
        found = rows if found is None else found.unionByName(rows)
    ranked = _ranked(stored(found, "candidates"), top)
    sizes = blocks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
