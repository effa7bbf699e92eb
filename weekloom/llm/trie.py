"""Prefix trie of conversations: which openings are shared, by how many, and what sharing saves.

Method: turns are dictionary-encoded, so a conversation is an array of ids. The arrays are sorted into range shards; a
task reads its shard as blocks of bounded size and files each block in a ternary search tree, medians first, so that
the tree is balanced although its input is sorted. One pass over a tree's nodes from the last to the first adds up
members, leaves and savings without recursion. Only nodes on the path of a block's first or last conversation can
exist in another block too: they are merged by a sum over blocks, with corrections for what neighbours count twice.

Shuffled are keys and ids, never texts. Equal conversations meet as rows of at most ``BUCKET`` members, and only the
digest of a node's members passes one task, as a stream of such rows. A conversation must fit in a row, at 8 bytes for
each id and each length; a block holds one conversation at least.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.llm.common import stored

#: Ids of conversations are grouped by ranges of this width, so no group of equal conversations is larger.
BUCKET = 256
#: Turns in a block.
BLOCK_TURNS = 1 << 17
#: A turn that makes up at least this part of all turns is looked up by a broadcast table, so that table has at most as many rows.
COMMON = 1000

NOBODY = hashlib.sha256(b"").hexdigest()

NODE = """kind int, part int, block long, key binary, parent_key binary, conv long, depth long, parent_conv long, n_convs long, n_children long,
n_leaves long, saved long, ends string, first array<long>, first_chars array<long>, last array<long>"""
INNER, EDGE, ENDS = 0, 1, 2
_NAMES = [f.split()[0] for f in NODE.replace("\n", " ").split(", ")]
_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
_SCHEMA = pa.schema([pa.field(f.split()[0], _KINDS[f.split()[1]]) for f in NODE.replace("\n", " ").split(", ")])


def sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, ids, chars): the encoded turns of each conversation and the code points of their texts.

    Defined results: turns are ordered by number, null first, then by role and by the digest of role and text; repeated
    rows are repeated turns; null roles and texts are empty; rows without a conversation are left out; the dictionary
    is stored, so ids stay the same when an executor is lost, and carry no meaning; other columns are not looked at.
    """
    role, text = F.coalesce(F.col(f"`{role_col}`"), F.lit("")), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = turns.filter(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"), role.alias("role"),
        F.unhex(F.md5(F.concat(F.md5(role), F.md5(text)))).alias("key"), F.length(text).cast("long").alias("chars"))
    words = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).withColumn("id", F.monotonically_increasing_id()), "turns")
    level = words.agg(F.sum("n")).first()[0] or 0
    is_common = F.col("n") * COMMON >= F.lit(level)
    common = words.filter(is_common).select("key", "id")                        # at most COMMON rows
    looked_up = rows.join(F.broadcast(common), "key", "left")
    others = looked_up.filter("id IS NULL").drop("id").join(words.filter(~is_common).select("key", "id"), "key")
    coded = looked_up.filter("id IS NOT NULL").unionByName(others)
    listed = coded.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "key", "id", "chars"))).alias("turns"))
    return listed.select("conv", F.col("turns.id").alias("ids"), F.col("turns.chars").alias("chars"))


def with_openings(seqs: DataFrame, donor: Column, n_turns: Column, most: int) -> DataFrame:
    """``seqs`` in which the first ``n_turns`` (at most ``most``) turns are those of conversation ``donor``, as far as it has them."""
    seqs = stored(seqs, "sequences")
    openings = seqs.select(F.col("conv").alias("donor"), F.slice("ids", 1, most).alias("head"), F.slice("chars", 1, most).alias("head_chars"))
    asked = seqs.withColumn("donor", donor).withColumn("h", n_turns.cast("int"))
    none = F.array().cast("array<bigint>")

    def spliced(head: str, own: str) -> Column:
        return F.concat(F.slice(F.coalesce(head, none), F.lit(1), F.col("h")), F.slice(own, F.col("h") + 1, F.greatest(F.size(own) - F.col("h"), F.lit(0))))
    given = asked.select("donor").distinct().join(openings, "donor")            # an opening that nobody asks for is not sent on
    return asked.join(given, "donor", "left").select("conv", spliced("head", "ids").alias("ids"), spliced("head_chars", "chars").alias("chars"))


def _key(above: bytes, turn: int) -> bytes:
    return hashlib.blake2b(above + turn.to_bytes(8, "little", signed=True), digest_size=16).digest()


def _common(a: list, b: list) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _edge(part: int, block: int, key: bytes, above: bytes | None, depth: int, **values) -> dict:
    return {"kind": EDGE, "part": part, "block": block, "key": key, "parent_key": above, "depth": depth,
            "conv": None, "n_convs": 0, "n_children": 0, "n_leaves": 0, "saved": 0, "ends": None, **values}


def corrections(part: int, block: int, before: list, first: list, chars: list) -> Iterator[dict]:
    """What two neighbouring blocks count twice, given the last sequence of the one and the first of the other."""
    shared = _common(before, first)
    keys = [b""]
    for turn in first[:shared]:
        keys.append(_key(keys[-1], turn))
    below = 0                                                                  # code points of the shared turns from here on
    for depth in range(shared, -1, -1):
        below += chars[depth - 1] if depth else 0
        yield _edge(part, block, keys[depth], keys[depth - 1] if depth else None, depth, n_children=-1 if depth < shared else 0,
                    n_leaves=-1 if len(before) == shared else 0, saved=below)


class Block:
    """Ternary search tree over one block of sorted, distinct sequences."""

    def __init__(self, seqs: list[tuple]):
        """``seqs``: (ids, chars, n, conv, ends)."""
        self.turn, self.lo, self.eq, self.hi = [None], [-1], [-1], [-1]
        self.above, self.depth, self.chars = [-1], [0], [0]
        self.n, self.conv, self.ends = [0], [None], [None]
        # medians first: every half is filed after the sequence between them
        waiting = [(0, len(seqs))]
        while waiting:
            a, b = waiting.pop()
            if a < b:
                middle = (a + b) // 2
                self.insert(*seqs[middle])
                waiting += [(a, middle), (middle + 1, b)]
        size = len(self.turn)
        self.children, self.leaves, self.saved = [0] * size, [0] * size, [0] * size
        for i in range(size - 1, -1, -1):                                      # nodes come after the node above them
            self.leaves[i] += not self.children[i]
            self.saved[i] += (self.n[i] - 1) * self.chars[i]
            up = self.above[i]
            if up >= 0:
                self.children[up] += 1
                self.leaves[up] += self.leaves[i]
                self.saved[up] += self.saved[i]

    def insert(self, ids: list, chars: list, n: int, conv: int, ends: str) -> None:
        at = 0
        self.count(0, n, conv)
        for turn, size in zip(ids, chars):
            at = self.step(at, turn, size, True)
            self.count(at, n, conv)
        self.ends[at] = ends

    def count(self, at: int, n: int, conv: int) -> None:
        self.n[at] += n
        if self.conv[at] is None or conv < self.conv[at]:
            self.conv[at] = conv

    def step(self, above: int, turn: int, size: int = 0, grow: bool = False) -> int:
        links, at = self.eq, above
        while links[at] >= 0:
            here = links[at]
            if turn == self.turn[here]:
                return here
            links, at = (self.lo if turn < self.turn[here] else self.hi), here
        if not grow:
            return -1
        new = links[at] = len(self.turn)
        self.turn.append(turn)
        for links in (self.lo, self.eq, self.hi):
            links.append(-1)
        self.above.append(above)
        self.depth.append(self.depth[above] + 1)
        self.chars.append(size)
        self.n.append(0)
        self.conv.append(None)
        self.ends.append(None)
        return new

    def rows(self, part: int, block: int, first: list, last: list) -> Iterator[dict]:
        keys = {0: b""}                                                        # nodes that another block may hold too
        for path in (first, last):
            at = 0
            for turn in path:
                below = self.step(at, turn)
                keys[below] = _key(keys[at], turn)
                at = below
        for i in range(len(self.turn)):
            up = self.above[i]
            values = {"conv": self.conv[i], "n_convs": self.n[i], "n_children": self.children[i], "n_leaves": self.leaves[i], "saved": self.saved[i], "ends": self.ends[i]}
            if i in keys:
                yield _edge(part, block, keys[i], keys[up] if i else None, self.depth[i], **values)
            else:
                shared = up in keys
                yield {"kind": INNER, "part": part, "block": block, "parent_key": keys[up] if shared else None, "parent_conv": None if shared else self.conv[up],
                       "depth": self.depth[i], **values}


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of equal ids, which follow each other in order of their members, as one: (part, ids, chars, n, conv, ends)."""
    now, digest = None, None
    for batch in batches:
        for r in batch.to_pylist():
            if now is not None and r["ids"] == now[1]:
                digest.update(b"," + r["members"].encode())
                now[3] += r["n"]
                now[4] = min(now[4], r["conv"])
                continue
            if now is not None:
                yield (*now, digest.hexdigest())
            now, digest = [r["part"], r["ids"], r["chars"], r["n"], r["conv"]], hashlib.sha256(r["members"].encode())
    if now is not None:
        yield (*now, digest.hexdigest())


def _builder(block_turns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = first_chars = part = None
        block, held, size = 0, [], 0

        def built() -> Iterator[pa.RecordBatch]:
            nonlocal first, first_chars, last, block
            mine, mine_last = held[0][0], held[-1][0]
            out = list(Block(held).rows(part, block, mine, mine_last))
            if last is None:
                first, first_chars = mine, held[0][1]
            else:
                out += corrections(part, block, last, mine, held[0][1])
            last = mine_last
            block += 1
            for at in range(0, len(out), 10000):
                yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in _NAMES} for r in out[at : at + 10000]], schema=_SCHEMA)
        for here, *seq in _folded(batches):
            if held and size + len(seq[0]) > block_turns:
                yield from built()
                held, size = [], 0
            part = here
            held.append(seq)
            size += len(seq[0])
        if held:
            yield from built()
            yield pa.RecordBatch.from_pylist([{n: None for n in _NAMES} | {"kind": ENDS, "part": part, "first": first, "first_chars": first_chars, "last": last}], schema=_SCHEMA)
    return run


def _seams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            rows = list(corrections(r["part"], -1, r["last"], r["first"], r["first_chars"]))
            yield pa.RecordBatch.from_pylist([{n: x.get(n) for n in _NAMES} for x in rows], schema=_SCHEMA)


def prefix_trie(seqs: DataFrame, block_turns: int = BLOCK_TURNS, bucket: int = BUCKET) -> DataFrame:
    """(conv, depth, parent_conv, n_convs, n_children, n_leaves, saved, ends): a row for each distinct opening of ``seqs``(conv, ids, chars).

    ``conv`` is the smallest member, ``n_convs`` the number of members, ``saved`` the code points that members need not
    repeat, over the node and all below it; ``ends`` is the SHA-256 of the ids of the members that end here, ascending,
    joined by commas.
    Defined results: conversations without turns are members of the root alone; without conversations there is no
    node; the ids in ``conv`` are those of distinct conversations.
    """
    members = F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")))
    grouped = (seqs.groupBy("ids", "chars", F.floor(F.col("conv") / bucket).alias("bucket"))
               .agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"), members.alias("members")))
    ranged = (stored(grouped, "members").repartitionByRange("ids").sortWithinPartitions("ids", "bucket")
              .select(F.spark_partition_id().alias("part"), "ids", "chars", "n", "conv", "members"))
    pieces = stored(ranged.mapInArrow(_builder(block_turns), NODE), "trie")
    # one row for each shard
    seams = (pieces.filter(F.col("kind") == ENDS).withColumn("last", F.lag("last").over(Window.orderBy("part"))).filter("last IS NOT NULL")
             .mapInArrow(_seams, NODE))
    edges = pieces.filter(F.col("kind") == EDGE)
    merged = stored(edges.unionByName(seams).groupBy("key", "parent_key", "depth").agg(
        F.min("conv").alias("conv"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")), F.max("ends").alias("ends")), "edges")
    above = merged.select(F.col("key").alias("parent_key"), F.col("conv").alias("parent_conv"))
    # a block's nodes meet the merged nodes above them by block, so a node with very many children is no hot key
    known = edges.filter("block >= 0 AND n_convs > 0").select("part", "block", F.col("key").alias("parent_key")).join(above, "parent_key")
    inner = pieces.filter(F.col("kind") == INNER)
    below = inner.filter("parent_key IS NOT NULL").drop("parent_conv").join(known, ["part", "block", "parent_key"])
    columns = ["conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved", F.coalesce("ends", F.lit(NOBODY)).alias("ends")]
    return (inner.filter("parent_key IS NULL").select(columns).unionByName(below.select(columns))
            .unionByName(merged.join(above, "parent_key", "left").select(columns)))
