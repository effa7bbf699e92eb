"""Exact deduplication of an incoming batch against an immutable snapshot.

Texts are equal when they are the same bytes after lower-casing A-Z. Method: the snapshot's distinct
SHA-256 digests are split over shards of about ``SHARD_KEYS`` keys, each with a static binary-fuse
filter. The batch is first grouped by digest on its own, so a text that comes in a million times is
screened once. Digests that their shard's filter does not know are new and meet no join; the others
join the snapshot's exact buckets, and one text of either side is compared byte by byte.

Only digests are shuffled, except for the texts that the byte check compares (two of each digest that
both sides have). Groups are aggregates that combine in the map task, so their size does not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom.llm import fuse
from weekloom.llm.common import ascii_lower, stored

SHARD_KEYS = 1 << 14


@F.arrow_udf(T.BinaryType())
def text_digest(texts: pa.Array) -> pa.Array:
    """SHA-256 of the text's UTF-8 bytes with A-Z lower-cased; null counts as empty."""
    return pa.array([hashlib.sha256((t or b"").lower()).digest() for t in texts.to_pylist()], pa.binary())


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *carry: str) -> DataFrame:
    """(id, digest) and the columns named in ``carry``, one row for each row of ``docs``."""
    return docs.select(F.col(id_col).alias("id"), text_digest(F.col(text_col).cast("binary")).alias("digest"), *carry)


def _keys(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(d[:8] for d in digests), dtype=np.uint64)


def _build(part: pd.DataFrame) -> pd.DataFrame:
    seed, length, starts, prints = fuse.build(_keys(part.digest))
    return pd.DataFrame({"shard": part.shard.iloc[:1], "seed": [seed], "length": [length], "starts": [starts], "prints": [prints]})


def build_filters(groups: DataFrame) -> DataFrame:
    """One filter for each value of ``shard``: (shard, seed, length, starts, prints)."""
    return (groups.select("shard", "digest").groupBy("shard")
            .applyInPandas(_build, "shard long, seed long, length long, starts long, prints binary"))


def _screen(part: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    if filters.empty or part.empty:
        return part.assign(maybe=False)
    f = filters.iloc[0]
    return part.assign(maybe=fuse.contains(_keys(part.digest), f.seed, f.length, f.starts, f.prints))


def screen(groups: DataFrame, filters: DataFrame) -> DataFrame:
    """``groups`` with ``maybe``: false if the snapshot surely lacks the digest."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in groups.schema.fields)
    return groups.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(_screen, f"{fields}, maybe boolean")


def _texts_of(wanted: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(digest, text) of the rows named in ``wanted``(digest, keep); a repeated id may bring other texts, which the digest sorts out."""
    named = docs.select(F.col(id_col).alias("keep"), F.col(text_col).alias("text"))
    got = named.join(wanted.select("digest", "keep"), "keep")
    same = text_digest(F.col("text").cast("binary")) == F.col("digest")
    return got.filter(same).select("digest", ascii_lower(F.coalesce("text", F.lit(""))).alias("text"))


def exact_dedup(snapshot: DataFrame, batch: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (),
                shard_keys: int = SHARD_KEYS) -> DataFrame:
    """One row for each row of ``snapshot`` and of ``batch``.

    Columns: id, the columns of ``carry`` (of both tables), keep_id (largest id with an equal text),
    group_size (rows with an equal text), kept, text_sha256 (hex, of the normalised text).

    Defined results: a null text counts as empty. Ids are compared with null as the smallest; in a
    group without any id keep_id is null and every row is kept. A row that is repeated with its id is
    kept or dropped with its twin, as both bear the id that stays. Empty tables on either side give
    the other side's groups. Other columns are not looked at. Rows without an id take no part in the
    byte check; their equality rests on SHA-256.
    """
    rows = stored(digest_rows(snapshot, id_col, text_col, *carry).withColumn("side", F.lit(0))
                  .unionByName(digest_rows(batch, id_col, text_col, *carry).withColumn("side", F.lit(1))), "digests")
    groups = stored(rows.groupBy("side", "digest").agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("size")), "groups")
    counts = {r.side: r.n for r in groups.groupBy("side").agg(F.count(F.lit(1)).alias("n")).collect()}
    shards = -(-max(1, *counts.values(), 1) // shard_keys)
    groups = groups.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)))
    old, new = (groups.filter(F.col("side") == side).drop("side") for side in (0, 1))

    screened = stored(screen(new, build_filters(old)), "screened")
    both = stored(screened.filter("maybe").select("digest", F.col("keep").alias("b_keep"), F.col("size").alias("b_size"))
                  .join(old.select("digest", "keep", "size"), "digest"), "matched")

    texts = (_texts_of(both, snapshot, id_col, text_col)
             .unionByName(_texts_of(both.select("digest", F.col("b_keep").alias("keep")), batch, id_col, text_col)))
    differ = texts.groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high")).filter("low <> high").select("digest")
    same = stored(both.join(differ, "digest", "left_anti")
                  .select("digest", F.greatest("keep", "b_keep").alias("all_keep"), (F.col("size") + F.col("b_size")).alias("all_size")), "equal")

    def merged(groups: DataFrame, side: int) -> DataFrame:
        return (groups.join(same, "digest", "left")
                .select(F.lit(side).alias("side"), "digest", F.coalesce("all_keep", "keep").alias("keep_id"), F.coalesce("all_size", "size").alias("group_size")))

    fresh = screened.filter("NOT maybe").select(F.lit(1).alias("side"), "digest", F.col("keep").alias("keep_id"), F.col("size").alias("group_size"))
    final = stored(merged(old, 0).unionByName(merged(screened.filter("maybe"), 1)).unionByName(fresh), "final")
    return (rows.join(final, ["side", "digest"])
            .select("id", *carry, "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")))


def halves(docs: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Splits a table into a snapshot and a batch by a hash of the id; every row is in one of them."""
    first = F.pmod(F.xxhash64(F.col(id_col)), F.lit(2)) == 0
    return docs.filter(first), docs.filter(~first)

