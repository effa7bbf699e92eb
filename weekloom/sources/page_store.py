"""A store of pages that are fetched where they lie.

Pages are put in hash buckets by (entity, stamp) once, when they arrive. A fetch of chosen snapshots then sends the
snapshots' keys to the buckets: no exchange carries a page's text, however large the choice is. Buckets are matched by a
hashed join that builds on the keys, so pages are not sorted either.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.functions.key_filter import key_filter

#: Bytes of page text in a bucket, before compression.
BUCKET_BYTES = 256 << 20
PAGE_COLUMNS = ("channel", "snapshot_ts", "url", "html")


@dataclass(frozen=True)
class PageStore:
    """An open store: its pages, bucketed by ``key`` and ``stamp``."""

    pages: DataFrame
    key: str
    stamp: str
    buckets: int

    def fetch(self, picks: DataFrame) -> DataFrame:
        """Pages whose (key, stamp) is in ``picks``; null keys match nothing, repeated picks change nothing."""
        wanted = picks.select(self.key, self.stamp)
        return self.pages.join(wanted.hint("shuffle_hash"), [self.key, self.stamp], "left_semi")


def _table(path: str) -> str:
    return "page_store_" + hashlib.md5(path.encode()).hexdigest()


def write_page_store(pages: DataFrame, path: str, buckets: int | None = None, key: str = "channel", stamp: str = "snapshot_ts",
                     html: str = "html", mode: str = "errorifexists") -> PageStore:
    """Put ``pages`` into the store at ``path``. The number of buckets follows from the bytes of their html.

    ``append`` adds a crawl to the store, in its buckets. One exchange deals the pages out, so each task writes one file.
    """
    spark, path = pages.sparkSession, path.rstrip("/")
    missing = [c for c in (key, stamp, html) if c not in pages.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    if mode == "append":
        old = _layout(spark, path)
        key, stamp, buckets = old["key"], old["stamp"], old["buckets"]
    elif mode != "errorifexists":
        raise ValueError("mode must be errorifexists or append")
    if buckets is None:
        size = pages.agg(F.sum(F.octet_length(html))).first()[0] or 0
        buckets = max(8, -(-size // BUCKET_BYTES))
    if mode == "append":
        open_page_store(spark, path)                       # the session may not know the table yet
    # dealt out as the buckets are, so no task writes to more than one
    dealt = pages.repartition(buckets, key, stamp)
    (dealt.write.format("parquet").mode(mode).option("compression", "zstd").bucketBy(buckets, key, stamp)
     .option("path", f"{path}/pages").saveAsTable(_table(path)))
    if mode != "append":
        # named last: a store without its layout is one whose writing failed
        layout = spark.createDataFrame([(key, stamp, buckets)], "key string, stamp string, buckets int")
        layout.coalesce(1).write.json(f"{path}/layout")
    return open_page_store(spark, path)


def _layout(spark: SparkSession, path: str) -> dict:
    row = spark.read.schema("key string, stamp string, buckets int").json(f"{path}/layout").first()
    if row is None:
        raise ValueError(f"no page store at {path}")
    return row.asDict()


def open_page_store(spark: SparkSession, path: str) -> PageStore:
    """The store at ``path``; a session that did not write it is told of its buckets from the stored layout."""
    path = path.rstrip("/")
    layout = _layout(spark, path)
    name = _table(path)
    if not spark.catalog.tableExists(name):
        schema = spark.read.parquet(f"{path}/pages").schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{layout['key']}`, `{layout['stamp']}`) "
                  f"INTO {layout['buckets']} BUCKETS LOCATION '{path}/pages'")
    spark.catalog.refreshTable(name)
    return PageStore(spark.table(name), layout["key"], layout["stamp"], layout["buckets"])


def fetch_pages(pages: DataFrame | PageStore, picks: DataFrame, key: str = "channel", stamp: str = "snapshot_ts") -> DataFrame:
    """Pages of the chosen snapshots (``key``, ``stamp``).

    From a store no page moves. From any other frame a filter sized by the choice drops most foreign pages at the scan,
    and the join shuffles the rest.
    """
    if isinstance(pages, PageStore):
        return pages.fetch(picks)
    wanted = picks.select(key, stamp).distinct()
    # an inner join: a semi join would be moved below the filter's join and then shuffle every page
    return key_filter(wanted, key, stamp).passes(pages, key, stamp).join(wanted, [key, stamp]).select(pages.columns)
