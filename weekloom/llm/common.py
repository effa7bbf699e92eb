"""Shared folders, intermediate tables and byte-level text helpers of the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local master (tests) may run without the setting and then gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="weekloom-llm-")
    return f"{root.rstrip('/')}/weekloom-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Cuts the lineage so that a lost executor costs a read, gives later joins true sizes, and keeps
    an expensive frame that has several readers from being computed more than once.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of runs of anything but space, tab, line feed, vertical tab, form feed and carriage return; null: 0."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]++|[\x20\x09-\x0D]++$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]++"))).cast("long")


def text_key(text: Column) -> Column:
    """A 64-bit key of a text; with the document id it names a row whose id is null or repeated."""
    return F.xxhash64(text)


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, longer by underscores until no column of ``frames`` bears it in any case."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose (id, text key) is not in ``dropped``(id_col, text_key); ids compare null-safe."""
    id_name, key_name, text_name = (unused(n, docs) for n in ("__id", "__key", "__text_key"))
    gone = dropped.select(F.col(f"`{id_col}`").alias(id_name), F.col("text_key").alias(key_name)).distinct()
    kept = docs.withColumn(text_name, text_key(F.col(f"`{text_col}`")))
    return kept.join(gone, F.col(f"`{id_col}`").eqNullSafe(F.col(id_name)) & (F.col(text_name) == F.col(key_name)), "left_anti").drop(text_name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
