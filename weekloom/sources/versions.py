"""Versions of a published panel: readers see a whole one or the one before, whatever happens to the run that writes.

A version's files are written to a folder of its own. A manifest, one small numbered file put in place by a rename,
makes it the current one; the highest number counts. A run has a name, so a repeated run that had already published
returns its version, and one that was lost writes into its old folder again.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.operators.setops import fingerprint
from weekloom.sources import storage
from weekloom.sources.writers import read_written, write_panel, write_summary


def manifests(spark: SparkSession, path: str) -> list[dict]:
    """All manifests in order; one for each published version."""
    folder = f"{path.rstrip('/')}/manifests"
    found = [n for n in storage.names(spark, folder) if n.endswith(".json") and not n.startswith("_")]
    return [json.loads(storage.read_text(spark, f"{folder}/{n}")) for n in found]


def current(spark: SparkSession, path: str) -> dict | None:
    folder = f"{path.rstrip('/')}/manifests"
    found = [n for n in storage.names(spark, folder) if n.endswith(".json") and not n.startswith("_")]
    return json.loads(storage.read_text(spark, f"{folder}/{found[-1]}")) if found else None


def publish_version(panel: DataFrame, path: str, run: str, fmt: str = "parquet", t: str = "week") -> dict:
    """Publish ``panel`` as the version of ``run``; returns its manifest.

    The manifest names rows and an order-free fingerprint, both taken from the written files in one pass.
    """
    spark, path = panel.sparkSession, path.rstrip("/")
    if not run or "/" in run:
        raise ValueError("run must be a name without /")
    done = [m for m in manifests(spark, path) if m["run"] == run]
    if done:
        return done[-1]
    folder = f"{path}/versions/{run}"
    storage.remove(spark, folder)                                   # what a lost attempt of this run left
    write_panel(panel, f"{folder}/panel", fmt, t=t)
    written = read_written(panel, f"{folder}/panel", fmt, t)
    write_summary(written, f"{folder}/summary", t=t)
    seen = fingerprint(written.select(panel.columns)).first()
    manifest = {"run": run, "format": fmt, "time_column": t, "rows": seen["rows"], "fingerprint": seen["fingerprint"], "columns": panel.schema.jsonValue()}
    while True:
        at = len(manifests(spark, path))
        manifest["number"] = at
        # a run that publishes at the same time takes the number first: then this one is the next
        if storage.put_new(spark, f"{path}/manifests/{at:010d}.json", json.dumps(manifest)):
            return manifest


def read_version(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    """The current version, or that of a run."""
    from pyspark.sql.types import StructType

    path = path.rstrip("/")
    found = [m for m in manifests(spark, path) if m["run"] == run] if run else [m for m in [current(spark, path)] if m]
    if not found:
        raise ValueError(f"nothing published at {path}" + (f" by {run}" if run else ""))
    m = found[-1]
    like = spark.createDataFrame([], StructType.fromJson(m["columns"]))
    return read_written(like, f"{path}/versions/{m['run']}/panel", m["format"], m["time_column"]).select(like.columns)


def remove_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete the files of all but the last ``keep`` published versions, and of unpublished runs; manifests stay."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    path = path.rstrip("/")
    kept = {m["run"] for m in manifests(spark, path)[-keep:]}
    gone = [n for n in storage.names(spark, f"{path}/versions") if n not in kept]
    for name in gone:
        storage.remove(spark, f"{path}/versions/{name}")
    return gone


def run_in_parts(entities: DataFrame, process: Callable[[DataFrame], DataFrame], path: str, run: str, parts: int = 16, key: str = "channel") -> DataFrame:
    """``process`` over the entities in ``parts`` parts, each finished for good once its marker stands; returns all results.

    A repeated run works on the parts that are left only. Parts follow from the key, so they are the same each time.
    """
    spark, folder = entities.sparkSession, f"{path.rstrip('/')}/parts/{run}"
    done = {n for n in storage.names(spark, f"{folder}/done") if not n.startswith("_")}
    for i in range(parts):
        name = f"{i:06d}-of-{parts:06d}"
        if name in done:
            continue
        part = entities.filter(F.pmod(F.hash(key), F.lit(parts)) == i)
        process(part).write.mode("overwrite").parquet(f"{folder}/data/{name}")
        storage.put_new(spark, f"{folder}/done/{name}", "")
    return spark.read.parquet(*[f"{folder}/data/{i:06d}-of-{parts:06d}" for i in range(parts)])
