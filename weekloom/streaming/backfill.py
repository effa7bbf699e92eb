"""Late rows merged into a stored weekly panel: only what they touch is computed and written again.

The panel lies in partitions of (entity bucket, year). A batch of rows, late or not, touches the entities it names from
its earliest week on; deltas are taken again for that suffix alone, and only the partitions that hold it are replaced.
Merging a batch twice gives the same panel, so a run that was lost is simply repeated; the ledger spares the work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.functions.scalars import week_start_sunday
from weekloom.operators.windows import deltas
from weekloom.sources import storage

BUCKETS = 64
METRICS = ("views", "subs")


def weekly_rows(obs: DataFrame, key: str = "channel", t: str = "obs_date", metrics=METRICS) -> DataFrame:
    """The last observation of each entity and week, the greater counts on ties. Rows can be merged with rows made by it before."""
    best = obs.groupBy(key, week_start_sunday(t).alias("week")).agg(F.max(F.struct(F.col(t), *metrics)).alias("_r"))
    return best.select(key, "week", f"_r.{t}", *[f"_r.{m}" for m in metrics])


def _placed(rows: DataFrame, buckets: int, key: str) -> DataFrame:
    return rows.withColumns({"bucket": F.pmod(F.hash(key), F.lit(buckets)), "year": F.year("week")})


def _schema(obs: DataFrame, key: str, t: str, metrics) -> str:
    kinds = dict(obs.dtypes)
    return ", ".join([f"{key} {kinds[key]}", "week date", f"{t} {kinds[t]}", *(f"{m} {kinds[m]}" for m in metrics), *(f"delta_{m} bigint" for m in metrics), "bucket int", "year int"])


def _write(rows: DataFrame, path: str) -> None:
    # each partition is one file, whatever number of tasks computed it
    (rows.repartition("bucket", "year").sortWithinPartitions("bucket", "year").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket", "year").parquet(path))


def merge_observations(spark: SparkSession, path: str, obs: DataFrame, key: str = "channel", t: str = "obs_date", metrics=METRICS, buckets: int = BUCKETS) -> DataFrame:
    """Bring ``obs`` into the panel at ``path`` (made if absent) and return the panel.

    Defined results: no rows change nothing; rows without entity or day are left out; repeated rows count once; the
    number of buckets is that of the first call.
    """
    obs = obs.filter(F.col(key).isNotNull() & F.col(t).isNotNull()).select(key, t, *metrics)
    columns = [key, "week", t, *metrics]
    made = spark.read.schema("buckets int").json(f"{path}/layout").first() if storage.exists(spark, f"{path}/layout") else None
    if made is None:
        _write(_placed(deltas(weekly_rows(obs, key, t, metrics), list(metrics), key, "week"), buckets, key), f"{path}/data")
        spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").json(f"{path}/layout")
        return read_merged(spark, path, obs, key, t, metrics)
    buckets = made.buckets
    panel = read_merged(spark, path, obs, key, t, metrics)
    fresh = weekly_rows(obs, key, t, metrics)
    touched = fresh.groupBy(key).agg(F.min("week").alias("_from"))
    # partitions to replace: of each touched bucket the years from its earliest week on
    hit = _placed(touched.withColumnRenamed("_from", "week"), buckets, key).groupBy("bucket").agg(F.min("year").alias("_year"))
    spots = {r.bucket: r["_year"] for r in hit.collect()}                        # at most one row for each bucket
    if not spots:
        return panel
    # literal conditions on the partition columns: no other partition is read or listed in the write
    replaced = " OR ".join(f"(bucket = {b} AND year >= {y})" for b, y in sorted(spots.items()))
    reach = f"bucket IN ({', '.join(map(str, sorted(spots)))})"
    old = panel.filter(reach).join(touched, key, "left")
    held = old.filter(F.col("_from").isNull() | (F.col("week") < F.col("_from"))).drop("_from").filter(replaced)
    # of a touched entity: the week before its suffix, the suffix as it was, and the new rows
    before = old.filter(F.col("week") < F.col("_from")).groupBy(key).agg(F.max(F.struct(*columns[1:])).alias("_r")).select(key, "_r.*")
    suffix = old.filter(F.col("week") >= F.col("_from")).select(columns)
    merged = suffix.unionByName(fresh).groupBy(key, "week").agg(F.max(F.struct(t, *metrics)).alias("_r")).select(key, "week", "_r.*")
    again = deltas(merged.unionByName(before), list(metrics), key, "week").join(touched, key).filter(F.col("week") >= F.col("_from")).drop("_from")
    _write(held.unionByName(_placed(again, buckets, key).select(held.columns)), f"{path}/data")
    return read_merged(spark, path, obs, key, t, metrics)


def read_merged(spark: SparkSession, path: str, like: DataFrame, key: str = "channel", t: str = "obs_date", metrics=METRICS) -> DataFrame:
    """The panel at ``path``; ``like`` gives the types of its columns."""
    return spark.read.schema(_schema(like, key, t, metrics)).parquet(f"{path}/data")


def run_backfill(spark: SparkSession, path: str, late_path: str, schema: str, key: str = "channel", t: str = "obs_date", metrics=METRICS) -> list[int]:
    """Merge the late rows of all batches under ``late_path`` (as ``stream_late`` writes them) that were not merged yet.

    Returns their batch numbers. The ledger is written after the panel, so a lost run is repeated in full.
    """
    late = spark.read.schema(f"{schema}, batch bigint").parquet(late_path)
    done = spark.read.schema("batch bigint").json(f"{path}/ledger") if storage.exists(spark, f"{path}/ledger") else spark.createDataFrame([], "batch bigint")
    open_batches = late.select("batch").distinct().join(done, "batch", "left_anti").orderBy("batch")
    todo = [r.batch for r in open_batches.collect()]                             # one number for each micro-batch
    if todo:
        merge_observations(spark, path, late.filter(F.col("batch").isin(todo)), key, t, metrics)
        spark.createDataFrame([(b,) for b in todo], "batch bigint").coalesce(1).write.mode("append").json(f"{path}/ledger")
    return todo
