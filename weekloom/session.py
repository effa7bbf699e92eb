"""Session settings the library relies on, and lineage cutting that survives lost executors."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster pass your own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("weekloom")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")   # call sites per column
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df``.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a local master
    (tests) may run without it and then gets a temporary folder.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
    elif sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="weekloom-ckpt-"))
    return df.checkpoint()
