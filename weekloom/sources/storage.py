"""Small files and folders on whatever file system Spark reads."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none if it does not exist."""
    fs, p = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    return "\n".join(r.value for r in spark.read.option("wholetext", True).text(path).collect())


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file in one step: written aside and renamed, so it is there in full or not at all. False if it existed."""
    fs, p = _path(spark, path)
    fs.mkdirs(p.getParent())
    aside = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri() if aside.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    try:
        context.rename(aside, p, none)
    except Exception as error:
        if fs.exists(p):
            fs.delete(aside, False)
            return False
        raise error
    return True
