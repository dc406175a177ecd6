"""Small state tables kept as numbered versions.

A write makes a new folder and never touches the one before, so a reader sees the newest complete
version whatever happens to the writer; folders without the success marker of a
finished write are ignored and cleared by the next write.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

KEPT = 2
FOLDER = "version={:010d}"


def _folders(spark: SparkSession, path: str) -> dict[int, bool]:
    """Version number -> whether its write was finished (a listing of folders only)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return {}
    found = {}
    for s in fs.listStatus(p):
        if m := re.fullmatch(r"version=(\d+)", s.getPath().getName()):
            found[int(m[1])] = fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))
    return found


def newest_version(spark: SparkSession, path: str) -> int | None:
    return max((n for n, done in _folders(spark, path).items() if done), default=None)


def read_version(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete version, or None if there is none."""
    n = newest_version(spark, path)
    return None if n is None else spark.read.parquet(f"{path}/{FOLDER.format(n)}")


def write_version(df: DataFrame, path: str, kept: int = KEPT) -> int:
    """Write ``df`` as the next version and remove all but the ``kept`` newest complete ones."""
    spark = df.sparkSession
    n = max(_folders(spark, path), default=0) + 1
    df.write.parquet(f"{path}/{FOLDER.format(n)}")
    found = _folders(spark, path)
    live = sorted((k for k, done in found.items() if done), reverse=True)[:kept]
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for k in found:
        if k not in live and k < n:
            fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, FOLDER.format(k)), True)
    return n
