"""Helpers shared by the training-data operators.

Every operator selects the columns it needs under internal names, so extra columns
of the input, whatever they are called, never clash with its own.  Tables that are
read more than once are written to the cluster's shared folder and reread
(``stage``): a lost executor then costs a reread, not a recomputation.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweather.plans.tables import _delete_path
from geoweather.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str, once: bool = False) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return a frame over the files.

    With ``once``, ``df`` is not run again: its shuffle files are deleted as soon as it is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLES_GO, "false")
    if once:
        spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*staged: DataFrame) -> None:
    """Delete the files of frames made by ``stage``, which nothing reads any more."""
    for df in staged:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            _delete_path(df.sparkSession, folder)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """Return freed memory of this Python worker, which the next task reuses, to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(work: Callable[[Iterator], Iterator], after: Callable[[], None] | None = None) -> Callable[[Iterator], Iterator]:
    """``work`` over Arrow batches, with ``after`` and ``give_back`` run when its task ends."""

    def worked(batches):
        try:
            yield from work(batches)
        finally:
            if after is not None:
                after()
            give_back()

    return worked
