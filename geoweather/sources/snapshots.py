"""Listing snapshots: which files of a folder are new, rewritten in place or gone since the last load.

Yearly observation files keep their names when they are rewritten, so names alone never show a
correction of an old year.  A snapshot holds path, length and modification time of every file that was
loaded; the next run lists again and compares.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweather.functions.files import base_name
from geoweather.operators.compare import CHANGED, NEW, compare_tables

SNAPSHOT_SCHEMA = "path string, name string, length bigint, modified timestamp"


def listing_snapshot(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path, name, length, modified) of every file under ``folder`` matching ``pattern``; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", base_name("path").alias("name"), "length", F.col("modificationTime").alias("modified"))


def listing_changes(before: DataFrame | None, after: DataFrame) -> DataFrame:
    """path, name, both lengths and modification times, change (new, removed, changed, same) and ``reload``.

    Without an earlier snapshot every file is new.  A file counts as changed if its length or its modification time
    differs, in either direction: an older copy put back is a change too.
    """
    if before is None:
        before = after.limit(0)
    found = compare_tables(before, after, ["path"], ["name", "length", "modified"])
    return found.select(
        "path",
        F.coalesce("after_name", "before_name").alias("name"),
        "before_length",
        "after_length",
        "before_modified",
        "after_modified",
        "change",
        F.col("change").isin(NEW, CHANGED).alias("reload"),
    )


def next_snapshot(before: DataFrame | None, after: DataFrame, failed) -> DataFrame:
    """What to remember after a load: the listing, but damaged files as they were known before, or not at all."""
    good = after.where(~F.col("path").isin(list(failed))) if failed else after
    if before is None or not failed:
        return good
    return good.unionByName(before.where(F.col("path").isin(list(failed))).select(*after.columns))
