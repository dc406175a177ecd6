"""Listing source folders and choosing which yearly files to (re)load.

Listing uses the ``binaryFile`` source with only path/size columns selected, so
file contents are never read and the listing itself is distributed.
"""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweather.functions.files import base_name, storm_file_stamp, storm_file_year, yearly_file_year

# Source file name patterns.
OBSERVATION_GLOB = "*.csv.gz"
STORM_GLOB = "StormEvents_details*.csv.gz"
CHECK_BYTES = 1 << 20
# What Spark reports for a damaged compressed file.
DAMAGE_SIGNS = ("FAILED_READ_FILE", "ZipException", "EOFException", "not a gzip file", "Unexpected end of", "CORRUPT")


def list_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path, name, length) of every file under ``folder`` matching ``pattern``, sorted by name."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", base_name("path").alias("name"), "length").orderBy("name")


def input_splits(spark: SparkSession, path: str) -> int:
    """About how many splits a scan of the files at ``path`` has (their bytes over the split size; no file is read)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    length = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return -(-length // size)


def annotate_observation_files(listing: DataFrame, since_year=None, watermark_year=None) -> DataFrame:
    """Adds ``file_year`` and ``selected``: year >= since_year and year >= watermark_year."""
    y = yearly_file_year(F.col("name"))
    keep = F.lit(True)
    for bound in (since_year, watermark_year):
        if bound is not None:
            keep = keep & y.isNotNull() & (y >= F.lit(int(bound)))
    return listing.select("*", y.alias("file_year"), keep.alias("selected"))


def annotate_storm_files(listing: DataFrame, since_year=None, watermark_year=None, latest_stamp_only: bool = True) -> DataFrame:
    """Adds ``file_year``, ``stamp`` and ``selected``.

    A file passes when its year is >= since_year and >= watermark_year; a name
    without a year passes only when no bound is given.  With
    ``latest_stamp_only`` only the newest creation stamp of each year is kept, so
    two versions of one year are never both loaded.
    """
    y, stamp = storm_file_year(F.col("name")), storm_file_stamp(F.col("name"))
    keep = F.lit(True)
    for bound in (since_year, watermark_year):
        if bound is not None:
            keep = keep & y.isNotNull() & (y >= F.lit(int(bound)))
    out = listing.select("*", y.alias("file_year"), stamp.alias("stamp"), keep.alias("passes"))
    if latest_stamp_only:
        # One row per year, joined back: a year's files never meet in one task.
        newest = out.groupBy(F.col("file_year").alias("_year")).agg(
            F.max(F.struct(F.coalesce("stamp", F.lit(-1)).alias("stamp"), "name"))["name"].alias("_newest")
        )
        out = out.join(newest, F.col("file_year") == F.col("_year"), "left")
        first = F.col("name") == F.col("_newest")
        out = out.withColumn("selected", F.col("passes") & (F.col("file_year").isNull() | first)).drop("_year", "_newest")
    else:
        out = out.withColumn("selected", F.col("passes"))
    return out.drop("passes")


def looks_damaged(err: Exception) -> bool:
    """Whether a failed read may come from a damaged file, and not from a full disk or a bug."""
    return any(sign in str(err) for sign in DAMAGE_SIGNS)


def plain_path(path: str) -> str:
    """A local path without its scheme, however many slashes that has."""
    return re.sub("^file:/+", "/", path)


def _check_gzip(batches):
    """(path, damaged) of (path, content) rows: each .gz is decompressed to its end in pieces, its checksum included."""
    for batch in batches:
        damaged = []
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            bad = False
            if path.endswith(".gz"):
                rest = memoryview(content.as_buffer())
                bad = not len(rest)
                try:
                    while len(rest) and not bad:  # one member after the other
                        member, at = zlib.decompressobj(31), 0
                        while at < len(rest) and not member.eof:
                            piece = rest[at : at + CHECK_BYTES]
                            at += len(piece)
                            member.decompress(piece, 0)
                        bad = not member.eof
                        rest = rest[at - len(member.unused_data) :]
                except zlib.error:
                    bad = True
            damaged.append(bad)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(damaged, pa.bool_())], names=["path", "damaged"])


def readable_paths(spark: SparkSession, paths) -> tuple[list[str], list[str]]:
    """(readable, unreadable) files, found in one job.  For use after a read of all of them has failed.

    A file is one record here, compressed, so a task holds one file (or several small ones of a split) at a time.
    """
    paths = list(paths)
    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    found = files.mapInArrow(_check_gzip, "path string, damaged boolean").where("damaged").collect()  # one row a damaged file
    bad = {plain_path(r.path) for r in found}
    return [p for p in paths if plain_path(p) not in bad], [p for p in paths if plain_path(p) in bad]


def first_lines(spark: SparkSession, paths) -> DataFrame:
    """(path, line, lines): first line and number of lines of each file that has a line, in one job.

    A damaged file counts as far as it can be read; a strict read of it fails later.
    """
    lines = spark.read.option("ignoreCorruptFiles", "true").text(list(paths))
    at = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    rows = lines.select(F.col("_metadata.file_path").alias("path"), at.alias("at"), "value")
    return rows.groupBy("path").agg(F.min_by("value", "at").alias("line"), F.count(F.lit(1)).alias("lines"))


def selected_paths(annotated: DataFrame) -> list[str]:
    """Paths to read (a file list: bounded by the number of source files, not by data)."""
    return [r.path for r in annotated.where("selected").select("path").orderBy("path").collect()]


def list_observation_files(spark: SparkSession, folder: str, since_year=None, watermark_year=None) -> DataFrame:
    return annotate_observation_files(list_files(spark, folder, OBSERVATION_GLOB), since_year, watermark_year)


def list_storm_files(spark: SparkSession, folder: str, since_year=None, watermark_year=None, latest_stamp_only=True) -> DataFrame:
    return annotate_storm_files(list_files(spark, folder, STORM_GLOB), since_year, watermark_year, latest_stamp_only)
