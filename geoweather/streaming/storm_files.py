"""Incremental storm-event ingest driven by new files in a landing folder.

Storm files carry a creation stamp in their name (``_cYYYYMMDD``), so each new
version of a year arrives as a new file name and the streaming file source sees
it exactly once.  (Yearly observation files are rewritten in place under the same
name, which a file stream would never pick up again; ``plans.jobs.refresh_observations`` compares listings instead.)

The stream carries file names only.  Each micro-batch reads its files with the batch job's reader, by header name and
with broken rows kept apart, so both give the same rows and the same issues.  The stamp loaded for each year is
kept in a small versioned table beside the target: of the batch's files, those whose stamp is the newest of
their year in the batch and not below the stored one replace their years, and the others are not
read.  The result therefore does not depend on arrival order or batch size.  The stamps are written
after the rows, as a new version: a batch that stops in between is run again and replaces the same partitions.
Run with ``trigger(availableNow=True)`` on a schedule, or continuously.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from geoweather.functions.files import base_name, storm_file_stamp, storm_file_year
from geoweather.operators.storms import typed_storms
from geoweather.plans import tables, versions
from geoweather.plans.storm_refresh import refresh_storms
from geoweather.sources.listing import STORM_GLOB, looks_damaged, readable_paths
from geoweather.sources.storms import read_storm_files

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def storm_file_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming (path, file_year, stamp) of the storm files that arrive; contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", STORM_GLOB)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    name = base_name("path")
    return reader.load(landing_dir).select("path", storm_file_year(name).alias("file_year"), storm_file_stamp(name).alias("stamp"))


def stored_stamps(spark: SparkSession, path: str) -> dict[int, int]:
    """Year -> stamp of the version loaded (one row a year)."""
    table = versions.read_version(spark, path)
    return {r.file_year: r.stamp for r in table.collect()} if table is not None else {}


def accepted_files(files, loaded: dict[int, int]) -> tuple[list[str], dict[int, int]]:
    """Paths to read and the stamp each year gets, of (path, file_year, stamp) rows.

    Files without a year in their name are always read.
    """
    newest: dict[int, int] = {}
    for f in files:
        if f.file_year is not None:
            newest[f.file_year] = max(newest.get(f.file_year, 0), f.stamp or 0)
    accepted = {y: s for y, s in newest.items() if s >= loaded.get(y, 0)}
    paths = [f.path for f in files if f.file_year is None or accepted.get(f.file_year) == (f.stamp or 0)]
    return sorted(paths), accepted


def _apply_batch(target: str, issues_target: str | None, stamps: str):
    def apply(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        files = batch.collect()  # one row for each file of the batch
        loaded = stored_stamps(spark, stamps)
        paths, accepted = accepted_files(files, loaded)
        if not paths:
            return
        years = {f.path: f.file_year for f in files}

        def load(paths, failed):
            rows = typed_storms(read_storm_files(spark, paths), splits=len(paths))
            with tables.stage(spark, rows, f"storm-batch-{epoch_id}") as typed:
                good = {years[p] for p in paths} - {years[p] for p in failed} - {None}
                bad = [(os.path.basename(p), years[p]) for p in failed]
                refresh_storms(spark, typed, target, good, issues_target, bad)
            return good

        try:
            good = load(paths, [])
        except Exception as err:
            if not looks_damaged(err):
                raise
            paths, failed = readable_paths(spark, paths)
            if not failed:
                raise
            good = load(paths, failed)
        if kept := {y: s for y, s in accepted.items() if y in good}:
            rows = sorted((loaded | kept).items())
            versions.write_version(spark.createDataFrame(rows, "file_year int, stamp int").coalesce(1), stamps)

    return apply


def start_storm_ingest(
    spark: SparkSession,
    landing_dir: str,
    target: str,
    checkpoint_location: str,
    issues_target: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    versions_target: str | None = None,
) -> StreamingQuery:
    """Start the incremental ingest; with ``available_now`` it stops after the files present now."""
    stream = storm_file_stream(spark, landing_dir, max_files_per_trigger)
    stamps = versions_target or f"{target.rstrip('/')}_versions"
    writer = stream.writeStream.foreachBatch(_apply_batch(target, issues_target, stamps)).option(
        "checkpointLocation", checkpoint_location
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
