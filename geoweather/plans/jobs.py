"""Batch job entry points (``spark-submit -m``-style: ``python -m geoweather.plans.jobs <job> ...``).

Each job reads its inputs by path, runs one distributed plan, writes its table and
returns audit counts gathered with ``Observation`` while writing.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from geoweather.operators.coverage import coverage
from geoweather.operators.link_refresh import refresh_links
from geoweather.operators.metrics import MAX_BROADCAST_LINKS, daily_metrics, in_date_range, near_links
from geoweather.operators.moments import merge_moments, metrics_from_moments, station_day_moments
from geoweather.operators.nearest import (
    first_pass,
    link_zipcodes_to_stations,
    second_pass,
    station_points,
    suggest_first_pass_miles,
    zipcode_points,
)
from geoweather.operators.preview import filter_rows, preview
from geoweather.operators.stations import pick_by_source_priority
from geoweather.operators.storms import typed_storms
from geoweather.plans import tables, versions
from geoweather.plans.export import export_parquet
from geoweather.plans.footers import from_footers
from geoweather.plans.storm_refresh import NO_YEAR, refresh_storms
from geoweather.schemas import OBSERVATIONS, STATIONS, STORM_EVENTS, ZIPCODES, conform
from geoweather.session import get_session
from geoweather.sources.gazetteer import read_zipcodes
from geoweather.sources.ghcn_files import parse_dly_lines, read_inventory
from geoweather.sources.listing import (
    OBSERVATION_GLOB,
    annotate_observation_files,
    list_observation_files,
    list_storm_files,
    looks_damaged,
    readable_paths,
    selected_paths,
)
from geoweather.sources.observations import read_observations, read_typed_observations
from geoweather.sources.snapshots import listing_changes, listing_snapshot, next_snapshot
from geoweather.sources.stations import read_stations
from geoweather.sources.storms import read_storm_files
from geoweather.streaming.storm_files import start_storm_ingest


def _write_full(df: DataFrame, target: str) -> int:
    """Full reload (drop + create + load) with the row count observed during the write."""
    obs = Observation("full_reload")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(target)
    return tables.observed(obs, "rows")


def load_stations(spark: SparkSession, source: str, target: str) -> dict:
    return {"rows": _write_full(conform(read_stations(spark, source), STATIONS), target)}


def load_zipcodes(spark: SparkSession, source: str, target: str) -> dict:
    return {"rows": _write_full(conform(read_zipcodes(spark, source), ZIPCODES), target)}


def _file_years(listing: DataFrame, paths) -> dict[str, int | None]:
    """Path -> year in the file's name (bounded by the number of source files)."""
    rows = listing.select("path", "file_year").collect()
    return {r.path: r.file_year for r in rows if r.path in set(paths)}


@contextmanager
def _staged_readable(spark: SparkSession, paths, make, name: str):
    """``make(paths)`` staged, and the files left out because they are damaged.

    Damaged files are looked for only after the read of all files has failed with a sign of one.
    """
    failed: list[str] = []
    with ExitStack() as stack:
        try:
            staged = stack.enter_context(tables.stage(spark, make(paths), name))
        except Exception as err:
            if not looks_damaged(err):
                raise
            paths, failed = readable_paths(spark, paths)
            if not failed:
                raise
            staged = stack.enter_context(tables.stage(spark, make(paths), name)) if paths else None
        yield staged, failed


def ingest_observations(
    spark: SparkSession, source_folder: str, target: str, since_year: int | None = None, rejects_target: str | None = None
) -> dict:
    """Refresh yearly observation files: the newest loaded year and every later one.

    The watermark is the newest ``year`` partition already loaded; files of that
    year and later (and >= ``since_year``) are read, and exactly their years are
    replaced in one dynamic overwrite, so a failed run never leaves a year deleted.  Bad rows
    and rows of another year than their file's go to ``rejects_target``; a damaged file leaves its year as it is.
    """
    watermark = tables.newest_partition(spark, target, "year")
    watermark = min([watermark, *tables.pending_years(spark, target)]) if watermark is not None else None
    listing = list_observation_files(spark, source_folder, since_year, watermark)
    paths = selected_paths(listing)
    if not paths:
        return {"watermark_year": watermark, "files": 0, "rows_loaded": 0}
    counts, failed = _load_observation_years(spark, paths, _file_years(listing, paths), target, rejects_target)
    return {"watermark_year": watermark, "files": len(paths) - len(failed), "files_failed": [os.path.basename(p) for p in failed], **counts}


def _load_observation_years(spark: SparkSession, paths, years, target: str, rejects_target: str | None) -> tuple[dict, list[str]]:
    """Replace the years of readable files; (counts, damaged files)."""
    with _staged_readable(spark, paths, lambda p: read_typed_observations(spark, p), "obs-typed") as (typed, failed):
        counts = {"rows_loaded": 0}
        loaded = {y for p, y in years.items() if p not in failed and y is not None}
        if typed is not None:
            fits = F.col("file_year").isNotNull() & (F.col("year") == F.col("file_year"))
            good = F.coalesce(~F.col("bad") & fits, F.lit(False))
            rows = typed.where(good).select(*OBSERVATIONS.fieldNames(), "year")
            counts = tables.replace_years(spark, rows, target, "year", loaded, sort_within=("date", "id"))
            if rejects_target:
                rejects = typed.where(~good).drop("bad").withColumn("file_year", F.coalesce("file_year", F.lit(NO_YEAR)))
                rejected = tables.replace_years(spark, rejects, rejects_target, "file_year", {*loaded, NO_YEAR})
                counts["rows_rejected"] = rejected["rows_loaded"]
    return counts, failed


def refresh_observations(
    spark: SparkSession, source_folder: str, target: str, snapshot: str, since_year: int | None = None, rejects_target: str | None = None
) -> dict:
    """Reload exactly the years whose files are new or rewritten since the last run, however old they are.

    ``snapshot`` keeps the listing of what was loaded, as versions.  The new listing is taken before any file is
    read and stored after the load: a run that stops in between, or a file rewritten meanwhile, is
    loaded again next time.  A damaged file leaves its year as it is and is tried again; a file that is gone is
    reported and its rows stay.
    """
    before = versions.read_version(spark, snapshot)
    with tables.stage(spark, listing_snapshot(spark, source_folder, OBSERVATION_GLOB), "listing") as now:
        changes = annotate_observation_files(listing_changes(before, now), since_year)
        # One row for each source file that changed.
        found = changes.where("selected AND change <> 'same'").select("path", "file_year", "change", "reload").collect()
        years = {r.path: r.file_year for r in found if r.reload and r.file_year is not None}
        counts, failed = {"rows_loaded": 0}, []
        # Years of a refresh that stopped half-way are loaded again, whatever the listing says.
        pending = set(tables.pending_years(spark, target))
        again = annotate_observation_files(now, since_year).where("selected").select("path", "file_year").collect() if pending else []
        years |= {r.path: r.file_year for r in again if r.file_year in pending}
        if years:
            counts, failed = _load_observation_years(spark, sorted(years), years, target, rejects_target)
        versions.write_version(next_snapshot(before, now, failed), snapshot)
    gone = sorted(os.path.basename(r.path) for r in found if r.change == "removed")
    failed_names = [os.path.basename(p) for p in failed]
    return {"files": len(years) - len(failed), "years": sorted({y for p, y in years.items() if p not in failed}), "files_failed": failed_names, "files_gone": gone, **counts}


def ingest_storms(
    spark: SparkSession, source_folder: str, target: str, since_year: int | None = None, issues_target: str | None = None
) -> dict:
    """Refresh storm-event years from the newest loaded BEGIN_YEARMONTH on.

    The raw files (gzip, one task each) are typed once and staged under the shared
    folder; loadable rows then replace the years of the selected files and problem rows
    (damaged files among them) go to ``issues_target``.
    """
    watermark = None
    newest_year = tables.newest_partition(spark, target, "YEAR")
    if newest_year is not None:
        # the year-month high-water mark comes from the footers of the newest YEAR partition
        newest = from_footers(spark, target, [F.max("BEGIN_YEARMONTH").alias("ym")], F.col("YEAR") == newest_year).first().ym
        watermark = newest // 100 if newest is not None else None
        watermark = min([watermark, *tables.pending_years(spark, target)]) if watermark is not None else None
    listing = list_storm_files(spark, source_folder, since_year, watermark)
    paths = selected_paths(listing)
    if not paths:
        return {"watermark_year": watermark, "files": 0, "rows_loaded": 0}
    years = _file_years(listing, paths)

    def typed_rows(files):
        return typed_storms(read_storm_files(spark, files), splits=len(files))

    with _staged_readable(spark, paths, typed_rows, "storm-typed") as (typed, failed):
        bad = [(os.path.basename(p), years[p]) for p in failed]
        if typed is None:
            typed = spark.createDataFrame([], typed_rows([]).schema)
        loaded = {y for p, y in years.items() if p not in failed and y is not None}
        counts = refresh_storms(spark, typed, target, loaded, issues_target, bad)
    return {"watermark_year": watermark, "files": len(paths) - len(failed), "files_failed": [n for n, _ in bad], **counts}


def append_observations(spark: SparkSession, source_folder: str, target: str) -> dict:
    """Append every observation file's good rows without replacing anything."""
    paths = selected_paths(list_observation_files(spark, source_folder))
    rows = read_observations(spark, paths) if paths else None
    return {"files": len(paths), "rows": tables.append_rows(rows, target, OBSERVATIONS, ("year",)) if paths else 0}


def load_dly(spark: SparkSession, source: str, target: str, pick: bool = False) -> dict:
    """Monthly fixed-width station files; with ``pick`` one reading per station, day and element by source priority."""
    rows = parse_dly_lines(spark.read.text(source))
    rows = pick_by_source_priority(rows) if pick else rows
    return {"rows": _write_full(rows, target)}


def load_inventory(spark: SparkSession, source: str, target: str) -> dict:
    return {"rows": _write_full(read_inventory(spark, source), target)}


def read_storm_table(spark: SparkSession, path: str) -> DataFrame:
    """The storm table with its fixed types (partition discovery types YEAR as int)."""
    return conform(tables.require_table(spark, path, "storm events"), STORM_EVENTS)


def link_stations(
    spark: SparkSession, zipcodes_path: str, stations_path: str, target: str, k: int = 20, **kwargs
) -> dict:
    """Full reload of ``zipcode_stations``; returns the row count and a 5-row sample.

    Dense stations are searched in two passes; the first is staged, so it runs once.
    """
    zips = tables.require_table(spark, zipcodes_path, "zipcodes")
    stns = tables.require_table(spark, stations_path, "stations")
    max_miles = kwargs.get("max_miles", 200.0)
    first_miles = kwargs.pop("first_pass_miles", None) or suggest_first_pass_miles(zipcode_points(zips), station_points(stns), k, max_miles)
    if first_miles is None or first_miles >= max_miles:
        rows = _write_full(link_zipcodes_to_stations(zips, stns, k=k, **kwargs), target)
    else:
        near = first_pass(zipcode_points(zips), station_points(stns), k=k, miles=first_miles, **kwargs)
        with tables.stage(spark, near, "links-first") as near:
            rows = _write_full(second_pass(near, zipcode_points(zips), station_points(stns), k=k, **kwargs), target)
    sample = [r.asDict() for r in preview(spark.read.parquet(target), ["zipcode", "rank"], 5).collect()]
    return {"rows": rows, "sample": sample}


def compute_daily_metrics(
    spark: SparkSession,
    observations_path: str,
    links_path: str,
    target: str,
    min_date=None,
    max_date=None,
    max_miles: float = 20.0,
    moments_path: str | None = None,
) -> dict:
    """Recompute [min_date, max_date] of ``zipcode_daily_metrics`` and report coverage.

    With ``moments_path`` the rows come from that table of station-day moments and the observations are not read.
    """
    links = tables.require_table(spark, links_path, "zipcode_stations")
    max_date = dt.date.fromisoformat(str(max_date)) if max_date else dt.date.today()
    min_date = dt.date.fromisoformat(str(min_date)) if min_date else tables.resume_from(spark, target)
    near = near_links(links, max_miles)
    few = near.count() <= MAX_BROADCAST_LINKS  # the stored links: a count reads statistics and one column
    if moments_path:
        moments = tables.require_table(spark, moments_path, "station-day moments")
        rows = metrics_from_moments(moments, F.broadcast(near) if few else near, min_date, max_date, max_miles)
    else:
        obs = tables.require_table(spark, observations_path, "observations")
        rows = daily_metrics(obs, links, min_date, max_date, max_miles=max_miles, broadcast_links=few)
    counts = tables.replace_date_range(spark, rows, target, min_date, max_date)
    cov = [r.asDict() for r in coverage(spark.read.parquet(target)).collect()]
    return {"min_date": str(min_date), "max_date": str(max_date), **counts, "coverage": cov}


def _by_month(moments: DataFrame) -> DataFrame:
    return moments.select("*", F.year("date").alias("year"), F.month("date").alias("month"))


def refresh_moments(spark: SparkSession, observations_path: str, target: str, min_date, max_date) -> dict:
    """Recompute the station-day moments of [min_date, max_date] from the observations."""
    obs = in_date_range(tables.require_table(spark, observations_path, "observations"), min_date, max_date)
    return tables.replace_date_range(spark, _by_month(station_day_moments(obs)), target, min_date, max_date)


def backfill_moments(spark: SparkSession, late_rows: DataFrame, target: str) -> dict:
    """Add late observations to the stored moments; only the months they touch are read and rewritten.

    Adding is not idempotent: each batch of late rows may be passed once.
    """
    columns = ["id", "date", "element", "readings", "valued", "total", "squares", "year", "month"]
    fresh = _by_month(station_day_moments(late_rows.where("date IS NOT NULL"))).select(*columns)
    with tables.stage(spark, fresh, "moments-late") as late:
        # At most one row a month of the batch.
        months = [(r.year, r.month) for r in late.select("year", "month").distinct().collect()]
        stored = tables.read_table(spark, target)
        parts = [late]
        if stored is not None and months:
            touched = (F.col("year") * 12 + F.col("month")).isin([y * 12 + m for y, m in months])
            parts.append(stored.where(touched).select(*columns))
        with tables.stage(spark, _by_month(merge_moments(*parts)), "moments-merged") as merged:
            if months:
                tables.overwrite_partitions(merged, target, ["year", "month"])
    return {"months": len(months)}


def relink_stations(spark: SparkSession, links_path: str, zips: tuple[str, str], stations: tuple[str, str], k: int = 20, **kwargs) -> dict:
    """Refresh the stored links after stations or ZIPs have changed; (before, after) paths of both tables."""
    links = tables.require_table(spark, links_path, "zipcode_stations")
    z = tuple(zipcode_points(tables.require_table(spark, p, "zipcodes")) for p in zips)
    s = tuple(station_points(tables.require_table(spark, p, "stations")) for p in stations)
    with tables.stage(spark, refresh_links(links, z, s, k=k, **kwargs), "links-refreshed") as fresh:
        return {"rows": _write_full(fresh, links_path)}


def export_table(spark: SparkSession, source: str, dest: str, partition_by=("year", "month"), where=None) -> dict:
    df = tables.require_table(spark, source, "export source")
    rows = filter_rows(df, where)
    if not partition_by:
        export_parquet(rows, dest, partition_by=())
        return {"partitions": 0, "dest": dest}
    obs = Observation("export")  # the partition keys are gathered while writing
    export_parquet(rows.observe(obs, F.collect_set(F.struct(*partition_by)).alias("keys")), dest, partition_by=partition_by)
    return {"partitions": len(tables.metrics(obs).get("keys") or []), "dest": dest}


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="geoweather.plans.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("load-stations"); a.add_argument("source"); a.add_argument("target")
    a = sub.add_parser("load-zipcodes"); a.add_argument("source"); a.add_argument("target")
    a = sub.add_parser("ingest-observations"); a.add_argument("source"); a.add_argument("target")
    a.add_argument("--since-year", type=int); a.add_argument("--rejects")
    a = sub.add_parser("refresh-observations"); a.add_argument("source"); a.add_argument("target"); a.add_argument("snapshot")
    a.add_argument("--since-year", type=int); a.add_argument("--rejects")
    a = sub.add_parser("station-moments"); a.add_argument("observations"); a.add_argument("target")
    a.add_argument("--min-date", required=True); a.add_argument("--max-date", required=True)
    a = sub.add_parser("relink-stations"); a.add_argument("links"); a.add_argument("--num-stations", type=int, default=20)
    for kind in ("zipcodes", "stations"):
        a.add_argument(f"--{kind}", nargs=2, required=True, metavar=("BEFORE", "AFTER"))
    a = sub.add_parser("append-observations"); a.add_argument("source"); a.add_argument("target")
    a = sub.add_parser("load-dly"); a.add_argument("source"); a.add_argument("target"); a.add_argument("--pick", action="store_true")
    a = sub.add_parser("load-inventory"); a.add_argument("source"); a.add_argument("target")
    a = sub.add_parser("stream-storms"); a.add_argument("source"); a.add_argument("target")
    a.add_argument("--checkpoint", required=True); a.add_argument("--issues")
    a = sub.add_parser("ingest-storms"); a.add_argument("source"); a.add_argument("target")
    a.add_argument("--since-year", type=int); a.add_argument("--issues")
    a = sub.add_parser("link-stations"); a.add_argument("zipcodes"); a.add_argument("stations"); a.add_argument("target")
    a.add_argument("--num-stations", type=int, default=20)
    a = sub.add_parser("daily-metrics"); a.add_argument("observations"); a.add_argument("links"); a.add_argument("target")
    a.add_argument("--min-date"); a.add_argument("--max-date"); a.add_argument("--max-distance-miles", type=float, default=20.0)
    a.add_argument("--moments")
    a = sub.add_parser("export"); a.add_argument("source"); a.add_argument("dest")
    a.add_argument("--partition-col", default="year, month"); a.add_argument("--where")
    args = p.parse_args(argv)

    spark = get_session()
    if args.job == "load-stations":
        out = load_stations(spark, args.source, args.target)
    elif args.job == "load-zipcodes":
        out = load_zipcodes(spark, args.source, args.target)
    elif args.job == "ingest-observations":
        out = ingest_observations(spark, args.source, args.target, args.since_year, args.rejects)
    elif args.job == "refresh-observations":
        out = refresh_observations(spark, args.source, args.target, args.snapshot, args.since_year, args.rejects)
    elif args.job == "station-moments":
        out = refresh_moments(spark, args.observations, args.target, args.min_date, args.max_date)
    elif args.job == "relink-stations":
        out = relink_stations(spark, args.links, tuple(args.zipcodes), tuple(args.stations), k=args.num_stations)
    elif args.job == "append-observations":
        out = append_observations(spark, args.source, args.target)
    elif args.job == "load-dly":
        out = load_dly(spark, args.source, args.target, args.pick)
    elif args.job == "load-inventory":
        out = load_inventory(spark, args.source, args.target)
    elif args.job == "stream-storms":
        start_storm_ingest(spark, args.source, args.target, args.checkpoint, args.issues).awaitTermination()
        out = {"target": args.target}
    elif args.job == "ingest-storms":
        out = ingest_storms(spark, args.source, args.target, args.since_year, args.issues)
    elif args.job == "link-stations":
        out = link_stations(spark, args.zipcodes, args.stations, args.target, k=args.num_stations)
    elif args.job == "daily-metrics":
        out = compute_daily_metrics(spark, args.observations, args.links, args.target, args.min_date, args.max_date,
                                    args.max_distance_miles, args.moments)
    else:
        cols = tuple(c.strip() for c in args.partition_col.split(",") if c.strip())
        out = export_table(spark, args.source, args.dest, cols, args.where)
    print(json.dumps(out, default=str))


if __name__ == "__main__":
    main()
