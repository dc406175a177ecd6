"""Refreshing ``zipcode_stations`` after some stations or ZIPs have changed.

A ZIP's links are the k nearest stations, so they change in two ways only:

* a station is gone or has moved (or was renamed): the ZIPs that link to it may let another station
  in, so they are searched again.  ZIPs that are new or have moved are searched too.
* a station is new (or moved there): it can only enter the links of ZIPs that are nearer to it than to
  their k-th station.  This reverse search runs over the new stations alone, each ZIP bounded by the
  distance of its k-th link, and the k nearest of old links and finds are the new links.

All other links stay as they are.  The result equals a full rebuild.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoweather.operators.compare import CHANGED, NEW, REMOVED, SAME, compare_tables
from geoweather.operators.nearest import _search

STATION_VALUES = ("station_name", "station_latitude", "station_longitude")
ZIP_VALUES = ("zipcode_latitude", "zipcode_longitude")


def changed_keys(before: DataFrame, after: DataFrame, key: str, values) -> DataFrame:
    """(key, change) of the rows that are new, removed or changed."""
    return compare_tables(before, after, [key], values).where(F.col("change") != SAME).select(key, "change")


def refresh_links(
    links: DataFrame,
    zips: tuple[DataFrame, DataFrame],
    stations: tuple[DataFrame, DataFrame],
    k: int = 20,
    max_miles: float | None = 200.0,
    box_deg: float = 5.0,
    cell_deg: float = 2.0,
    pairs_per_task: int = 4_000_000,
) -> DataFrame:
    """``zipcode_stations`` for the second of each pair of points, given the links of the first.

    ``zips`` and ``stations`` are (before, after) frames as ``operators.nearest`` takes them; ``links`` is a stored
    table, read a few times.  Parameters must be those the links were made with.
    """
    zips_after, stations_after = zips[1], stations[1]
    z = changed_keys(*zips, "zipcode", ZIP_VALUES)
    s = changed_keys(*stations, "station_id", STATION_VALUES)
    away = s.where(F.col("change").isin(REMOVED, CHANGED)).select(F.col("station_id").alias("_away"))
    came = s.where(F.col("change").isin(NEW, CHANGED)).select(F.col("station_id").alias("_came"))
    # ZIPs to search in full: those that link to a station that is away, and changed ZIPs.
    lost = links.join(away, F.col("station_id") == F.col("_away"), "left_semi").select(F.col("zipcode").alias("_zip"))
    again = lost.unionByName(z.select(F.col("zipcode").alias("_zip"))).distinct()
    searched = zips_after.join(again, F.col("zipcode") == F.col("_zip"), "left_semi")
    full = _search(searched, stations_after, k, max_miles, box_deg, cell_deg, pairs_per_task)
    kept = links.join(again, F.col("zipcode") == F.col("_zip"), "left_anti")
    # The others: only new stations nearer than the k-th link can enter.
    bound = kept.groupBy(F.col("zipcode").alias("_zip")).agg(
        F.when(F.count(F.lit(1)) == k, F.max("distance_miles")).alias("_kth")
    )
    rest = zips_after.join(again, F.col("zipcode") == F.col("_zip"), "left_anti")
    new_stations = stations_after.join(came, F.col("station_id") == F.col("_came"), "left_semi")
    near = _search(rest, new_stations, k, max_miles, box_deg, cell_deg, pairs_per_task)
    near = near.join(bound, F.col("zipcode") == F.col("_zip"), "left").where("_kth IS NULL OR distance_miles <= _kth").drop("_zip", "_kth")
    columns = [c for c in links.columns if c != "rank"]
    touched = near.select(F.col("zipcode").alias("_touched")).distinct()
    old = kept.join(touched, F.col("zipcode") == F.col("_touched"), "left_semi").select(*columns)
    by_zip = Window.partitionBy("zipcode").orderBy("distance_miles", "station_id")
    merged = old.unionByName(near.select(*columns)).withColumn("rank", F.row_number().over(by_zip).cast("int"))
    untouched = kept.join(touched, F.col("zipcode") == F.col("_touched"), "left_anti")
    out = untouched.unionByName(merged.where(F.col("rank") <= k).select(*links.columns))
    return out.unionByName(full.select(*links.columns))
