"""Nearest weather stations per ZIP code (spatial range join + top-K per group).

Plan
----
The semantics are: every (ZIP, station) pair whose coordinates differ by at most
``box_deg`` on each axis, whose haversine distance is at most ``max_miles``, ranked
by distance per ZIP, keeping ranks 1..k.

Instead of a nested-loop join, ZIPs meet stations in grid cells that follow the density of the
stations (``operators.gridsearch``), so the pairs grow with the ZIPs times k, not with ZIPs times
stations.  The exact predicates decide, and a ``row_number`` window keeps the top k; Spark plans
it with a partial group limit before the shuffle on ``zipcode``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoweather.functions.geo import EARTH_RADIUS_MILES, cell_index, haversine_miles
from geoweather.operators.gridsearch import Space, nearest_in_space

# Smallest base cell accepted; it is halved where stations are dense.
MIN_CELL_DEG = 0.25


def zipcode_points(zipcodes: DataFrame) -> DataFrame:
    """ZIP gazetteer table -> (zipcode, zipcode_latitude, zipcode_longitude)."""
    return zipcodes.select(
        F.col("GEOID").alias("zipcode"),
        F.col("INTPTLAT").alias("zipcode_latitude"),
        F.col("INTPTLONG").alias("zipcode_longitude"),
    )


def station_points(stations: DataFrame) -> DataFrame:
    """Station table -> (station_id, station_name, station_latitude, station_longitude), valid coordinates only."""
    return stations.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        F.col("id").alias("station_id"),
        F.col("name").alias("station_name"),
        F.col("latitude").alias("station_latitude"),
        F.col("longitude").alias("station_longitude"),
    )


def nearest_stations(
    zips: DataFrame,
    stations: DataFrame,
    k: int = 20,
    max_miles: float | None = 200.0,
    box_deg: float = 5.0,
    cell_deg: float = 2.0,
    pairs_per_task: int = 4_000_000,
    first_pass_miles: float | None = None,
) -> DataFrame:
    """Top-``k`` stations per ZIP within the box and distance limit.

    ``zips``: (zipcode, zipcode_latitude, zipcode_longitude);
    ``stations``: (station_id, station_name, station_latitude, station_longitude).
    Returns the ``zipcode_stations`` schema; ties in distance are broken by station_id.

    With ``first_pass_miles`` (r1 < max_miles) the search runs in two passes: all
    ZIPs against stations within r1 (small cells, few candidates), then only the
    ZIPs that found fewer than k stations against the full limits.  A ZIP with k
    stations within r1 is final: every station not seen is farther than r1, so
    none can displace them.  The result is identical to the one-pass search.
    """
    if first_pass_miles is None or max_miles is None or first_pass_miles >= max_miles:
        return _search(zips, stations, k, max_miles, box_deg, cell_deg, pairs_per_task)
    near = first_pass(zips, stations, k, first_pass_miles, box_deg, pairs_per_task=pairs_per_task)
    return second_pass(near, zips, stations, k, max_miles, box_deg, cell_deg, pairs_per_task)


def first_pass(
    zips: DataFrame, stations: DataFrame, k: int, miles: float, box_deg: float = 5.0, cell_deg: float | None = None,
    pairs_per_task: int = 4_000_000, max_miles: float | None = None,
) -> DataFrame:
    """Top-``k`` stations of each ZIP within ``miles`` (small cells); callers store it for ``second_pass``."""
    cell = max(MIN_CELL_DEG, math.degrees(miles / EARTH_RADIUS_MILES))
    return _search(zips, stations, k, miles, box_deg, cell, pairs_per_task)


def second_pass(
    near: DataFrame, zips: DataFrame, stations: DataFrame, k: int, max_miles: float | None = 200.0, box_deg: float = 5.0,
    cell_deg: float = 2.0, pairs_per_task: int = 4_000_000,
) -> DataFrame:
    """``near`` for ZIPs that have ``k`` stations in it, the full search for the others.

    ``near`` is read twice (its ZIP counts, its rows), so it should be a stored table.
    """
    full = near.groupBy(F.col("zipcode").alias("_full")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == F.lit(k)).select("_full")
    done = near.join(full, F.col("zipcode") == F.col("_full"), "left_semi")
    rest = zips.join(full, F.col("zipcode") == F.col("_full"), "left_anti")
    return done.unionByName(_search(rest, stations, k, max_miles, box_deg, cell_deg, pairs_per_task))


def suggest_first_pass_miles(
    zips: DataFrame, stations: DataFrame, k: int = 20, max_miles: float | None = 200.0
) -> float | None:
    """A first-pass radius expected to hold ~3k stations around a typical ZIP.

    Station density is measured where the ZIPs are: the ZIP-weighted mean number
    of stations in their 1-degree cells (two per-cell counts, each at most one
    row per cell, and one small join).  Returns None, meaning one pass, when that
    radius would not be well below ``max_miles`` (sparse stations).
    """
    if max_miles is None:
        return None
    zc = zips.where(F.col("zipcode_latitude").isNotNull() & F.col("zipcode_longitude").isNotNull()).groupBy(
        cell_index("zipcode_latitude", 1.0).alias("cy"), cell_index("zipcode_longitude", 1.0).alias("cx")
    ).agg(F.count(F.lit(1)).alias("nz"))
    sc = stations.groupBy(
        cell_index("station_latitude", 1.0).alias("cy"), cell_index("station_longitude", 1.0).alias("cx")
    ).agg(F.count(F.lit(1)).alias("ns"))
    row = zc.join(sc, ["cy", "cx"], "left").agg(
        (F.sum(F.col("nz") * F.coalesce(F.col("ns"), F.lit(0))) / F.sum("nz")).alias("per_cell"),
        (F.sum(F.col("nz") * (F.col("cy") + F.lit(0.5))) / F.sum("nz")).alias("lat"),
    ).first()
    if not row or not row["per_cell"]:
        return None
    miles_per_deg = math.radians(1.0) * EARTH_RADIUS_MILES
    cell_area = miles_per_deg * miles_per_deg * max(math.cos(math.radians(row["lat"])), 0.05)
    radius = math.sqrt(3 * k * cell_area / (math.pi * row["per_cell"]))
    return radius if radius < max_miles / 2 else None


def _search(
    zips: DataFrame,
    stations: DataFrame,
    k: int,
    max_miles: float | None,
    box_deg: float,
    cell_deg: float,
    pairs_per_task: int,
) -> DataFrame:
    """One search: exact top-k within the box and ``max_miles``."""
    if cell_deg < MIN_CELL_DEG:
        raise ValueError(f"cell_deg must be >= {MIN_CELL_DEG}")
    z = zips.where(F.col("zipcode_latitude").isNotNull() & F.col("zipcode_longitude").isNotNull())
    s = stations.where(F.col("station_latitude").isNotNull() & F.col("station_longitude").isNotNull())
    z = z.withColumns({"_p0": F.col("zipcode_latitude"), "_p1": F.col("zipcode_longitude")})
    s = s.withColumns({"_p0": F.col("station_latitude"), "_p1": F.col("station_longitude")})

    def distance(station: Column) -> Column:
        return haversine_miles("zipcode_latitude", "zipcode_longitude", station["station_latitude"], station["station_longitude"])

    def passes(station: Column, miles: Column) -> Column:
        box = F.lit(float(box_deg))
        inside = (F.abs(F.col("zipcode_latitude") - station["station_latitude"]) <= box) & (
            F.abs(F.col("zipcode_longitude") - station["station_longitude"]) <= box
        )
        return inside if max_miles is None else inside & (miles <= F.lit(float(max_miles)))

    return nearest_in_space(z, s, _degrees(max_miles, box_deg, cell_deg), k, passes, distance, pairs_per_task)


def _degrees(max_miles: float | None, box_deg: float, cell_deg: float) -> Space:
    """Cells of latitude and longitude, distances in miles."""
    half_turn = math.pi * EARTH_RADIUS_MILES
    limit = half_turn if max_miles is None else min(float(max_miles), half_turn)

    def away(low: Column, high: Column) -> Column:
        """Largest |latitude| between two, 90 at most."""
        return F.least(F.greatest(F.abs(low), F.abs(high)), F.lit(90.0))

    def bound(size: Column) -> Column:
        # Both gaps are at most two cells; the cosines are largest at the block's edge nearest the equator.
        low, high = (F.col("_c0") - 1) * size, (F.col("_c0") + 2) * size
        nearest = F.when((low <= 0) & (high >= 0), F.lit(0.0)).otherwise(F.least(F.abs(low), F.abs(high)))
        cos = F.cos(F.radians(nearest))
        hav = F.pow(F.sin(F.radians(size)), 2) * (F.lit(1.0) + cos * cos)
        return F.lit(2 * EARTH_RADIUS_MILES * (1 + 1e-9)) * F.asin(F.sqrt(F.least(hav, F.lit(1.0)))) + F.lit(1e-6)

    def settles(size: Column, miles: Column) -> Column:
        # No pair of a block may fail the box or the limit; past the poles the bound does not hold.
        low, high = (F.col("_c0") - 1) * size, (F.col("_c0") + 2) * size
        return (size * 2 <= F.lit(min(box_deg, 90.0) * (1 - 1e-9))) & (miles <= F.lit(limit)) & (low >= -90) & (high <= 90)

    def hav_of(miles: Column) -> Column:
        return F.pow(F.sin(miles / F.lit(2 * EARTH_RADIUS_MILES)), 2)

    def reach(miles: Column) -> list[Column]:
        box = F.lit(float(box_deg))
        lat = F.least(box, F.degrees(miles / F.lit(EARTH_RADIUS_MILES)) + F.lit(1e-6))
        cos = F.cos(F.radians(F.least(away(F.col("_lo0"), F.col("_hi0")) + lat, F.lit(90.0))))
        ratio = hav_of(miles) / F.greatest(cos * cos, F.lit(1e-12))
        lon = F.degrees(F.lit(2.0) * F.asin(F.sqrt(F.least(ratio, F.lit(1.0))))) + F.lit(1e-6)
        return [lat, F.when(ratio < 1, F.least(box, lon)).otherwise(box)]

    def within(miles: Column) -> Column:
        gaps = [F.greatest(F.lit(0.0), F.col(f"_lo{i}") - F.col(f"_p{i}"), F.col(f"_p{i}") - F.col(f"_hi{i}")) for i in (0, 1)]
        lat, lon = (F.pow(F.sin(F.radians(F.least(g, F.lit(180.0))) / 2), 2) for g in gaps)
        cos = F.cos(F.radians(away(F.col("_lo0"), F.col("_hi0")))) * F.cos(F.radians("_p0"))
        return lat + cos * lon <= hav_of(miles) * F.lit(1 + 1e-9) + F.lit(1e-12)

    return Space(2, float(cell_deg), bound, settles, F.lit(limit), reach, None, within)


def link_zipcodes_to_stations(zipcodes: DataFrame, stations: DataFrame, **kwargs) -> DataFrame:
    """``zipcode_stations`` from the gazetteer and station tables (see ``nearest_stations``)."""
    return nearest_stations(zipcode_points(zipcodes), station_points(stations), **kwargs)
