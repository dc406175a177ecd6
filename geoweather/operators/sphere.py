"""Nearest stations anywhere on Earth, without a degree box.

Latitude and longitude become unit vectors; two points are within a great-circle distance d exactly if
their chord is at most 2 sin(d / 2R).  The grid is cubic cells of space, as fine as the stations are dense
(``operators.gridsearch``), in base cells of twice that chord.  Nothing is special about the poles
or the 180th meridian; the exact haversine distance decides.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoweather.functions.geo import EARTH_RADIUS_MILES, haversine_miles
from geoweather.operators.gridsearch import Space, nearest_in_space

# Base cells are at least this wide (radii).
MIN_CELL = 0.005
# Absorbs rounding of vectors and distances; the exact distance is checked after the join.
MARGIN = 1e-9


def unit_vector(lat, lon) -> list[Column]:
    """x, y, z of a point given in degrees."""
    phi, lam = F.radians(lat), F.radians(lon)
    return [F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)]


def chord_of(miles: float) -> float:
    """Chord, in radii, of a great-circle distance (at most half the circumference)."""
    return 2 * math.sin(min(miles / EARTH_RADIUS_MILES, math.pi) / 2)


def nearest_stations_on_sphere(
    zips: DataFrame, stations: DataFrame, k: int = 20, max_miles: float = 200.0, pairs_per_task: int = 4_000_000
) -> DataFrame:
    """Top-``k`` stations of each ZIP within ``max_miles``, in the ``zipcode_stations`` schema.

    ``zips`` and ``stations`` as in ``operators.nearest.nearest_stations``; points without both coordinates take no part,
    and ties in distance are broken by station_id.
    """
    if max_miles is None or max_miles < 0:
        raise ValueError("max_miles must bound the search")
    chord = chord_of(max_miles) + MARGIN
    axes = range(3)

    def bound(size: Column) -> Column:
        """The diagonal of two cells, as far as a ZIP of a cell can be from a station of its block."""
        return size * F.lit(2 * math.sqrt(3.0) * (1 + 1e-9)) + F.lit(MARGIN)

    def touches(size: Column) -> Column:
        sides = [(F.col(f"_c{i}") * size, (F.col(f"_c{i}") + 1) * size) for i in axes]
        least = sum((F.pow(F.greatest(F.lit(0.0), low, -high), 2) for low, high in sides), F.lit(0.0))
        most = sum((F.pow(F.greatest(F.abs(low), F.abs(high)), 2) for low, high in sides), F.lit(0.0))
        return (least <= F.lit(1 + 1e-9)) & (most >= F.lit(1 - 1e-9))

    def within(far: Column) -> Column:
        gaps = [F.greatest(F.lit(0.0), F.col(f"_lo{i}") - F.col(f"_p{i}"), F.col(f"_p{i}") - F.col(f"_hi{i}")) for i in axes]
        return sum((g * g for g in gaps), F.lit(0.0)) <= (far + F.lit(MARGIN)) * (far + F.lit(MARGIN))

    space = Space(
        axes=3,
        base=max(MIN_CELL, 2 * chord),
        bound=bound,
        settles=lambda size, far: far <= F.lit(chord_of(max_miles)),
        full=F.lit(chord),
        reach=lambda far: [far + F.lit(MARGIN)] * 3,
        touches=touches,
        within=within,
    )
    z = zips.where("zipcode_latitude IS NOT NULL AND zipcode_longitude IS NOT NULL")
    z = z.withColumns({f"_p{i}": c for i, c in enumerate(unit_vector("zipcode_latitude", "zipcode_longitude"))})
    s = stations.where("station_latitude IS NOT NULL AND station_longitude IS NOT NULL")
    s = s.withColumns({f"_p{i}": c for i, c in enumerate(unit_vector("station_latitude", "station_longitude"))})

    def distance(station: Column) -> Column:
        return haversine_miles("zipcode_latitude", "zipcode_longitude", station["station_latitude"], station["station_longitude"])

    return nearest_in_space(z, s, space, k, lambda _, miles: miles <= F.lit(float(max_miles)), distance, pairs_per_task)
