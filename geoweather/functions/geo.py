"""Great-circle distance and grid-cell expressions (pure JVM column expressions)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: Earth radius in statute miles used for all distances.
EARTH_RADIUS_MILES = 3956.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_miles(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_MILES) -> Column:
    """Haversine distance between two points given in degrees, in miles."""
    lat1, lon1, lat2, lon2 = _c(lat1), _c(lon1), _c(lat2), _c(lon2)
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_dlon), 2
    )
    return F.lit(2 * radius) * F.asin(F.sqrt(a))


def latitude_reach_deg(max_miles: float | None, box_deg: float, radius: float = EARTH_RADIUS_MILES) -> float:
    """Largest |dlat| a pair can have and still pass both the box and the distance limit.

    The haversine distance is never below ``radius * |dlat|`` (radians), so a
    distance limit bounds the latitude gap.  A small margin keeps float noise from
    ever dropping a pair; the exact predicates are applied after the join anyway.
    """
    if max_miles is None:
        return box_deg
    return min(box_deg, math.degrees(max_miles / radius) + 1e-6)


def longitude_reach_deg(lat, max_miles: float | None, box_deg: float, radius: float = EARTH_RADIUS_MILES) -> Column:
    """Largest |dlon| (degrees) a point at latitude ``lat`` can have to a partner within
    ``max_miles`` and the box, as a column.

    From hav(d/R) = hav(dlat) + cos(lat1) cos(lat2) hav(dlon) >= cos(lat1) cos(lat2) hav(dlon),
    with the partner's latitude at most d/R away.  Near the poles the bound
    vanishes and the box applies.  A small margin absorbs float noise; the exact
    predicates are applied after the join.
    """
    box = F.lit(float(box_deg))
    if max_miles is None:
        return box
    ang = max_miles / radius
    hav_d = math.sin(ang / 2) ** 2
    phi = F.radians(F.abs(_c(lat)))
    far = F.least(phi + F.lit(ang), F.lit(math.pi / 2))
    denom = F.cos(phi) * F.cos(far)
    ratio = F.try_divide(F.lit(hav_d), denom)
    bound = F.degrees(F.lit(2.0) * F.asin(F.sqrt(ratio))) + F.lit(1e-6)
    return F.when((denom > F.lit(0.0)) & (ratio < F.lit(1.0)), F.least(box, bound)).otherwise(box)


def cell_index(coord, cell_deg: float) -> Column:
    """Integer grid index of a coordinate for square cells of ``cell_deg`` degrees."""
    return F.floor(_c(coord) / F.lit(float(cell_deg))).cast("int")


def cell_range(coord, reach_deg, cell_deg: float) -> Column:
    """Array of every cell index whose cell intersects [coord - reach, coord + reach].

    ``reach_deg`` is a number or a per-row column.
    """
    c = _c(coord)
    reach = reach_deg if isinstance(reach_deg, Column) else F.lit(float(reach_deg))
    return F.sequence(cell_index(c - reach, cell_deg), cell_index(c + reach, cell_deg))
