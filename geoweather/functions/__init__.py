"""Column expressions.  Every function returns a ``Column`` and stays inside codegen."""

from geoweather.functions.casts import (
    is_number,
    round_half_even_to_long,
    text_to_double,
    text_to_long,
)
from geoweather.functions.damage import damage_is_valid, damage_to_dollars
from geoweather.functions.files import (
    base_name,
    storm_file_stamp,
    storm_file_year,
    yearly_file_year,
)
from geoweather.functions.geo import (
    EARTH_RADIUS_MILES,
    cell_index,
    cell_range,
    haversine_miles,
    latitude_reach_deg,
)
from geoweather.functions.timeparts import parts_text, parts_to_timestamp, timestamp_is_valid

__all__ = [
    "EARTH_RADIUS_MILES",
    "base_name",
    "cell_index",
    "cell_range",
    "damage_is_valid",
    "damage_to_dollars",
    "haversine_miles",
    "is_number",
    "latitude_reach_deg",
    "parts_text",
    "parts_to_timestamp",
    "round_half_even_to_long",
    "storm_file_stamp",
    "storm_file_year",
    "text_to_double",
    "text_to_long",
    "timestamp_is_valid",
    "yearly_file_year",
]
