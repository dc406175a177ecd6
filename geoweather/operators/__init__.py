"""DataFrame -> DataFrame transforms.  No operator triggers a job by itself."""

from geoweather.operators.coverage import coverage
from geoweather.operators.dictionaries import decode_flags, flag_summary
from geoweather.operators.metrics import (
    daily_metrics,
    element_stats_long,
    element_stats_wide,
    in_date_range,
    near_links,
    readings,
    zip_date_spine,
)
from geoweather.operators.nearest import (
    link_zipcodes_to_stations,
    nearest_stations,
    station_points,
    zipcode_points,
)
from geoweather.operators.preview import filter_rows, partition_values, preview
from geoweather.operators.replace import refresh_audit, replace_date_range, replace_newest_year, watermark_year
from geoweather.operators.storms import normalise_storms, typed_storms

__all__ = [
    "coverage",
    "daily_metrics",
    "decode_flags",
    "element_stats_long",
    "element_stats_wide",
    "filter_rows",
    "flag_summary",
    "in_date_range",
    "link_zipcodes_to_stations",
    "near_links",
    "nearest_stations",
    "normalise_storms",
    "partition_values",
    "preview",
    "readings",
    "refresh_audit",
    "replace_date_range",
    "replace_newest_year",
    "station_points",
    "typed_storms",
    "watermark_year",
    "zip_date_spine",
    "zipcode_points",
]
