"""Readers with explicit schemas.  Nothing here triggers a job except file listing."""

from geoweather.sources.gazetteer import parse_zipcode_lines, read_zipcodes
from geoweather.sources.lake import lake_view
from geoweather.sources.listing import (
    annotate_observation_files,
    annotate_storm_files,
    list_files,
    list_observation_files,
    list_storm_files,
    selected_paths,
)
from geoweather.sources.observations import (
    observation_rejects,
    parse_observation_lines,
    read_observations,
)
from geoweather.sources.stations import parse_station_lines, read_stations
from geoweather.sources.storms import read_storm_files

__all__ = [
    "annotate_observation_files",
    "annotate_storm_files",
    "lake_view",
    "list_files",
    "list_observation_files",
    "list_storm_files",
    "observation_rejects",
    "parse_observation_lines",
    "parse_station_lines",
    "parse_zipcode_lines",
    "read_observations",
    "read_stations",
    "read_storm_files",
    "read_zipcodes",
    "selected_paths",
]
