"""Structured Streaming ingest for sources whose file names change per version."""

from geoweather.streaming.storm_files import start_storm_ingest, storm_file_stream

__all__ = ["start_storm_ingest", "storm_file_stream"]
