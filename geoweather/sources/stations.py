"""Fixed-width station list (one 85-character line per station)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweather.functions.casts import text_to_double

# Fixed values: (column, 1-based start, width) of the station file layout.
STATION_LAYOUT = (
    ("id", 1, 11),
    ("latitude", 13, 8),
    ("longitude", 22, 9),
    ("elevation", 32, 6),
    ("state", 39, 2),
    ("name", 42, 30),
    ("gsn_flag", 73, 3),
    ("hcn_crn_flag", 77, 3),
    ("wmo_id", 81, 5),
)
NUMERIC = {"latitude", "longitude", "elevation"}


def parse_station_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Slice each line; coordinates and elevation become doubles, only the name is trimmed.

    Blank flags and state stay as blank strings; the elevation sentinel -999.9 is
    kept as a value, as the source documents it.
    """
    out = []
    for name, start, width in STATION_LAYOUT:
        piece = F.substring(F.col(col), start, width)
        if name in NUMERIC:
            piece = text_to_double(piece)
        elif name == "name":
            piece = F.trim(piece)
        out.append(piece.alias(name))
    return lines.select(*out)


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return parse_station_lines(spark.read.text(path))
