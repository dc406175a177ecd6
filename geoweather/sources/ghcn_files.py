"""Other GHCN-Daily file formats described in the data manual.

* monthly ``.dly`` records (one station-month-element per line, 31 day blocks);
* ``ghcnd-inventory.txt`` (station x element first/last year);
* ``ghcnd-countries.txt`` / ``ghcnd-states.txt`` (code -> name).

All are fixed-width text read with ``spark.read.text`` and sliced by position;
nothing is parsed in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweather.functions.casts import text_to_double

# Fixed values: .dly layout - id 1-11, year 12-15, month 16-17, element 18-21, then
# 31 day blocks of 8 characters starting at column 22: value (5), mflag, qflag, sflag.
DLY_FIRST_BLOCK = 22
DLY_BLOCK_WIDTH = 8
DLY_DAYS = 31
MISSING_VALUE = -9999

# Fixed values: (column, 1-based start, width) of the inventory and code files.
INVENTORY_LAYOUT = (("id", 1, 11), ("latitude", 13, 8), ("longitude", 22, 9), ("element", 32, 4),
                    ("firstyear", 37, 4), ("lastyear", 42, 4))
COUNTRY_LAYOUT = (("code", 1, 2), ("name", 4, 61))
STATE_LAYOUT = (("code", 1, 2), ("name", 4, 47))


def _flag(piece: Column) -> Column:
    """One-character flag; blank means no flag (NULL, as in the yearly files)."""
    return F.when(piece != F.lit(" "), piece)


def parse_dly_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Monthly records -> one row per station, day and element (the yearly-file schema + ``year``).

    Each line is exploded over its 31 day indexes and the day block is sliced by
    position.  Days marked missing (-9999, including the 29th-31st of short
    months) are dropped; a non-missing value on a day the month does not have
    gets a NULL date.
    """
    v = F.col(col)
    month = lines.select(
        F.substring(v, 1, 11).alias("id"),
        F.substring(v, 12, 4).try_cast("int").alias("y"),
        F.substring(v, 16, 2).try_cast("int").alias("m"),
        F.substring(v, 18, 4).alias("element"),
        v.alias("_line"),
        F.explode(F.sequence(F.lit(0), F.lit(DLY_DAYS - 1))).alias("_i"),
    )
    line, start = F.col("_line"), F.lit(DLY_FIRST_BLOCK) + F.col("_i") * F.lit(DLY_BLOCK_WIDTH)
    blocks = month.select(
        "id", "y", "m", "element",
        (F.col("_i") + 1).alias("day"),
        F.trim(line.substr(start, F.lit(5))).try_cast("int").alias("data_value"),
        _flag(line.substr(start + 5, F.lit(1))).alias("m_flag"),
        _flag(line.substr(start + 6, F.lit(1))).alias("q_flag"),
        _flag(line.substr(start + 7, F.lit(1))).alias("s_flag"),
    )
    kept = F.col("data_value").isNull() | (F.col("data_value") != F.lit(MISSING_VALUE))
    date = F.try_make_timestamp_ntz(F.col("y"), F.col("m"), F.col("day"), F.lit(0), F.lit(0), F.lit(0)).cast("date")
    return blocks.where(kept).select(
        "id",
        date.alias("date"),
        "element",
        "data_value",
        "m_flag",
        "q_flag",
        "s_flag",
        F.lit(None).cast("string").alias("obs_time"),
        F.col("y").alias("year"),
    )


def read_dly(spark: SparkSession, paths) -> DataFrame:
    return parse_dly_lines(spark.read.text(paths))


def _fixed(lines: DataFrame, layout, numeric=(), integer=(), col: str = "value") -> DataFrame:
    out = []
    for name, start, width in layout:
        piece = F.substring(F.col(col), start, width)
        if name in numeric:
            piece = text_to_double(piece)
        elif name in integer:
            piece = F.trim(piece).try_cast("int")
        else:
            piece = F.rtrim(piece)
        out.append(piece.alias(name))
    return lines.select(*out)


def parse_inventory_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    return _fixed(lines, INVENTORY_LAYOUT, numeric=("latitude", "longitude"), integer=("firstyear", "lastyear"), col=col)


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    return parse_inventory_lines(spark.read.text(path))


def read_countries(spark: SparkSession, path: str) -> DataFrame:
    return _fixed(spark.read.text(path), COUNTRY_LAYOUT)


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return _fixed(spark.read.text(path), STATE_LAYOUT)
