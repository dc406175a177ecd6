"""Fixed table schemas and the conform step that maps any frame onto one.

All final tables have explicit schemas; nothing is inferred.  ``conform`` is the
equivalent of an ``INSERT INTO t SELECT ...`` with positional-free, name-based
explicit casts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The five core GHCN elements aggregated per ZIP and day, in output order.
CORE_ELEMENTS = ("PRCP", "SNOW", "SNWD", "TMAX", "TMIN")

# Yearly observation file, one row per station-day-element (8 positional columns).
OBSERVATIONS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("element", T.StringType()),
        T.StructField("data_value", T.IntegerType()),
        T.StructField("m_flag", T.StringType()),
        T.StructField("q_flag", T.StringType()),
        T.StructField("s_flag", T.StringType()),
        T.StructField("obs_time", T.StringType()),
    ]
)

STATIONS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("elevation", T.DoubleType()),
        T.StructField("state", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("gsn_flag", T.StringType()),
        T.StructField("hcn_crn_flag", T.StringType()),
        T.StructField("wmo_id", T.StringType()),
    ]
)

ZIPCODES = T.StructType(
    [
        T.StructField("GEOID", T.StringType()),
        T.StructField("ALAND", T.LongType()),
        T.StructField("AWATER", T.LongType()),
        T.StructField("ALAND_SQMI", T.DoubleType()),
        T.StructField("AWATER_SQMI", T.DoubleType()),
        T.StructField("INTPTLAT", T.DoubleType()),
        T.StructField("INTPTLONG", T.DoubleType()),
    ]
)

ZIPCODE_STATIONS = T.StructType(
    [
        T.StructField("zipcode", T.StringType()),
        T.StructField("station_id", T.StringType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("station_latitude", T.DoubleType()),
        T.StructField("station_longitude", T.DoubleType()),
        T.StructField("zipcode_latitude", T.DoubleType()),
        T.StructField("zipcode_longitude", T.DoubleType()),
        T.StructField("distance_miles", T.DoubleType()),
        T.StructField("rank", T.IntegerType()),
    ]
)


def _metric_fields() -> list[T.StructField]:
    out = []
    for element in CORE_ELEMENTS:
        m = element.lower()
        out += [
            T.StructField(m, T.DoubleType()),
            T.StructField(f"{m}_count", T.IntegerType()),
            T.StructField(f"{m}_stddev", T.DoubleType()),
        ]
    return out


ZIPCODE_DAILY_METRICS = T.StructType(
    [
        T.StructField("zipcode", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
    ]
    + _metric_fields()
)

COVERAGE = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("total", T.LongType()),
        T.StructField("with_data", T.LongType()),
        T.StructField("percentage", T.DoubleType()),
    ]
)

# Storm events: 51 columns in table order.  Fixed values (column names and types).
_STORM_COLUMNS = [
    ("BEGIN_YEARMONTH", T.LongType()),
    ("BEGIN_DAY", T.LongType()),
    ("BEGIN_TIME", T.LongType()),
    ("END_YEARMONTH", T.LongType()),
    ("END_DAY", T.LongType()),
    ("END_TIME", T.LongType()),
    ("EPISODE_ID", T.StringType()),
    ("EVENT_ID", T.LongType()),
    ("STATE", T.StringType()),
    ("STATE_FIPS", T.LongType()),
    ("YEAR", T.LongType()),
    ("MONTH_NAME", T.StringType()),
    ("EVENT_TYPE", T.StringType()),
    ("CZ_TYPE", T.StringType()),
    ("CZ_FIPS", T.LongType()),
    ("CZ_NAME", T.StringType()),
    ("WFO", T.StringType()),
    ("BEGIN_DATE_TIME", T.TimestampNTZType()),
    ("CZ_TIMEZONE", T.StringType()),
    ("END_DATE_TIME", T.TimestampNTZType()),
    ("INJURIES_DIRECT", T.LongType()),
    ("INJURIES_INDIRECT", T.LongType()),
    ("DEATHS_DIRECT", T.LongType()),
    ("DEATHS_INDIRECT", T.LongType()),
    ("DAMAGE_PROPERTY", T.DoubleType()),
    ("DAMAGE_CROPS", T.DoubleType()),
    ("SOURCE", T.StringType()),
    ("MAGNITUDE", T.LongType()),
    ("MAGNITUDE_TYPE", T.StringType()),
    ("FLOOD_CAUSE", T.StringType()),
    ("CATEGORY", T.StringType()),
    ("TOR_F_SCALE", T.StringType()),
    ("TOR_LENGTH", T.DoubleType()),
    ("TOR_WIDTH", T.LongType()),
    ("TOR_OTHER_WFO", T.StringType()),
    ("TOR_OTHER_CZ_STATE", T.StringType()),
    ("TOR_OTHER_CZ_FIPS", T.StringType()),
    ("TOR_OTHER_CZ_NAME", T.StringType()),
    ("BEGIN_RANGE", T.LongType()),
    ("BEGIN_AZIMUTH", T.StringType()),
    ("BEGIN_LOCATION", T.StringType()),
    ("END_RANGE", T.LongType()),
    ("END_AZIMUTH", T.StringType()),
    ("END_LOCATION", T.StringType()),
    ("BEGIN_LAT", T.DoubleType()),
    ("BEGIN_LON", T.DoubleType()),
    ("END_LAT", T.DoubleType()),
    ("END_LON", T.DoubleType()),
    ("EPISODE_NARRATIVE", T.StringType()),
    ("EVENT_NARRATIVE", T.StringType()),
    ("DATA_SOURCE", T.StringType()),
]

STORM_EVENTS = T.StructType([T.StructField(n, t) for n, t in _STORM_COLUMNS])


def all_strings(schema: T.StructType) -> T.StructType:
    """Same column names, every column a string: the staging schema for text files."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def conform(df: DataFrame, schema: T.StructType, exprs: dict[str, Column] | None = None) -> DataFrame:
    """Project ``df`` onto ``schema`` by name with explicit casts.

    Columns missing from ``df`` become typed NULLs; ``exprs`` overrides the
    expression used for individual target columns.
    """
    exprs = exprs or {}
    present = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in exprs:
            c = exprs[f.name]
        elif f.name in present:
            c = F.col(f.name)
        else:
            c = F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)
