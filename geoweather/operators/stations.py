"""Station-level derivations described in the data manual.

* ``station_codes``: country (FIPS, id characters 1-2) and network (character 3);
* ``element_inventory``: first and last year of unflagged data per station and element;
* ``pick_by_source_priority``: one reading per station, day and element, from the
  highest-priority source when several sources report the same day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Source flags from highest to lowest priority, as documented.
SOURCE_PRIORITY = "Z,R,D,0,6,C,X,W,K,7,F,B,M,f,m,r,E,z,u,b,s,a,G,Q,I,A,N,T,U,H,S".split(",")


def station_codes(stations: DataFrame) -> DataFrame:
    """Adds ``country_code`` and ``network_code`` taken from the station id."""
    return stations.select(
        "*",
        F.substring("id", 1, 2).alias("country_code"),
        F.substring("id", 3, 1).alias("network_code"),
    )


def name_station_codes(stations: DataFrame, countries: DataFrame, states: DataFrame) -> DataFrame:
    """``station_codes`` plus ``country_name`` and ``state_name`` from the code tables.

    ``countries`` and ``states`` are (code, name) as read by ``read_countries`` /
    ``read_states``.  Both are left joins, so stations with unknown codes keep NULL
    names; Spark broadcasts the code tables while they are below its size threshold.
    """
    c = countries.select(F.col("code").alias("country_code"), F.col("name").alias("country_name"))
    st = states.select(F.col("code").alias("state"), F.col("name").alias("state_name"))
    return station_codes(stations).join(c, "country_code", "left").join(st, "state", "left")


def element_inventory(obs: DataFrame, stations: DataFrame) -> DataFrame:
    """(id, latitude, longitude, element, firstyear, lastyear) from unflagged readings.

    The per-(station, element) min/max is a hash aggregate with map-side partial
    aggregation, so no station's rows are ever gathered in one place.
    """
    years = (
        obs.where(F.col("q_flag").isNull())
        .groupBy("id", "element")
        .agg(F.min(F.year("date")).alias("firstyear"), F.max(F.year("date")).alias("lastyear"))
    )
    coords = stations.select("id", "latitude", "longitude")
    return years.join(coords, "id", "left").select(
        "id", "latitude", "longitude", "element", "firstyear", "lastyear"
    )


def source_rank(s_flag) -> F.Column:
    """0 for the highest-priority source; unknown or missing sources rank last."""
    col = F.col(s_flag) if isinstance(s_flag, str) else s_flag
    pos = F.array_position(F.array(*[F.lit(s) for s in SOURCE_PRIORITY]), col)
    return F.when(pos > 0, pos - 1).otherwise(F.lit(len(SOURCE_PRIORITY)))


def pick_by_source_priority(obs: DataFrame) -> DataFrame:
    """One row per (id, date, element): the reading of the highest-priority source.

    Expressed as a grouped minimum over (source rank, remaining fields), which
    Spark pre-aggregates per map task, so even a very hot key never lands in a
    single task.  Ties within one source are broken by the smallest value.
    """
    ranked = obs.select(
        "id",
        "date",
        "element",
        F.struct(
            source_rank("s_flag").alias("rank"),
            "data_value",
            "m_flag",
            "q_flag",
            "s_flag",
            "obs_time",
        ).alias("best"),
    )
    best = ranked.groupBy("id", "date", "element").agg(F.min("best").alias("best"))
    out = best.select("id", "date", "element", "best.data_value", "best.m_flag", "best.q_flag", "best.s_flag", "best.obs_time")
    return out.withColumn("year", F.year("date")) if "year" in obs.columns else out
