"""Deterministic stand-in inputs derived from the driver's TPC-H-style tables.

The test tables carry no geography, so each weather input is derived from one of
them with integer arithmetic that DuckDB reproduces bit for bit (see
``geoweather.oracle``).  Each source row gives one row, but for ``storm_file_names`` (distinct
names) and ``dly_lines`` (one reading per station, day and element, picked by source priority).

* ZIP gazetteer      <- customer   (one ZIP per customer)
* stations           <- supplier   (one station per supplier, some without latitude)
* observations       <- events     (station = user, element from event type)
* raw storm rows     <- orders     (all-string staging rows as read from a CSV file)
* damage texts       <- part
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweather.operators.stations import pick_by_source_priority
from geoweather.schemas import STORM_EVENTS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _s(c) -> Column:
    return c.cast("string")


def zipcodes(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return c.select(
        *([key] if with_key else []),
        F.format_string("%05d", key).alias("GEOID"),
        (key * 1000).alias("ALAND"),
        (key * 10).alias("AWATER"),
        F.col("c_acctbal").alias("ALAND_SQMI"),
        ((key % 100) / F.lit(100.0)).alias("AWATER_SQMI"),
        (F.lit(25.0) + ((key * 7919) % 2400).cast("double") / F.lit(100.0)).alias("INTPTLAT"),
        (F.lit(-124.0) + ((key * 104729) % 5700).cast("double") / F.lit(100.0)).alias("INTPTLONG"),
    )


def stations(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    return s.select(
        *([key] if with_key else []),
        F.format_string("US%09d", key).alias("id"),
        F.when(key % 37 == 36, F.lit(None).cast("double"))
        .otherwise(F.lit(25.0) + ((key * 7907) % 2400).cast("double") / F.lit(100.0))
        .alias("latitude"),
        (F.lit(-124.0) + ((key * 104723) % 5700).cast("double") / F.lit(100.0)).alias("longitude"),
        F.when(key % 11 == 10, F.lit(-999.9))
        .otherwise(((key * 31) % 30000).cast("double") / F.lit(10.0))
        .alias("elevation"),
        F.when(nation % 5 == 0, F.lit("  "))
        .otherwise(F.concat(F.chr(F.lit(65) + nation % 26), F.chr(F.lit(65) + key % 26)))
        .alias("state"),
        F.col("s_name").alias("name"),
        F.when(key % 4 == 0, F.lit("GSN")).otherwise(F.lit("   ")).alias("gsn_flag"),
        F.when(key % 3 == 0, F.lit("HCN")).when(key % 3 == 1, F.lit("CRN")).otherwise(F.lit("   ")).alias("hcn_crn_flag"),
        F.when(key % 5 == 0, F.format_string("%05d", (key * 13) % 100000)).otherwise(F.lit("     ")).alias("wmo_id"),
    )


# Event type -> GHCN element used by the observation stand-in.
EVENT_ELEMENTS = (("view", "PRCP"), ("click", "SNOW"), ("purchase", "SNWD"), ("signup", "TMAX"), ("error", "TMIN"))


def _element_of(event_type: Column, event_id: Column) -> Column:
    expr = F.when(event_id % 23 == 0, F.lit("WT01"))
    for etype, element in EVENT_ELEMENTS:
        expr = expr.when(event_type == F.lit(etype), F.lit(element))
    return expr


def observations(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    e = table(spark, sf_dir, "events")
    eid, ts = F.col("event_id"), F.col("ts")
    date = ts.cast("date")
    return e.select(
        *([eid] if with_key else []),
        F.format_string("US%09d", F.col("user_id")).alias("id"),
        date.alias("date"),
        _element_of(F.col("event_type"), eid).alias("element"),
        F.when(eid % 29 == 0, F.lit(None).cast("int")).otherwise(F.round("value").cast("int")).alias("data_value"),
        F.when(eid % 13 == 0, F.lit("T")).alias("m_flag"),
        F.when(eid % 17 == 0, F.lit("X")).alias("q_flag"),
        F.when(eid % 3 == 0, F.lit("W"))
        .when(eid % 3 == 1, F.lit("7"))
        .otherwise(F.lit("S"))
        .alias("s_flag"),
        F.when(eid % 5 == 0, F.lit(None).cast("string"))
        .otherwise(F.lpad(_s(F.hour(ts) * 100 + F.minute(ts)), 4, "0"))
        .alias("obs_time"),
        F.year(date).alias("year"),
    )


# Storm columns with a rule of their own (or computed later); the others are filled by kind.
NAMED_STORM_COLUMNS = (
    "BEGIN_YEARMONTH", "BEGIN_DAY", "BEGIN_TIME", "END_YEARMONTH", "END_DAY", "END_TIME", "EPISODE_ID", "EVENT_ID", "STATE",
    "STATE_FIPS", "YEAR", "MONTH_NAME", "EVENT_TYPE", "DAMAGE_PROPERTY", "DAMAGE_CROPS", "MAGNITUDE", "TOR_LENGTH",
    "DATA_SOURCE", "BEGIN_DATE_TIME", "END_DATE_TIME",
)


def storm_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string storm staging rows; some days (key % 97) and hours (24) are invalid, some damage
    amounts (key % 101) and state codes (key % 103) unreadable."""
    o = table(spark, sf_dir, "orders")
    key, cust, d = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    filled = []
    for i, f in enumerate(f for f in STORM_EVENTS.fields if f.name not in NAMED_STORM_COLUMNS):
        kind = f.dataType.simpleString()
        if kind == "bigint":
            text = _s((key + i) % (7 + i))
        elif kind == "double":
            text = F.concat(_s((cust + i) % (50 + i)), F.lit(".25"))
        else:
            text = F.when(key % (5 + i % 7) != 0, F.concat(F.lit(f"{f.name} "), _s(cust % (3 + i))))
        filled.append(text.alias(f.name))
    ym = F.year(d) * 100 + F.month(d)
    damage_suffix = (
        F.when(key % 6 == 0, F.lit("K"))
        .when(key % 6 == 1, F.lit("M"))
        .when(key % 6 == 2, F.lit("B"))
        .when(key % 6 == 3, F.lit(""))
        .when(key % 6 == 4, F.lit(".50K"))
        .otherwise(F.lit("H"))
    )
    quarter = F.when(cust % 4 == 0, F.lit("00")).when(cust % 4 == 1, F.lit("25")).when(cust % 4 == 2, F.lit("50")).otherwise(F.lit("75"))
    return o.select(
        _s(ym).alias("BEGIN_YEARMONTH"),
        _s(F.dayofmonth(d) + F.when(key % 97 == 0, F.lit(30)).otherwise(F.lit(0))).alias("BEGIN_DAY"),
        _s((key % 25) * 100 + key % 60).alias("BEGIN_TIME"),
        _s(ym).alias("END_YEARMONTH"),
        _s(F.dayofmonth(d)).alias("END_DAY"),
        _s((key % 24) * 100 + 59).alias("END_TIME"),
        _s(cust).alias("EPISODE_ID"),
        _s(key).alias("EVENT_ID"),
        F.col("o_orderpriority").alias("STATE"),
        F.concat(F.when(key % 103 == 0, F.lit("X")).otherwise(F.lit("")), _s(cust % 56)).alias("STATE_FIPS"),
        _s(F.year(d)).alias("YEAR"),
        F.date_format(d, "MMMM").alias("MONTH_NAME"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Hail"))
        .when(F.col("o_orderstatus") == "O", F.lit("Tornado"))
        .otherwise(F.lit("Flood"))
        .alias("EVENT_TYPE"),
        F.concat(F.when(key % 101 == 0, F.lit("AB")).otherwise(F.lit("")), _s(cust % 100), damage_suffix).alias("DAMAGE_PROPERTY"),
        F.when(key % 4 == 0, F.lit(None).cast("string"))
        .when(key % 4 == 1, F.lit("0.00K"))
        .otherwise(F.concat(_s(cust % 7), F.lit("k")))
        .alias("DAMAGE_CROPS"),
        F.when(key % 4 == 0, F.lit(None).cast("string"))
        .when(key % 4 == 1, _s(cust % 90))
        .otherwise(F.concat(_s(F.floor((cust % 12) / 4)), F.lit("."), quarter))
        .alias("MAGNITUDE"),
        F.concat(_s(key % 100), F.lit(".5")).alias("TOR_LENGTH"),
        F.col("o_orderstatus").alias("DATA_SOURCE"),
        *filled,
    )


def damage_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    key, size = F.col("p_partkey"), _s(F.col("p_size"))
    text = (
        F.when(key % 10 == 0, F.concat(size, F.lit("K")))
        .when(key % 10 == 1, F.concat(size, F.lit(".5M")))
        .when(key % 10 == 2, F.concat(size, F.lit("b")))
        .when(key % 10 == 3, size)
        .when(key % 10 == 4, F.concat(size, F.lit("H")))
        .when(key % 10 == 5, F.lit(""))
        .when(key % 10 == 6, F.lit(None).cast("string"))
        .when(key % 10 == 7, F.lit("K"))
        .when(key % 10 == 8, F.concat(F.lit("1E"), _s(F.col("p_size") % 3), F.lit("K")))
        .otherwise(F.concat(size, F.lit("KK")))
    )
    return p.select("p_partkey", text.alias("damage_text"))


def station_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed-width 85-character station lines built from the station stand-in."""
    s = stations(spark, sf_dir)
    lat = F.when(F.col("latitude").isNull(), F.lit(" " * 8)).otherwise(F.format_string("%8.4f", "latitude"))
    line = F.concat_ws(
        " ",
        F.rpad("id", 11, " "),
        lat,
        F.format_string("%9.4f", "longitude"),
        F.format_string("%6.1f", "elevation"),
        F.col("state"),
        F.rpad("name", 30, " "),
        F.col("gsn_flag"),
        F.col("hcn_crn_flag"),
        F.col("wmo_id"),
    )
    return s.select(line.alias("value"))


def observation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma-separated yearly-file lines (no header, empty field = missing).

    Lines whose event number leaves 1 to 5 at 41 are damaged: no date, an unreadable date,
    an unreadable value, no station, no element.
    """
    o = observations(spark, sf_dir, with_key=True)
    kind = F.col("event_id") % 41
    fields = [
        F.when(kind != 4, F.col("id")),
        F.when(kind == 2, F.lit("2024-13-45")).when(kind != 1, F.date_format("date", "yyyyMMdd")),
        F.when(kind != 5, F.col("element")),
        F.when(kind == 3, F.lit("1x2")).otherwise(_s(F.col("data_value"))),
        F.col("m_flag"),
        F.col("q_flag"),
        F.col("s_flag"),
        F.col("obs_time"),
    ]
    return o.select(F.concat_ws(",", *[F.coalesce(f, F.lit("")) for f in fields]).alias("value"))


def zipcode_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated gazetteer lines; the last field carries trailing blanks."""
    z = zipcodes(spark, sf_dir)
    return z.select(
        F.concat_ws(
            "\t",
            F.col("GEOID"),
            _s(F.col("ALAND")),
            _s(F.col("AWATER")),
            F.format_string("%.3f", "ALAND_SQMI"),
            F.format_string("%.3f", "AWATER_SQMI"),
            F.format_string("%.6f", "INTPTLAT"),
            F.concat(F.format_string("%.6f", "INTPTLONG"), F.lit("   ")),
        ).alias("value")
    )


def storm_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct storm file names, one per order date: ..._dYYYY_cYYYYMMDD.csv.gz."""
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    name = F.concat(
        F.lit("StormEvents_details-ftp_v1.0_d"),
        _s(F.year(d)),
        F.lit("_c"),
        F.date_format(d, "yyyyMMdd"),
        F.lit(".csv.gz"),
    )
    return o.select(name.alias("name")).distinct()


def dly_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly .dly records built from the observation stand-in.

    One line per station, year, month and element; each day block is
    value (5, right-aligned, -9999 when missing) + m/q/s flags (blank when none).
    When several sources report a day, the reading of the highest-priority one is in the record.
    """
    o = pick_by_source_priority(observations(spark, sf_dir))
    block = F.concat(
        F.coalesce(F.lpad(_s(F.col("data_value")), 5, " "), F.lit("-9999")),
        F.coalesce(F.col("m_flag"), F.lit(" ")),
        F.coalesce(F.col("q_flag"), F.lit(" ")),
        F.coalesce(F.col("s_flag"), F.lit(" ")),
    )
    blocks = o.select(
        "id", "element", F.year("date").alias("y"), F.month("date").alias("m"),
        F.dayofmonth("date").alias("day"), block.alias("block"),
    )
    per_day = [F.max(F.when(F.col("day") == d, F.col("block"))).alias(f"d{d}") for d in range(1, 32)]
    months = blocks.groupBy("id", "y", "m", "element").agg(*per_day)
    missing = F.lit("-9999   ")
    line = F.concat(
        F.col("id"),
        F.format_string("%04d", "y"),
        F.format_string("%02d", "m"),
        F.col("element"),
        *[F.coalesce(F.col(f"d{d}"), missing) for d in range(1, 32)],
    )
    return months.select(line.alias("value"))


def observation_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The observations in two parts, as if the second had arrived late."""
    o = observations(spark, sf_dir, with_key=True)
    late = F.col("event_id") % 3 == 0
    return o.where(~late).drop("event_id"), o.where(late).drop("event_id")


def published_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an inventory published earlier was made of: fewer readings, and some stations a year earlier."""
    o = observations(spark, sf_dir, with_key=True)
    early = F.when(F.col("id").endswith("7"), F.add_months("date", -12)).otherwise(F.col("date"))
    return o.where((F.col("event_id") % 23 != 0) & ~F.col("id").endswith("9")).withColumn("date", early).drop("event_id")


def file_listings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two listings of yearly files in one folder a customer group: some new, gone, longer or only touched in the second."""
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y"), (F.col("o_custkey") % 40).alias("c"), "o_orderkey", "o_orderdate")
    g = o.groupBy("y", "c").agg(F.sum("o_orderkey").alias("length"), F.max("o_orderdate").cast("timestamp").alias("modified"))
    name = F.concat(_s(F.col("y")), F.lit(".csv.gz"))
    g = g.select("c", F.concat(F.lit("/in/"), _s(F.col("c")), F.lit("/"), name).alias("path"), name.alias("name"), "length", "modified")
    later = g.withColumn("length", F.col("length") + F.when(F.col("c") % 3 == 0, F.lit(1)).otherwise(F.lit(0)))
    later = later.withColumn("modified", F.when(F.col("c") % 4 == 0, F.col("modified") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("modified")))
    return g.where("c % 5 <> 1").drop("c"), later.where("c % 7 <> 2").drop("c")


def earlier_zipcode_points(zips: DataFrame) -> DataFrame:
    """ZIP points of before: some missing, some elsewhere, and some since given up."""
    tail = F.substring("zipcode", 4, 2)
    moved = F.when(tail == "33", F.col("zipcode_latitude") + 0.5).otherwise(F.col("zipcode_latitude"))
    gone = zips.where(tail == "11").withColumn("zipcode", F.concat(F.lit("X"), F.col("zipcode")))
    return zips.where(tail != "07").withColumn("zipcode_latitude", moved).unionByName(gone)


def earlier_station_points(stations: DataFrame) -> DataFrame:
    """Station points of before: some missing, some elsewhere, and some since closed."""
    tail = F.substring("station_id", 11, 1)
    moved = F.when(tail == "3", F.col("station_longitude") - 0.75).otherwise(F.col("station_longitude"))
    closed = stations.where(tail == "5").withColumn("station_id", F.concat(F.lit("OLD"), F.col("station_id")))
    return stations.where(tail != "8").withColumn("station_longitude", moved).unionByName(closed)


def globe_points(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """ZIP and station points over the whole globe, from pole to pole and up to the 180th meridian."""

    def coordinate(key: str, factor: int, span: int) -> Column:
        return ((F.col(key) * factor) % (span * 100 + 1)).cast("double") / F.lit(100.0) - F.lit(span / 2.0)

    z = table(spark, sf_dir, "customer").select(
        F.format_string("%05d", "c_custkey").alias("zipcode"),
        coordinate("c_custkey", 7919, 180).alias("zipcode_latitude"),
        coordinate("c_custkey", 104729, 360).alias("zipcode_longitude"),
    )
    s = table(spark, sf_dir, "supplier").select(
        F.format_string("US%09d", "s_suppkey").alias("station_id"),
        F.col("s_name").alias("station_name"),
        coordinate("s_suppkey", 7907, 180).alias("station_latitude"),
        coordinate("s_suppkey", 104723, 360).alias("station_longitude"),
    )
    return z, s
