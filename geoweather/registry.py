"""Registered queries: one callable per operator group, each over the whole stand-in tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame; the matching
DuckDB SQL lives in ``geoweather.oracle.ORACLE_SQL``.  Floating results that two
engines may compute with different last bits are rounded to 6 digits on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweather import derived
from geoweather.functions.casts import round_half_even_to_long, text_to_long
from geoweather.functions.damage import damage_to_dollars
from geoweather.functions.geo import haversine_miles
from geoweather.functions.timeparts import parts_to_timestamp
from geoweather.operators.compare import reconcile_inventory
from geoweather.operators.coverage import coverage
from geoweather.operators.dictionaries import decode_flags, flag_summary
from geoweather.operators.link_refresh import refresh_links
from geoweather.operators.metrics import (
    daily_metrics,
    element_stats_long,
    element_stats_wide,
    in_date_range,
    near_links,
    readings,
    zip_date_spine,
)
from geoweather.operators.moments import merge_moments, metrics_from_moments, station_day_moments
from geoweather.operators.nearest import first_pass, link_zipcodes_to_stations, nearest_stations, second_pass, station_points, zipcode_points
from geoweather.operators.preview import filter_rows, partition_values, preview
from geoweather.operators.replace import refresh_audit, replace_date_range, replace_newest_year
from geoweather.operators.sphere import nearest_stations_on_sphere
from geoweather.operators.stations import element_inventory, name_station_codes, pick_by_source_priority, station_codes
from geoweather.operators.storms import normalise_storms
from geoweather.plans.audit import audited, run_history
from geoweather.plans.catalog import describe_table, drop_table, open_table, register_table
from geoweather.plans.export import export_parquet
from geoweather.plans.footers import from_footers
from geoweather.schemas import CORE_ELEMENTS
from geoweather.plans.tables import replace_date_range as refresh_range
from geoweather.plans.tables import replace_years, resume_from
from geoweather.session import scratch_path
from geoweather.sources.gazetteer import parse_zipcode_lines
from geoweather.sources.ghcn_files import parse_dly_lines, parse_inventory_lines
from geoweather.sources.lake import lake_view
from geoweather.sources.listing import annotate_observation_files, annotate_storm_files, input_splits, list_files
from geoweather.sources.observations import parse_observation_lines
from geoweather.sources.snapshots import listing_changes
from geoweather.sources.stations import parse_station_lines
from geoweather.sources.storms import CORRUPT, read_storm_files

# Parameters of the registered queries (the reference's defaults where it has one).
K_NEAREST = 20
LINK_MAX_MILES = 200.0
FIRST_PASS_MILES = 60.0
BOX_DEG = 5.0
METRIC_MAX_MILES = 20.0
MIN_DATE, MAX_DATE = "2024-01-01", "2024-12-31"
RANGE_MIN, RANGE_MAX = "2024-01-10", "2024-01-20"
RANGE_MAX_MILES = 100.0
SINCE_YEAR = 1997
EXPORT_WHERE = "EVENT_TYPE = 'Hail' OR STATE = '1-URGENT'"
EXPORT_YEAR = 1996
RELOADED_YEARS = (1994, 1996)
CLUSTER_GROUP, CLUSTER_RANGE = 1000, (100, 120)
SPHERE_MILES, SPHERE_K = 700.0, 10
TABLE_RANGE = ("1995-03-10", "1995-06-20")
METRIC_COLS = [c for e in CORE_ELEMENTS for c in (e.lower(), f"{e.lower()}_count", f"{e.lower()}_stddev")]


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------- shared inputs
def link_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The zipcode_stations rows, lazily."""
    return link_zipcodes_to_stations(
        derived.zipcodes(spark, sf), derived.stations(spark, sf), k=K_NEAREST, max_miles=LINK_MAX_MILES, box_deg=BOX_DEG
    )


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written as a Parquet table under the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def links(spark: SparkSession, sf: str) -> DataFrame:
    """The zipcode_stations table, stored once per query (as it is in production)."""
    return stored(link_rows(spark, sf), "links")


def obs_in_range(spark: SparkSession, sf: str) -> DataFrame:
    return in_date_range(derived.observations(spark, sf), MIN_DATE, MAX_DATE)


def near(spark: SparkSession, sf: str, max_miles: float = METRIC_MAX_MILES) -> DataFrame:
    return near_links(link_rows(spark, sf), max_miles)


def metrics(spark: SparkSession, sf: str, lo=MIN_DATE, hi=MAX_DATE, max_miles=METRIC_MAX_MILES, lk=None) -> DataFrame:
    lk = lk if lk is not None else links(spark, sf)
    return daily_metrics(derived.observations(spark, sf), lk, lo, hi, max_miles=max_miles)


def storms(spark: SparkSession, sf: str) -> DataFrame:
    """Normalised storm rows; only the columns a query uses are typed."""
    splits = storm_splits(spark, sf)
    rows, _ = normalise_storms(derived.storm_raw(spark, sf), splits, waves=splits)
    return rows


def storm_splits(spark: SparkSession, sf: str) -> int:
    """Splits of the scan behind the storm stand-in; few of them are spread over the cores before typing."""
    return input_splits(spark, f"{sf}/orders.parquet")


def storm_table(spark: SparkSession, sf: str) -> DataFrame:
    """Storm rows with lake partition columns year/month."""
    s = storms(spark, sf)
    return s.select(
        "EVENT_ID",
        "EVENT_TYPE",
        "STATE",
        "DAMAGE_PROPERTY",
        "BEGIN_DATE_TIME",
        F.col("YEAR").cast("int").alias("year"),
        (F.col("BEGIN_YEARMONTH") % 100).cast("int").alias("month"),
    )


def _rounded_metrics(df: DataFrame) -> DataFrame:
    return df.select(
        *[r6(c).alias(c) if not c.endswith("_count") and c in METRIC_COLS else F.col(c) for c in df.columns]
    )


# ---------------------------------------------------------------- queries
def q_haversine_pairs(spark, sf):
    """Distance from each line item's customer ZIP to its supplier's station."""
    li = derived.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    o = derived.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    z = derived.zipcodes(spark, sf, with_key=True).select("c_custkey", "GEOID", "INTPTLAT", "INTPTLONG")
    s = derived.stations(spark, sf, with_key=True).select("s_suppkey", "id", "latitude", "longitude")
    j = (
        li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(z, F.col("o_custkey") == F.col("c_custkey"))
        .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    return j.select(
        "l_orderkey",
        "l_linenumber",
        F.col("GEOID").alias("zipcode"),
        F.col("id").alias("station_id"),
        r6(haversine_miles("INTPTLAT", "INTPTLONG", "latitude", "longitude")).alias("distance_miles"),
    )


def q_nearest_k_stations(spark, sf):
    return link_rows(spark, sf).withColumn("distance_miles", r6("distance_miles"))


def q_nearest_two_pass(spark, sf):
    """The same links by the two-pass search, its first pass stored."""
    zips, stns = zipcode_points(derived.zipcodes(spark, sf)), station_points(derived.stations(spark, sf))
    first = stored(first_pass(zips, stns, K_NEAREST, FIRST_PASS_MILES, BOX_DEG), "links-first")
    return second_pass(first, zips, stns, K_NEAREST, LINK_MAX_MILES, BOX_DEG).withColumn("distance_miles", r6("distance_miles"))


def q_nearest_k_within(spark, sf):
    return near(spark, sf).withColumn("distance_miles", r6("distance_miles"))


def q_station_sample(spark, sf):
    return preview(link_rows(spark, sf), ["zipcode", "rank"], 5).withColumn("distance_miles", r6("distance_miles"))


def q_link_readings(spark, sf):
    return readings(obs_in_range(spark, sf), near(spark, sf)).withColumn("distance_miles", r6("distance_miles"))


def q_element_stats_long(spark, sf):
    st = element_stats_long(readings(obs_in_range(spark, sf), near(spark, sf), by_place=True))
    return st.select("zipcode", "date", "element", r6("mean").alias("mean"), "readings",
                     r6("spread").alias("spread"))


def q_element_stats_wide(spark, sf):
    return _rounded_metrics(element_stats_wide(readings(obs_in_range(spark, sf), near(spark, sf), by_place=True)))


def q_zip_date_spine(spark, sf):
    return zip_date_spine(near(spark, sf), obs_in_range(spark, sf))


def q_daily_metrics(spark, sf):
    return _rounded_metrics(metrics(spark, sf))


def q_coverage_report(spark, sf):
    return coverage(metrics(spark, sf))


def q_resume_date(spark, sf):
    return metrics(spark, sf).agg(F.coalesce(F.max("date"), F.lit("1900-01-01").cast("date")).alias("resume_date"))


def q_storm_high_water_mark(spark, sf):
    s = storms(spark, sf)
    return s.agg(F.max("BEGIN_YEARMONTH").alias("max_yearmonth")).select(
        "max_yearmonth", F.expr("max_yearmonth div 100").alias("watermark_year")
    )


def q_obs_high_water_mark(spark, sf):
    o = derived.observations(spark, sf)
    return o.agg(F.max("date").alias("max_date")).select("max_date", F.year("max_date").alias("watermark_year"))


def q_damage_to_dollars(spark, sf):
    d = derived.damage_texts(spark, sf)
    return d.select("p_partkey", "damage_text", damage_to_dollars("damage_text").alias("damage_dollars"))


def q_event_timestamps(spark, sf):
    raw = derived.storm_raw(spark, sf)
    ym, day, hhmm = text_to_long("BEGIN_YEARMONTH"), text_to_long("BEGIN_DAY"), text_to_long("BEGIN_TIME")
    return raw.select(
        text_to_long("EVENT_ID").alias("EVENT_ID"),
        ym.alias("BEGIN_YEARMONTH"),
        day.alias("BEGIN_DAY"),
        hhmm.alias("BEGIN_TIME"),
        parts_to_timestamp(ym, day, hhmm).alias("BEGIN_DATE_TIME"),
    )


def q_magnitude_round(spark, sf):
    li = derived.table(spark, sf, "lineitem")
    raw = F.col("l_quantity") / F.lit(4.0)
    return li.select("l_orderkey", "l_linenumber", raw.alias("magnitude_raw"),
                     round_half_even_to_long(raw).alias("magnitude"))


def q_fixed_width_parse(spark, sf):
    return parse_station_lines(derived.station_lines(spark, sf))


def q_csv_text_parse(spark, sf):
    return parse_observation_lines(derived.observation_lines(spark, sf))


def q_tsv_text_parse(spark, sf):
    return parse_zipcode_lines(derived.zipcode_lines(spark, sf))


def _storm_split(spark, sf):
    s = storms(spark, sf).select("EVENT_ID", "YEAR", "EVENT_TYPE", "DAMAGE_PROPERTY", "BEGIN_DATE_TIME", "DATA_SOURCE")
    s = stored(s, "storm-split")
    existing = s.where(F.col("DATA_SOURCE") == "F").drop("DATA_SOURCE")
    incoming = s.where(F.col("DATA_SOURCE") != "F").drop("DATA_SOURCE")
    return existing, incoming


def q_replace_latest_year(spark, sf):
    existing, incoming = _storm_split(spark, sf)
    return replace_newest_year(existing, incoming, "YEAR")


def q_refresh_audit(spark, sf):
    existing, incoming = _storm_split(spark, sf)
    return refresh_audit(existing, incoming, "YEAR")


def q_replace_date_range(spark, sf):
    lk = links(spark, sf)
    old = metrics(spark, sf, lk=lk)
    new = metrics(spark, sf, RANGE_MIN, RANGE_MAX, max_miles=RANGE_MAX_MILES, lk=lk)
    return _rounded_metrics(replace_date_range(old, new, RANGE_MIN, RANGE_MAX))


def q_partition_values(spark, sf):
    return partition_values(storm_table(spark, sf), ["year", "month"])


def q_filtered_export_rows(spark, sf):
    rows = filter_rows(storm_table(spark, sf), EXPORT_WHERE)
    return rows.where(F.col("year") == EXPORT_YEAR).select("EVENT_ID", "EVENT_TYPE", "STATE", "year", "month")


def q_file_year_filter(spark, sf):
    names = derived.storm_file_names(spark, sf)
    return annotate_storm_files(names, since_year=SINCE_YEAR, latest_stamp_only=True)


def q_lake_roundtrip(spark, sf):
    path = scratch_path(spark, "lake-roundtrip")
    export_parquet(storm_table(spark, sf), path, partition_by=("year", "month"))
    return lake_view(spark, path)


def q_replace_years_table(spark, sf):
    """A stored table after the physical refresh of two years by rows of all years."""
    path = scratch_path(spark, "years-table")
    s = stored(storms(spark, sf).select("EVENT_ID", "EVENT_TYPE", "STATE", "DATA_SOURCE", "YEAR"), "storm-years")
    s.where(F.col("DATA_SOURCE") == "F").write.partitionBy("YEAR").parquet(path)
    replace_years(spark, s.where(F.col("DATA_SOURCE") != "F"), path, "YEAR", RELOADED_YEARS)
    return spark.read.schema(s.schema).parquet(path).select("EVENT_ID", "EVENT_TYPE", "STATE", "DATA_SOURCE", "YEAR")


def q_replace_range_table(spark, sf):
    """A stored table of orders after the physical replacement of a date range over four months."""
    path = scratch_path(spark, "range-table")
    d = F.col("o_orderdate").cast("date")
    o = derived.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", d.alias("date"), F.year(d).alias("year"), F.month(d).alias("month")
    )
    o.where(F.col("o_orderstatus") == "F").write.partitionBy("year", "month").parquet(path)
    refresh_range(spark, o.where(F.col("o_orderstatus") != "F"), path, *TABLE_RANGE)
    return spark.read.schema(o.schema).parquet(path).select("o_orderkey", "o_orderstatus", "date", "year", "month")


def q_storm_files(spark, sf):
    """Storm rows written as CSV files of three layouts (one with short lines) and read by header name."""
    raw = derived.storm_raw(spark, sf).select("EVENT_ID", "STATE", "YEAR", "EVENT_TYPE", "TOR_LENGTH", "MAGNITUDE")
    key = F.col("EVENT_ID").cast("long")
    folder = scratch_path(spark, "storm-files")
    layouts = {0: raw.columns, 1: [c for c in reversed(raw.columns) if c != "TOR_LENGTH"]}
    for kind, columns in layouts.items():
        raw.where(key % 3 == kind).select(*columns).coalesce(2).write.option("header", True).csv(f"{folder}/{kind}")
    line = F.when(key % 5 == 0, F.concat_ws(",", "EVENT_ID", "STATE")).otherwise(F.concat_ws(",", "EVENT_ID", "STATE", "YEAR"))
    short = raw.where(key % 3 == 2).select(line.alias("EVENT_ID,STATE,YEAR"))
    short.coalesce(2).write.options(header=True, sep="\u0001", quote="\u0000").csv(f"{folder}/2")
    paths = [r.path for k in range(3) for r in list_files(spark, f"{folder}/{k}", "*.csv").collect()]
    rows = read_storm_files(spark, paths)
    return rows.select("EVENT_ID", "STATE", "YEAR", "EVENT_TYPE", "TOR_LENGTH", "MAGNITUDE", F.col(CORRUPT).isNotNull().alias("malformed"))


def q_observation_files(spark, sf):
    """Observation file names with their year and whether a refresh from a year on selects them."""
    d = derived.table(spark, sf, "orders").select(F.year("o_orderdate").alias("y"), "o_orderkey")
    names = d.select(F.concat(F.col("y").cast("string"), F.when(F.col("o_orderkey") % 7 == 0, F.lit("x")).otherwise(F.lit("")), F.lit(".csv.gz")).alias("name"))
    return annotate_observation_files(names.distinct(), SINCE_YEAR, SINCE_YEAR - 2)


def q_inventory_parse(spark, sf):
    """Inventory lines written in the fixed layout and parsed."""
    i = element_inventory(derived.observations(spark, sf), derived.stations(spark, sf)).where("latitude IS NOT NULL")
    line = F.concat_ws(
        " ", F.rpad("id", 11, " "), F.format_string("%8.4f", "latitude"), F.format_string("%9.4f", "longitude"),
        "element", F.format_string("%4d", "firstyear"), F.format_string("%4d", "lastyear"),
    )
    return parse_inventory_lines(i.select(line.alias("value")))


def q_station_names(spark, sf):
    """Stations with the names of their country and state codes, taken from nations and regions."""
    n = derived.table(spark, sf, "nation")
    code = F.concat(F.char(F.lit(65) + F.col("n_nationkey") % 26), F.char(F.lit(65) + F.col("n_nationkey") % 26))
    states = n.where("n_nationkey % 5 <> 0").select(code.alias("code"), F.col("n_name").alias("name"))
    countries = derived.table(spark, sf, "region").where("r_regionkey = 0").select(F.lit("US").alias("code"), F.col("r_name").alias("name"))
    out = name_station_codes(derived.stations(spark, sf), countries, states)
    return out.select("id", "country_code", "network_code", "country_name", "state", "state_name")


def q_storm_normalise(spark, sf):
    return storms(spark, sf)


def q_storm_issues(spark, sf):
    splits = storm_splits(spark, sf)
    _, issues = normalise_storms(derived.storm_raw(spark, sf), splits, waves=splits)
    return issues


def q_dly_parse(spark, sf):
    return parse_dly_lines(derived.dly_lines(spark, sf))


def q_element_inventory(spark, sf):
    return element_inventory(derived.observations(spark, sf), derived.stations(spark, sf))


def q_source_priority_pick(spark, sf):
    return pick_by_source_priority(derived.observations(spark, sf))


def q_flag_decode(spark, sf):
    return decode_flags(derived.observations(spark, sf))


def q_flag_summary(spark, sf):
    return flag_summary(derived.observations(spark, sf))


def q_station_codes(spark, sf):
    return station_codes(derived.stations(spark, sf)).select("id", "country_code", "network_code")


def q_listing_changes(spark, sf):
    """Observation files that a refresh reloads, by comparing two listings."""
    found = annotate_observation_files(listing_changes(*derived.file_listings(spark, sf)), SINCE_YEAR - 3)
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("before_modified", "after_modified")})


def q_station_day_moments(spark, sf):
    """Moments of all observations, merged from those of two halves."""
    return merge_moments(*(station_day_moments(o) for o in derived.observation_halves(spark, sf)))


def q_daily_metrics_merged(spark, sf):
    """Daily metrics from the stored moments of two halves of the observations."""
    halves = [stored(station_day_moments(o), "moments") for o in derived.observation_halves(spark, sf)]
    moments = stored(merge_moments(*halves), "moments-merged")
    return _rounded_metrics(metrics_from_moments(moments, links(spark, sf), MIN_DATE, MAX_DATE, METRIC_MAX_MILES))


def q_links_refreshed(spark, sf):
    """The links after stations and ZIPs were added, moved and removed, refreshed from those of before."""
    zips, stns = zipcode_points(derived.zipcodes(spark, sf)), station_points(derived.stations(spark, sf))
    old_zips, old_stns = derived.earlier_zipcode_points(zips), derived.earlier_station_points(stns)
    first = nearest_stations(old_zips, old_stns, K_NEAREST, LINK_MAX_MILES, BOX_DEG)
    fresh = refresh_links(stored(first, "links-before"), (old_zips, zips), (old_stns, stns), K_NEAREST, LINK_MAX_MILES, BOX_DEG)
    return fresh.withColumn("distance_miles", r6("distance_miles"))


def q_nearest_on_sphere(spark, sf):
    """Nearest stations of points spread over the whole globe, the poles and the 180th meridian included."""
    zips, stns = derived.globe_points(spark, sf)
    return nearest_stations_on_sphere(zips, stns, SPHERE_K, SPHERE_MILES).withColumn("distance_miles", r6("distance_miles"))


def q_inventory_reconciled(spark, sf):
    """An inventory published earlier against the recomputed one."""
    obs, stns = derived.observations(spark, sf), derived.stations(spark, sf)
    published = element_inventory(derived.published_observations(spark, sf), stns)
    return reconcile_inventory(published, element_inventory(obs, stns))


def q_resume_from_table(spark, sf):
    """Where an incremental run over the stored daily metrics starts: only the newest month's folder is read."""
    path = scratch_path(spark, "metrics-table")
    metrics(spark, sf).write.partitionBy("year", "month").parquet(path)
    return spark.createDataFrame([(resume_from(spark, path),)], "resume_date date")


def q_clustered_export(spark, sf):
    """Orders exported in ranges of customers and read back for a few of them: statistics skip the other row groups."""
    path = scratch_path(spark, "clustered")
    o = derived.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("year"))
    export_parquet(o, path, partition_by=("year",), rows_per_group=CLUSTER_GROUP, cluster_by=("o_custkey", "o_orderkey"))
    back = lake_view(spark, path)
    return back.where(F.col("o_custkey").between(*CLUSTER_RANGE)).select("o_orderkey", "o_custkey", "o_orderstatus", F.col("year").cast("int").alias("year"))


def _named_orders(spark, sf) -> str:
    """Orders in a partitioned folder under a name of the catalog."""
    path, name = scratch_path(spark, "named"), f"orders_{uuid.uuid4().hex[:12]}"
    o = derived.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    o.hint("rebalance", "year").write.partitionBy("year").parquet(path)
    register_table(spark, name, path, o.schema, ("year",))
    return name


def q_named_table(spark, sf):
    """A table read by its name."""
    return open_table(spark, _named_orders(spark, sf)).groupBy("year").agg(F.count(F.lit(1)).alias("orders"), F.max("o_orderkey").alias("newest"))


def q_described_table(spark, sf):
    """The columns of a named table as the catalog describes them."""
    name = _named_orders(spark, sf)
    found = describe_table(spark, name)
    drop_table(spark, name)
    return found


def q_footer_extremes(spark, sf):
    """Rows and extremes of a stored table, from Parquet footers alone."""
    aggs = [F.count(F.lit(1)).alias("orders"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"), F.max("o_custkey").alias("last_customer")]
    row = from_footers(spark, f"{sf}/orders.parquet", aggs).first()
    return spark.createDataFrame([tuple(row)], "orders bigint, first_key bigint, last_key bigint, last_customer bigint")


def q_load_audit(spark, sf):
    """Figures of two audited refreshes of a stored table, the second beside the first."""
    path, audit = scratch_path(spark, "audited"), scratch_path(spark, "audit")
    o = derived.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year"))
    for status, years in (("F", RELOADED_YEARS), ("O", RELOADED_YEARS[1:])):
        rows = o.where(F.col("o_orderstatus") == status)
        audited(spark, audit, "refresh", "orders", lambda rows=rows, years=years: replace_years(spark, rows, path, "year", years))
    return run_history(spark.read.parquet(audit))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "haversine_pairs": q_haversine_pairs,
    "nearest_k_stations": q_nearest_k_stations,
    "nearest_two_pass": q_nearest_two_pass,
    "nearest_k_within": q_nearest_k_within,
    "station_sample": q_station_sample,
    "link_readings": q_link_readings,
    "element_stats_long": q_element_stats_long,
    "element_stats_wide": q_element_stats_wide,
    "zip_date_spine": q_zip_date_spine,
    "daily_metrics": q_daily_metrics,
    "coverage_report": q_coverage_report,
    "resume_date": q_resume_date,
    "storm_high_water_mark": q_storm_high_water_mark,
    "obs_high_water_mark": q_obs_high_water_mark,
    "damage_to_dollars": q_damage_to_dollars,
    "event_timestamps": q_event_timestamps,
    "magnitude_round": q_magnitude_round,
    "fixed_width_parse": q_fixed_width_parse,
    "csv_text_parse": q_csv_text_parse,
    "tsv_text_parse": q_tsv_text_parse,
    "replace_latest_year": q_replace_latest_year,
    "refresh_audit": q_refresh_audit,
    "replace_date_range": q_replace_date_range,
    "partition_values": q_partition_values,
    "filtered_export_rows": q_filtered_export_rows,
    "file_year_filter": q_file_year_filter,
    "lake_roundtrip": q_lake_roundtrip,
    "storm_normalise": q_storm_normalise,
    "storm_issues": q_storm_issues,
    "replace_years_table": q_replace_years_table,
    "replace_range_table": q_replace_range_table,
    "storm_files": q_storm_files,
    "observation_files": q_observation_files,
    "inventory_parse": q_inventory_parse,
    "station_names": q_station_names,
    "dly_parse": q_dly_parse,
    "element_inventory": q_element_inventory,
    "source_priority_pick": q_source_priority_pick,
    "station_codes": q_station_codes,
    "flag_summary": q_flag_summary,
    "flag_decode": q_flag_decode,
    "listing_changes": q_listing_changes,
    "station_day_moments": q_station_day_moments,
    "daily_metrics_merged": q_daily_metrics_merged,
    "links_refreshed": q_links_refreshed,
    "nearest_on_sphere": q_nearest_on_sphere,
    "inventory_reconciled": q_inventory_reconciled,
    "resume_from_table": q_resume_from_table,
    "clustered_export": q_clustered_export,
    "named_table": q_named_table,
    "described_table": q_described_table,
    "footer_extremes": q_footer_extremes,
    "load_audit": q_load_audit,
}
