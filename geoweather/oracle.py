"""DuckDB SQL for every registered query, written independently of the Spark plans.

The stand-in CTEs mirror ``geoweather.derived`` with the same integer arithmetic.
Where the Spark plan uses a grid join or a union-aggregate, the SQL states the
plain definition (range join, cross-join spine + left join), so the pair checks
the rewrite.  Floating aggregates and distances are rounded to 6 digits on both
sides; counts and ranks are cast to the Spark integer types.
"""

from __future__ import annotations

from geoweather.derived import NAMED_STORM_COLUMNS
from geoweather.schemas import STORM_EVENTS

# ---------------------------------------------------------------- stand-in inputs
ZIPCODES = """
zipcodes AS (
  SELECT c_custkey, printf('%05d', c_custkey) AS GEOID,
         c_custkey * 1000 AS ALAND,
         c_custkey * 10 AS AWATER,
         c_acctbal AS ALAND_SQMI,
         CAST(c_custkey % 100 AS DOUBLE) / 100.0 AS AWATER_SQMI,
         25.0 + CAST((c_custkey * 7919) % 2400 AS DOUBLE) / 100.0 AS INTPTLAT,
         -124.0 + CAST((c_custkey * 104729) % 5700 AS DOUBLE) / 100.0 AS INTPTLONG
  FROM customer)"""

STATIONS = """
stations AS (
  SELECT s_suppkey, printf('US%09d', s_suppkey) AS id,
         CASE WHEN s_suppkey % 37 = 36 THEN NULL
              ELSE 25.0 + CAST((s_suppkey * 7907) % 2400 AS DOUBLE) / 100.0 END AS latitude,
         -124.0 + CAST((s_suppkey * 104723) % 5700 AS DOUBLE) / 100.0 AS longitude,
         CASE WHEN s_suppkey % 11 = 10 THEN CAST(-999.9 AS DOUBLE)
              ELSE CAST((s_suppkey * 31) % 30000 AS DOUBLE) / 10.0 END AS elevation,
         CASE WHEN s_nationkey % 5 = 0 THEN '  '
              ELSE chr(CAST(65 + s_nationkey % 26 AS INTEGER)) || chr(CAST(65 + s_suppkey % 26 AS INTEGER)) END AS state,
         s_name AS name,
         CASE WHEN s_suppkey % 4 = 0 THEN 'GSN' ELSE '   ' END AS gsn_flag,
         CASE WHEN s_suppkey % 3 = 0 THEN 'HCN' WHEN s_suppkey % 3 = 1 THEN 'CRN' ELSE '   ' END AS hcn_crn_flag,
         CASE WHEN s_suppkey % 5 = 0 THEN printf('%05d', (s_suppkey * 13) % 100000) ELSE '     ' END AS wmo_id
  FROM supplier)"""

OBSERVATIONS = """
observations AS (
  SELECT printf('US%09d', user_id) AS id,
         CAST(ts AS DATE) AS date,
         CASE WHEN event_id % 23 = 0 THEN 'WT01'
              WHEN event_type = 'view' THEN 'PRCP'
              WHEN event_type = 'click' THEN 'SNOW'
              WHEN event_type = 'purchase' THEN 'SNWD'
              WHEN event_type = 'signup' THEN 'TMAX'
              WHEN event_type = 'error' THEN 'TMIN' END AS element,
         CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(round(value) AS INTEGER) END AS data_value,
         CASE WHEN event_id % 13 = 0 THEN 'T' END AS m_flag,
         CASE WHEN event_id % 17 = 0 THEN 'X' END AS q_flag,
         CASE WHEN event_id % 3 = 0 THEN 'W' WHEN event_id % 3 = 1 THEN '7' ELSE 'S' END AS s_flag,
         CASE WHEN event_id % 5 = 0 THEN NULL
              ELSE lpad(CAST(hour(ts) * 100 + minute(ts) AS VARCHAR), 4, '0') END AS obs_time,
         CAST(year(CAST(ts AS DATE)) AS INTEGER) AS year
  FROM events)"""

# Storm columns that the stand-in fills by rule: (name, kind).
FILLED = [
    (f.name, {"bigint": "long", "double": "double"}.get(f.dataType.simpleString(), "text"))
    for f in STORM_EVENTS.fields if f.name not in NAMED_STORM_COLUMNS
]

STORM_RAW = """
storm_raw AS (
  SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS VARCHAR) AS BEGIN_YEARMONTH,
         CAST(day(o_orderdate) + CASE WHEN o_orderkey % 97 = 0 THEN 30 ELSE 0 END AS VARCHAR) AS BEGIN_DAY,
         CAST((o_orderkey % 25) * 100 + o_orderkey % 60 AS VARCHAR) AS BEGIN_TIME,
         CAST(year(o_orderdate) * 100 + month(o_orderdate) AS VARCHAR) AS END_YEARMONTH,
         CAST(day(o_orderdate) AS VARCHAR) AS END_DAY,
         CAST((o_orderkey % 24) * 100 + 59 AS VARCHAR) AS END_TIME,
         CAST(o_custkey AS VARCHAR) AS EPISODE_ID,
         CAST(o_orderkey AS VARCHAR) AS EVENT_ID,
         o_orderpriority AS STATE,
         CASE WHEN o_orderkey % 103 = 0 THEN 'X' ELSE '' END || CAST(o_custkey % 56 AS VARCHAR) AS STATE_FIPS,
         CAST(year(o_orderdate) AS VARCHAR) AS YEAR,
         monthname(o_orderdate) AS MONTH_NAME,
         CASE WHEN o_orderstatus = 'F' THEN 'Hail' WHEN o_orderstatus = 'O' THEN 'Tornado' ELSE 'Flood' END AS EVENT_TYPE,
         CASE WHEN o_orderkey % 101 = 0 THEN 'AB' ELSE '' END || CAST(o_custkey % 100 AS VARCHAR) ||
           CASE WHEN o_orderkey % 6 = 0 THEN 'K' WHEN o_orderkey % 6 = 1 THEN 'M' WHEN o_orderkey % 6 = 2 THEN 'B'
                WHEN o_orderkey % 6 = 3 THEN '' WHEN o_orderkey % 6 = 4 THEN '.50K' ELSE 'H' END AS DAMAGE_PROPERTY,
         CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN '0.00K'
              ELSE CAST(o_custkey % 7 AS VARCHAR) || 'k' END AS DAMAGE_CROPS,
         CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN CAST(o_custkey % 90 AS VARCHAR)
              ELSE CAST((o_custkey % 12) // 4 AS VARCHAR) || '.' ||
                   CASE WHEN o_custkey % 4 = 0 THEN '00' WHEN o_custkey % 4 = 1 THEN '25'
                        WHEN o_custkey % 4 = 2 THEN '50' ELSE '75' END END AS MAGNITUDE,
         CAST(o_orderkey % 100 AS VARCHAR) || '.5' AS TOR_LENGTH,
         o_orderstatus AS DATA_SOURCE{filled}
  FROM orders)""".replace("{filled}", "".join(
    ",\n         " + (
        f"CAST((o_orderkey + {i}) % {7 + i} AS VARCHAR)" if kind == "long"
        else f"CAST((o_custkey + {i}) % {50 + i} AS VARCHAR) || '.25'" if kind == "double"
        else f"CASE WHEN o_orderkey % {5 + i % 7} = 0 THEN NULL ELSE '{name} ' || CAST(o_custkey % {3 + i} AS VARCHAR) END"
    ) + f" AS {name}"
    for i, (name, kind) in enumerate(FILLED)
))

DAMAGE_TEXTS = """
damage_texts AS (
  SELECT p_partkey,
         CASE WHEN p_partkey % 10 = 0 THEN CAST(p_size AS VARCHAR) || 'K'
              WHEN p_partkey % 10 = 1 THEN CAST(p_size AS VARCHAR) || '.5M'
              WHEN p_partkey % 10 = 2 THEN CAST(p_size AS VARCHAR) || 'b'
              WHEN p_partkey % 10 = 3 THEN CAST(p_size AS VARCHAR)
              WHEN p_partkey % 10 = 4 THEN CAST(p_size AS VARCHAR) || 'H'
              WHEN p_partkey % 10 = 5 THEN ''
              WHEN p_partkey % 10 = 6 THEN NULL
              WHEN p_partkey % 10 = 7 THEN 'K'
              WHEN p_partkey % 10 = 8 THEN '1E' || CAST(p_size % 3 AS VARCHAR) || 'K'
              ELSE CAST(p_size AS VARCHAR) || 'KK' END AS damage_text
  FROM part)"""


# ---------------------------------------------------------------- rule macros
def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * 3956 * asin(sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)))"
    )


def dollars(t: str) -> str:
    """Amount before a K/M/B suffix times 1000 to the suffix's place in 'KMB'; plain numbers as they are, else 0."""
    suffix = f"right(upper({t}), 1)"
    place = f"strpos('KMB', {suffix})"
    amount = f"nullif(translate(upper({t}), {suffix}, ''), '')"
    scaled = f"if({amount} IS NULL, 0.0, TRY_CAST({amount} AS DOUBLE) * pow(1000, {place}))"
    return f"if(coalesce({t}, '') = '', 0.0, if({place} > 0, {scaled}, ifnull(TRY_CAST({t} AS DOUBLE), 0.0)))"


def parts_ts(ym: str, day: str, hhmm: str) -> str:
    """The wall-clock time if all parts lie in their calendar ranges."""
    y, m, h, mi = f"{ym} // 100", f"{ym} % 100", f"{hhmm} // 100", f"{hhmm} % 100"
    in_month = f"{day} BETWEEN 1 AND day(last_day(make_date({y}, {m}, 1)))"
    ok = f"if({ym} BETWEEN 100000 AND 999999 AND {m} BETWEEN 1 AND 12, {in_month}, false)"
    ok += f" AND {hhmm} >= 0 AND {h} < 24 AND {mi} < 60"
    return f"if({ok}, make_timestamp({y}, {m}, {day}, {h}, {mi}, 0), NULL)"


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


# ---------------------------------------------------------------- derived relations
# The 20 nearest of a ZIP: its stations in reach, sorted in a list and cut.
LINKS = """
reach AS (
  SELECT zipcodes.GEOID AS zip, INTPTLAT AS zlat, INTPTLONG AS zlon, stations.id, name, latitude, longitude, %s AS miles
  FROM zipcodes, stations
  WHERE latitude BETWEEN INTPTLAT - 5 AND INTPTLAT + 5 AND longitude BETWEEN INTPTLONG - 5 AND INTPTLONG + 5),
closest AS (
  SELECT zip, any_value(zlat) AS zlat, any_value(zlon) AS zlon,
         list({'miles': miles, 'id': id, 'name': name, 'lat': latitude, 'lon': longitude} ORDER BY miles, id)[1:20] AS found
  FROM reach WHERE miles <= 200 GROUP BY zip),
links AS (
  SELECT zip AS zipcode, s.id AS station_id, s.name AS station_name, s.lat AS station_latitude, s.lon AS station_longitude,
         zlat AS zipcode_latitude, zlon AS zipcode_longitude, s.miles AS distance_miles, CAST(place AS INTEGER) AS rank
  FROM (SELECT zip, zlat, zlon, unnest(found) AS s, generate_subscripts(found, 1) AS place FROM closest))""" % haversine(
    "INTPTLAT", "INTPTLONG", "latitude", "longitude"
)


ELEMENTS = ("PRCP", "SNOW", "SNWD", "TMAX", "TMIN")
MIN_DATE, MAX_DATE = "2024-01-01", "2024-12-31"
RANGE_MIN, RANGE_MAX = "2024-01-10", "2024-01-20"


def summaries(value: str, element: str) -> list[str]:
    """Mean, readings and sample deviation of one element's readings, as filtered aggregates."""
    only, m = f"FILTER (WHERE element = '{element}')", element.lower()
    return [
        f"avg({value}) {only} AS {m}",
        f"CAST(nullif(count(element) {only}, 0) AS INTEGER) AS {m}_count",
        f"stddev_samp({value}) {only} AS {m}_stddev",
    ]


def metric_ctes(p: str, max_miles: float, lo: str, hi: str) -> list[str]:
    """CTEs ``{p}ranged, {p}linked, {p}reads, {p}spine, {p}metrics`` (needs links, observations).

    A day of a ZIP is one group: its place in the calendar of observed days with whatever
    usable readings its linked stations have that day.
    """
    columns = ", ".join(c for e in ELEMENTS for c in summaries("data_value", e))
    return [
        f"\n{p}ranged AS (FROM observations WHERE date >= DATE '{lo}' AND date <= DATE '{hi}')",
        f"\n{p}linked AS (SELECT zipcode, station_id, distance_miles FROM links WHERE distance_miles <= {max_miles})",
        f"\n{p}reads AS (SELECT zipcode, date, element, data_value, distance_miles FROM {p}linked, {p}ranged "
        f"WHERE station_id = id AND q_flag IS NULL AND list_contains({list(ELEMENTS)}, element))",
        f"\n{p}spine AS (SELECT zipcode, unnest((SELECT list(DISTINCT date) FROM {p}ranged)) AS date "
        f"FROM (SELECT DISTINCT zipcode FROM {p}linked))",
        f"\n{p}metrics AS (SELECT zipcode, date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, "
        f"CAST(day(date) AS INTEGER) AS day, {columns} FROM {p}spine LEFT JOIN {p}reads USING (zipcode, date) GROUP BY zipcode, date)",
    ]


def rounded_metrics(rel: str) -> str:
    cols = ["zipcode", "date", "year", "month", "day"]
    for e in ELEMENTS:
        m = e.lower()
        cols += [f"round({m}, 6) AS {m}", f"{m}_count", f"round({m}_stddev, 6) AS {m}_stddev"]
    return f"SELECT {', '.join(cols)} FROM {rel}"


def rounded_wide() -> str:
    parts = [c for e in ELEMENTS for c in summaries("data_value", e)]
    cols = ", ".join(c if "_count" in c else f"round({c.rsplit(' AS ', 1)[0]}, 6) AS {c.rsplit(' AS ', 1)[1]}" for c in parts)
    return f"SELECT zipcode, date, {cols} FROM reads GROUP BY zipcode, date"


INT_TEXT = r"\s*[+-]?\d+\s*"


def tlong(x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({x}, '{INT_TEXT}') THEN TRY_CAST(trim({x}) AS BIGINT) "
        f"ELSE TRY_CAST(TRY_CAST({x} AS DOUBLE) AS BIGINT) END"
    )


# storm staging columns that are not text, in table order, with their kind
STORM_NUMERIC = tuple(
    (f.name, "damage" if f.name.startswith("DAMAGE_") else {"bigint": "long", "double": "double"}[f.dataType.simpleString()])
    for f in STORM_EVENTS.fields if f.dataType.simpleString() in ("bigint", "double")
)
STORM_TEXT = tuple(f.name for f in STORM_EVENTS.fields if f.dataType.simpleString() == "string")


def _typed_storm_col(name: str, kind: str) -> str:
    if kind == "damage":
        return dollars(name)
    if kind == "double":
        return f"TRY_CAST({name} AS DOUBLE)"
    return tlong(name)


def storm_typed_cte() -> str:
    typed = ", ".join(f"{_typed_storm_col(n, k)} AS {n}" for n, k in STORM_NUMERIC)
    raw = ", ".join(f"{n} AS raw_{n}" for n, _ in STORM_NUMERIC)
    t1 = (
        f"\nstorm_t1 AS (SELECT {typed}, {raw}, {', '.join(STORM_TEXT)} FROM storm_raw)"
    )
    rej = ", ".join(
        f"CASE WHEN raw_{n} IS NOT NULL AND trim(raw_{n}) <> '' AND {n} IS NULL THEN '{n}' END" for n, _ in STORM_NUMERIC
    )
    t2 = (
        "\nstorm_typed AS (SELECT *, "
        + parts_ts("BEGIN_YEARMONTH", "BEGIN_DAY", "BEGIN_TIME") + " AS BEGIN_DATE_TIME, "
        + parts_ts("END_YEARMONTH", "END_DAY", "END_TIME") + " AS END_DATE_TIME, "
        + f"concat_ws(',', {rej}) AS reject_reasons FROM storm_t1)"
    )
    t3 = (
        "\nstorms AS (SELECT * FROM storm_typed WHERE reject_reasons = '')"
    )
    return t1 + "," + t2 + "," + t3


STORMS = storm_typed_cte()
STORM_TABLE = """
storm_table AS (
  SELECT EVENT_ID, EVENT_TYPE, STATE, DAMAGE_PROPERTY, BEGIN_DATE_TIME,
         CAST(YEAR AS INTEGER) AS year, CAST(BEGIN_YEARMONTH % 100 AS INTEGER) AS month
  FROM storms)"""
STORM_SPLIT = """
storm_sel AS (SELECT EVENT_ID, YEAR, EVENT_TYPE, DAMAGE_PROPERTY, BEGIN_DATE_TIME, DATA_SOURCE FROM storms),
existing AS (SELECT EVENT_ID, YEAR, EVENT_TYPE, DAMAGE_PROPERTY, BEGIN_DATE_TIME FROM storm_sel WHERE DATA_SOURCE = 'F'),
incoming AS (SELECT EVENT_ID, YEAR, EVENT_TYPE, DAMAGE_PROPERTY, BEGIN_DATE_TIME FROM storm_sel WHERE DATA_SOURCE <> 'F'),
wm AS (SELECT max(YEAR) AS w FROM existing)"""

LINK_BASE = [ZIPCODES, STATIONS, LINKS]
METRIC_BASE = LINK_BASE + [OBSERVATIONS] + metric_ctes("", 20.0, MIN_DATE, MAX_DATE)
LINK_COLS = ("zipcode, station_id, station_name, station_latitude, station_longitude, "
             "zipcode_latitude, zipcode_longitude, round(distance_miles, 6) AS distance_miles, rank")


def _coverage() -> str:
    parts = [
        f"SELECT '{e.lower()}' AS metric, count(*) AS total, count({e.lower()}) AS with_data, "
        f"CAST(count({e.lower()}) AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(count(*) AS DOUBLE) AS percentage FROM metrics"
        for e in ELEMENTS
    ]
    return with_(*METRIC_BASE) + "\nUNION ALL\n".join(parts)


def _fixed_width() -> str:
    lines = (
        "\nlines AS (SELECT rpad(id, 11, ' ') || ' ' || COALESCE(printf('%8.4f', latitude), '        ') || ' ' || "
        "printf('%9.4f', longitude) || ' ' || printf('%6.1f', elevation) || ' ' || state || ' ' || "
        "rpad(name, 30, ' ') || ' ' || gsn_flag || ' ' || hcn_crn_flag || ' ' || wmo_id AS value FROM stations)"
    )
    return with_(STATIONS, lines) + (
        "SELECT substring(value, 1, 11) AS id, TRY_CAST(trim(substring(value, 13, 8)) AS DOUBLE) AS latitude, "
        "TRY_CAST(trim(substring(value, 22, 9)) AS DOUBLE) AS longitude, "
        "TRY_CAST(trim(substring(value, 32, 6)) AS DOUBLE) AS elevation, substring(value, 39, 2) AS state, "
        "trim(substring(value, 42, 30)) AS name, substring(value, 73, 3) AS gsn_flag, "
        "substring(value, 77, 3) AS hcn_crn_flag, substring(value, 81, 5) AS wmo_id FROM lines"
    )


def _csv_text() -> str:
    """Lines whose number leaves 1 to 5 at 41 are damaged: no date, an unreadable date or value, no station, no element."""
    pick = lambda col, kind, text, good: f"CASE WHEN n % 41 = {kind} THEN '{text}' ELSE {good} END AS {col}"
    return with_(OBSERVATIONS.replace("SELECT printf", "SELECT event_id AS n, printf", 1)) + (
        "SELECT nullif(id, '') AS id, date, nullif(element, '') AS element, "
        "TRY_CAST(value_text AS INTEGER) AS data_value, m_flag, q_flag, s_flag, obs_time, CAST(year(date) AS INTEGER) AS year, "
        "date IS NULL OR id = '' OR element = '' OR coalesce(value_text = '1x2', false) AS bad FROM (SELECT "
        + ", ".join([
            pick("id", 4, "", "id"), pick("element", 5, "", "element"), pick("value_text", 3, "1x2", "CAST(data_value AS VARCHAR)"),
            "CASE WHEN n % 41 IN (1, 2) THEN NULL ELSE date END AS date",
        ])
        + ", m_flag, q_flag, s_flag, obs_time FROM observations)"
    )


def _tsv_text() -> str:
    lines = (
        "\nlines AS (SELECT GEOID || chr(9) || CAST(ALAND AS VARCHAR) || chr(9) || CAST(AWATER AS VARCHAR) || chr(9) || "
        "printf('%.3f', ALAND_SQMI) || chr(9) || printf('%.3f', AWATER_SQMI) || chr(9) || "
        "printf('%.6f', INTPTLAT) || chr(9) || printf('%.6f', INTPTLONG) || '   ' AS value FROM zipcodes)"
    )
    f = [f"NULLIF(split_part(value, chr(9), {i}), '')" for i in range(1, 8)]
    return with_(ZIPCODES, lines) + (
        f"SELECT {f[0]} AS GEOID, TRY_CAST(trim({f[1]}) AS BIGINT) AS ALAND, TRY_CAST(trim({f[2]}) AS BIGINT) AS AWATER, "
        f"TRY_CAST(trim({f[3]}) AS DOUBLE) AS ALAND_SQMI, TRY_CAST(trim({f[4]}) AS DOUBLE) AS AWATER_SQMI, "
        f"TRY_CAST(trim({f[5]}) AS DOUBLE) AS INTPTLAT, TRY_CAST(trim({f[6]}) AS DOUBLE) AS INTPTLONG FROM lines"
    )


def _storm_issues() -> str:
    times = (
        "concat_ws(',', CASE WHEN BEGIN_YEARMONTH IS NOT NULL AND BEGIN_DAY IS NOT NULL AND BEGIN_TIME IS NOT NULL "
        "AND BEGIN_DATE_TIME IS NULL THEN 'BEGIN_DATE_TIME' END, "
        "CASE WHEN END_YEARMONTH IS NOT NULL AND END_DAY IS NOT NULL AND END_TIME IS NOT NULL "
        "AND END_DATE_TIME IS NULL THEN 'END_DATE_TIME' END)"
    )
    return with_(STORM_RAW, STORMS) + (
        f"SELECT EVENT_ID, YEAR, reject_reasons <> '' AS rejected, "
        f"concat_ws(',', NULLIF(reject_reasons, ''), NULLIF({times}, '')) AS reasons "
        f"FROM storm_typed WHERE reject_reasons <> '' OR {times} <> ''"
    )


ORACLE_SQL: dict[str, str] = {
    "haversine_pairs": with_(ZIPCODES, STATIONS) + (
        "SELECT l.l_orderkey, l.l_linenumber, z.GEOID AS zipcode, s.id AS station_id, round("
        + haversine("z.INTPTLAT", "z.INTPTLONG", "s.latitude", "s.longitude")
        + ", 6) AS distance_miles FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey "
        "JOIN zipcodes z ON o.o_custkey = z.c_custkey JOIN stations s ON l.l_suppkey = s.s_suppkey"
    ),
    "nearest_k_stations": with_(*LINK_BASE) + f"SELECT {LINK_COLS} FROM links",
    "nearest_two_pass": with_(*LINK_BASE) + f"SELECT {LINK_COLS} FROM links",
    "nearest_k_within": with_(*LINK_BASE) + f"SELECT {LINK_COLS} FROM links WHERE distance_miles <= 20.0",
    "station_sample": with_(*LINK_BASE) + f"SELECT {LINK_COLS} FROM links ORDER BY zipcode, rank LIMIT 5",
    "link_readings": with_(*METRIC_BASE)
    + "SELECT zipcode, date, element, data_value, round(distance_miles, 6) AS distance_miles FROM reads",
    "element_stats_long": with_(*METRIC_BASE)
    + "SELECT zipcode, date, element, round(avg(data_value), 6) AS mean, count(*) AS readings, "
    "round(stddev_samp(data_value), 6) AS spread FROM reads GROUP BY ALL",
    "element_stats_wide": with_(*METRIC_BASE) + rounded_wide(),
    "zip_date_spine": with_(*METRIC_BASE) + "SELECT zipcode, date FROM spine",
    "daily_metrics": with_(*METRIC_BASE) + rounded_metrics("metrics"),
    "coverage_report": _coverage(),
    "resume_date": with_(*METRIC_BASE) + "SELECT COALESCE(max(date), DATE '1900-01-01') AS resume_date FROM metrics",
    "storm_high_water_mark": with_(STORM_RAW, STORMS)
    + "SELECT max(BEGIN_YEARMONTH) AS max_yearmonth, max(BEGIN_YEARMONTH) // 100 AS watermark_year FROM storms",
    "obs_high_water_mark": with_(OBSERVATIONS)
    + "SELECT max(date) AS max_date, CAST(year(max(date)) AS INTEGER) AS watermark_year FROM observations",
    "damage_to_dollars": with_(DAMAGE_TEXTS)
    + f"SELECT p_partkey, damage_text, {dollars('damage_text')} AS damage_dollars FROM damage_texts",
    "event_timestamps": with_(STORM_RAW) + (
        f"SELECT EVENT_ID, BEGIN_YEARMONTH, BEGIN_DAY, BEGIN_TIME, "
        f"{parts_ts('BEGIN_YEARMONTH', 'BEGIN_DAY', 'BEGIN_TIME')} AS BEGIN_DATE_TIME FROM ("
        f"SELECT {tlong('EVENT_ID')} AS EVENT_ID, {tlong('BEGIN_YEARMONTH')} AS BEGIN_YEARMONTH, "
        f"{tlong('BEGIN_DAY')} AS BEGIN_DAY, {tlong('BEGIN_TIME')} AS BEGIN_TIME FROM storm_raw) t"
    ),
    "magnitude_round": "SELECT l_orderkey, l_linenumber, l_quantity / 4.0 AS magnitude_raw, "
    "CAST(l_quantity / 4.0 AS BIGINT) AS magnitude FROM lineitem",
    "fixed_width_parse": _fixed_width(),
    "csv_text_parse": _csv_text(),
    "tsv_text_parse": _tsv_text(),
    "replace_latest_year": with_(STORM_RAW, STORMS, STORM_SPLIT) + (
        "SELECT e.* FROM existing e, wm WHERE NOT COALESCE(e.YEAR = wm.w, false) "
        "UNION ALL SELECT i.* FROM incoming i, wm WHERE wm.w IS NULL OR COALESCE(i.YEAR >= wm.w, false)"
    ),
    "refresh_audit": with_(STORM_RAW, STORMS, STORM_SPLIT) + (
        "SELECT b.n AS rows_before, d.n AS rows_deleted, l.n AS rows_loaded, b.n - d.n + l.n AS rows_after FROM "
        "(SELECT count(*) AS n FROM existing) b, "
        "(SELECT count(*) AS n FROM existing, wm WHERE COALESCE(YEAR = wm.w, false)) d, "
        "(SELECT count(*) AS n FROM incoming, wm WHERE wm.w IS NULL OR COALESCE(YEAR >= wm.w, false)) l"
    ),
    "replace_date_range": with_(*(METRIC_BASE + metric_ctes("r_", 100.0, RANGE_MIN, RANGE_MAX))) + (
        "SELECT * FROM (" + rounded_metrics("metrics") + f" WHERE NOT (date BETWEEN DATE '{RANGE_MIN}' AND DATE '{RANGE_MAX}') "
        "UNION ALL " + rounded_metrics("r_metrics") + f" WHERE date BETWEEN DATE '{RANGE_MIN}' AND DATE '{RANGE_MAX}') u"
    ),
    "partition_values": with_(STORM_RAW, STORMS, STORM_TABLE)
    + "SELECT DISTINCT year, month FROM storm_table ORDER BY year, month",
    "filtered_export_rows": with_(STORM_RAW, STORMS, STORM_TABLE) + (
        "SELECT EVENT_ID, EVENT_TYPE, STATE, year, month FROM storm_table "
        "WHERE (EVENT_TYPE = 'Hail' OR STATE = '1-URGENT') AND year = 1996"
    ),
    "file_year_filter": (
        "WITH names AS (SELECT DISTINCT 'StormEvents_details-ftp_v1.0_d' || CAST(year(o_orderdate) AS VARCHAR) || '_c' "
        "|| strftime(o_orderdate, '%Y%m%d') || '.csv.gz' AS name FROM orders),\n"
        "ann AS (SELECT name, TRY_CAST(NULLIF(regexp_extract(name, '_d(\\d{4})_', 1), '') AS INTEGER) AS file_year, "
        "TRY_CAST(NULLIF(regexp_extract(name, '_c(\\d{8})', 1), '') AS INTEGER) AS stamp FROM names),\n"
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY file_year ORDER BY stamp DESC NULLS LAST, name DESC) AS rn "
        "FROM ann)\n"
        "SELECT name, file_year, stamp, (file_year IS NOT NULL AND file_year >= 1997 AND (file_year IS NULL OR rn = 1)) "
        "AS selected FROM ranked"
    ),
    "lake_roundtrip": with_(STORM_RAW, STORMS, STORM_TABLE) + "SELECT * FROM storm_table",
    "storm_normalise": with_(STORM_RAW, STORMS) + f"SELECT {', '.join(STORM_EVENTS.fieldNames())} FROM storms",
    "storm_issues": _storm_issues(),
}


def _dly() -> str:
    block = (
        "COALESCE(lpad(CAST(data_value AS VARCHAR), 5, ' '), '-9999') || COALESCE(m_flag, ' ') || "
        "COALESCE(q_flag, ' ') || COALESCE(s_flag, ' ')"
    )
    per_day = ", ".join(
        f"max(CASE WHEN day(date) = {d} THEN {block} END) AS d{d}" for d in range(1, 32)
    )
    line = " || ".join(["id", "printf('%04d', y)", "printf('%02d', m)", "element"]
                       + [f"COALESCE(d{d}, '-9999   ')" for d in range(1, 32)])
    months = (
        f"\nmonths AS (SELECT id, year(date) AS y, month(date) AS m, element, {per_day} "
        f"FROM picked GROUP BY id, year(date), month(date), element)"
    )
    lines = f"\nlines AS (SELECT {line} AS value FROM months)"
    blocks = (
        "\nblocks AS (SELECT substring(value, 1, 11) AS id, TRY_CAST(substring(value, 12, 4) AS INTEGER) AS y, "
        "TRY_CAST(substring(value, 16, 2) AS INTEGER) AS m, substring(value, 18, 4) AS element, d.day, "
        "trim(substring(value, 22 + (d.day - 1) * 8, 5)) AS raw_value, "
        "NULLIF(substring(value, 27 + (d.day - 1) * 8, 1), ' ') AS m_flag, "
        "NULLIF(substring(value, 28 + (d.day - 1) * 8, 1), ' ') AS q_flag, "
        "NULLIF(substring(value, 29 + (d.day - 1) * 8, 1), ' ') AS s_flag "
        "FROM lines CROSS JOIN range(1, 32) d(day))"
    )
    picked = f"\npicked AS ({_picked_rows()})"
    return with_(OBSERVATIONS, picked, months, lines, blocks) + (
        "SELECT id, CAST(try_strptime(printf('%04d-%02d-%02d', y, m, day), '%Y-%m-%d') AS DATE) AS date, element, "
        "TRY_CAST(raw_value AS INTEGER) AS data_value, m_flag, q_flag, s_flag, CAST(NULL AS VARCHAR) AS obs_time, "
        "y AS year FROM blocks WHERE TRY_CAST(raw_value AS INTEGER) IS NULL OR TRY_CAST(raw_value AS INTEGER) <> -9999"
    )


# Source flags by priority.
SOURCE_PRIORITY = "Z,R,D,0,6,C,X,W,K,7,F,B,M,f,m,r,E,z,u,b,s,a,G,Q,I,A,N,T,U,H,S".split(",")


def _picked_rows() -> str:
    prio = ", ".join(f"'{x}'" for x in SOURCE_PRIORITY)
    rank = f"COALESCE(list_position([{prio}], s_flag) - 1, {len(SOURCE_PRIORITY)})"
    return (
        "SELECT id, date, element, data_value, m_flag, q_flag, s_flag, obs_time, year FROM observations "
        f"QUALIFY row_number() OVER (PARTITION BY id, date, element ORDER BY {rank} NULLS FIRST, "
        "data_value NULLS FIRST, m_flag NULLS FIRST, q_flag NULLS FIRST, s_flag NULLS FIRST, obs_time NULLS FIRST) = 1"
    )


def _source_pick() -> str:
    return with_(OBSERVATIONS) + _picked_rows()


ORACLE_SQL.update({
    "dly_parse": _dly(),
    "element_inventory": with_(OBSERVATIONS, STATIONS) + (
        "SELECT i.id, s.latitude, s.longitude, i.element, i.firstyear, i.lastyear FROM ("
        "SELECT id, element, CAST(min(year(date)) AS INTEGER) AS firstyear, CAST(max(year(date)) AS INTEGER) AS lastyear "
        "FROM observations WHERE q_flag IS NULL GROUP BY id, element) i LEFT JOIN stations s ON i.id = s.id"
    ),
    "source_priority_pick": _source_pick(),
    "station_codes": with_(STATIONS) + "SELECT id, substring(id, 1, 2) AS country_code, substring(id, 3, 1) AS network_code FROM stations",
})


# Meanings of the codes that occur in the stand-in, typed in here and not taken from the dictionaries under test.
SEEN_ELEMENTS = (
    ("PRCP", "Precipitation (tenths of mm)"),
    ("SNOW", "Snowfall (mm)"),
    ("SNWD", "Snow depth (mm)"),
    ("TMAX", "Maximum temperature (tenths of degrees C)"),
    ("TMIN", "Minimum temperature (tenths of degrees C)"),
    ("WT01", "Weather type: Fog, ice fog, or freezing fog (may include heavy fog)"),
)
SEEN_M = (("", "no measurement information applicable"), ("T", "trace of precipitation, snowfall, or snow depth"))
SEEN_Q = (("", "did not fail any quality assurance check"), ("X", "failed bounds check"))
SEEN_S = (
    ("7", "U.S. Cooperative Summary of the Day -- Transmitted via WxCoder3 (NCDC DSI-3207)"),
    ("S", "Global Summary of the Day (NCDC DSI-9618)"),
    ("W", "WBAN/ASOS Summary of the Day from NCDC's Integrated Surface Data (ISD)"),
)


def meaning(code: str, seen) -> str:
    quote = lambda v: "'" + v.replace("'", "''") + "'"
    return f"map {{{', '.join(f'{quote(k)}: {quote(v)}' for k, v in seen)}}}[coalesce({code}, '')]"


ORACLE_SQL["flag_summary"] = with_(OBSERVATIONS) + (
    f"SELECT element, {meaning('element', SEEN_ELEMENTS)} AS element_name, m_flag, {meaning('m_flag', SEEN_M)} AS m_flag_meaning, "
    f"q_flag, {meaning('q_flag', SEEN_Q)} AS q_flag_meaning, count(*) AS readings, count(data_value) AS with_value "
    "FROM observations GROUP BY element, m_flag, q_flag"
)
ORACLE_SQL["flag_decode"] = with_(OBSERVATIONS) + (
    f"SELECT *, {meaning('element', SEEN_ELEMENTS)} AS element_name, {meaning('m_flag', SEEN_M)} AS m_flag_meaning, "
    f"{meaning('q_flag', SEEN_Q)} AS q_flag_meaning, {meaning('s_flag', SEEN_S)} AS s_flag_meaning FROM observations"
)


# ---------------------------------------------------------------- stored tables and files
ORACLE_SQL["replace_years_table"] = with_(STORM_RAW, STORMS) + (
    "SELECT EVENT_ID, EVENT_TYPE, STATE, DATA_SOURCE, YEAR FROM storms "
    "WHERE (DATA_SOURCE = 'F') = (YEAR NOT IN (1994, 1996))"
)
ORACLE_SQL["replace_range_table"] = (
    "SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS date, CAST(year(o_orderdate) AS INTEGER) AS year, "
    "CAST(month(o_orderdate) AS INTEGER) AS month FROM orders "
    "WHERE (o_orderstatus = 'F') <> (o_orderdate BETWEEN DATE '1995-03-10' AND DATE '1995-06-20')"
)
ORACLE_SQL["storm_files"] = with_(STORM_RAW) + (
    "SELECT EVENT_ID, STATE, if(kind = 2 AND short, NULL, YEAR) AS YEAR, if(kind = 2, NULL, EVENT_TYPE) AS EVENT_TYPE, "
    "if(kind = 0, TOR_LENGTH, NULL) AS TOR_LENGTH, if(kind = 2, NULL, MAGNITUDE) AS MAGNITUDE, kind = 2 AND short AS malformed "
    "FROM (SELECT *, CAST(EVENT_ID AS BIGINT) % 3 AS kind, CAST(EVENT_ID AS BIGINT) % 5 = 0 AS short FROM storm_raw)"
)
ORACLE_SQL["observation_files"] = (
    "SELECT name, file_year, coalesce(file_year >= 1997, false) AS selected FROM (SELECT DISTINCT "
    "year(o_orderdate) || if(o_orderkey % 7 = 0, 'x', '') || '.csv.gz' AS name, "
    "if(o_orderkey % 7 = 0, NULL, CAST(year(o_orderdate) AS INTEGER)) AS file_year FROM orders)"
)
ORACLE_SQL["inventory_parse"] = with_(OBSERVATIONS, STATIONS) + (
    "SELECT id, round(latitude, 4) AS latitude, round(longitude, 4) AS longitude, element, "
    "CAST(min(year(date)) AS INTEGER) AS firstyear, CAST(max(year(date)) AS INTEGER) AS lastyear "
    "FROM observations JOIN (SELECT id, latitude, longitude FROM stations WHERE latitude IS NOT NULL) USING (id) "
    "WHERE q_flag IS NULL GROUP BY id, latitude, longitude, element"
)
ORACLE_SQL["station_names"] = with_(STATIONS) + (
    "SELECT id, left(id, 2) AS country_code, id[3] AS network_code, (SELECT r_name FROM region WHERE r_regionkey = 0) AS country_name, "
    "state, (SELECT n_name FROM nation WHERE n_nationkey % 5 <> 0 AND state = repeat(chr(CAST(65 + n_nationkey % 26 AS INTEGER)), 2)) "
    "AS state_name FROM stations"
)


# ---------------------------------------------------------------- incremental operators
def _listing_changes() -> str:
    """Each file by what a left join finds of it on the other side."""
    name = "CAST(y AS VARCHAR) || '.csv.gz'"
    return (
        "WITH g AS (SELECT year(o_orderdate) AS y, o_custkey % 40 AS c, CAST(sum(o_orderkey) AS BIGINT) AS length, "
        "max(o_orderdate) AS modified FROM orders GROUP BY 1, 2),\n"
        f"named AS (SELECT c, '/in/' || CAST(c AS VARCHAR) || '/' || {name} AS path, {name} AS name, length, modified FROM g),\n"
        "a AS (SELECT * FROM named WHERE c % 5 <> 1),\n"
        "b AS (SELECT c, path, name, length + if(c % 3 = 0, 1, 0) AS length, "
        "modified + if(c % 4 = 0, INTERVAL 1 DAY, INTERVAL 0 DAY) AS modified FROM named WHERE c % 7 <> 2),\n"
        "files AS (SELECT path, name FROM a UNION SELECT path, name FROM b),\n"
        "found AS (SELECT f.path, f.name, a.length AS before_length, b.length AS after_length, a.modified AS before_modified, "
        "b.modified AS after_modified, if(b.path IS NULL, 'removed', if(a.path IS NULL, 'new', "
        "if(a.length = b.length AND a.modified = b.modified, 'same', 'changed'))) AS change "
        "FROM files f LEFT JOIN a USING (path) LEFT JOIN b USING (path))\n"
        "SELECT *, change IN ('new', 'changed') AS reload, CAST(left(name, 4) AS INTEGER) AS file_year, "
        "CAST(left(name, 4) AS INTEGER) >= 1994 AS selected FROM found"
    )


def _station_day_moments() -> str:
    elements = ", ".join(f"'{e}'" for e in ELEMENTS)
    good = f"coalesce(element IN ({elements}) AND q_flag IS NULL, false)"
    return with_(OBSERVATIONS) + (
        f"SELECT id, date, element, count(*) AS readings, count(v) AS valued, CAST(coalesce(sum(v), 0) AS BIGINT) AS total, "
        "CAST(coalesce(sum(v * v), 0) AS DECIMAL(38, 0)) AS squares FROM "
        f"(SELECT id, date, if({good}, element, '') AS element, if({good}, CAST(data_value AS BIGINT), NULL) AS v FROM observations) "
        "GROUP BY id, date, element"
    )


def _nearest_on_sphere() -> str:
    def coordinate(key: str, factor: int, span: int) -> str:
        return f"CAST(({key} * {factor}) % {span * 100 + 1} AS DOUBLE) / 100.0 - {span / 2}"

    miles = haversine("zipcode_latitude", "zipcode_longitude", "station_latitude", "station_longitude")
    return (
        f"WITH z AS (SELECT printf('%05d', c_custkey) AS zipcode, {coordinate('c_custkey', 7919, 180)} AS zipcode_latitude, "
        f"{coordinate('c_custkey', 104729, 360)} AS zipcode_longitude FROM customer),\n"
        f"s AS (SELECT printf('US%09d', s_suppkey) AS station_id, s_name AS station_name, {coordinate('s_suppkey', 7907, 180)} "
        f"AS station_latitude, {coordinate('s_suppkey', 104723, 360)} AS station_longitude FROM supplier),\n"
        f"near AS (SELECT *, {miles} AS miles FROM z, s),\n"
        "placed AS (SELECT *, row_number() OVER (PARTITION BY zipcode ORDER BY miles, station_id) AS place FROM near WHERE miles <= 700)\n"
        "SELECT zipcode, station_id, station_name, station_latitude, station_longitude, zipcode_latitude, zipcode_longitude, "
        "round(miles, 6) AS distance_miles, CAST(place AS INTEGER) AS rank FROM placed WHERE place <= 10"
    )


def _inventory_reconciled() -> str:
    """Series of either inventory and what a left join finds of them in both."""
    keyed = OBSERVATIONS.replace("SELECT printf", "SELECT event_id, printf")
    spans = "CAST(min(year(date)) AS INTEGER) AS a, CAST(max(year(date)) AS INTEGER) AS b"
    return with_(keyed) + (
        f",\nmine AS (SELECT id, element, {spans} FROM observations WHERE q_flag IS NULL GROUP BY id, element),\n"
        f"old AS (SELECT id, element, {spans} FROM (SELECT * REPLACE (if(right(id, 1) = '7', CAST(date - INTERVAL 12 MONTH AS DATE), date) AS date) "
        "FROM observations WHERE event_id % 23 <> 0 AND right(id, 1) <> '9') WHERE q_flag IS NULL GROUP BY id, element),\n"
        "series AS (SELECT id, element FROM mine UNION SELECT id, element FROM old)\n"
        "SELECT s.id, s.element, old.a AS published_first, old.b AS published_last, mine.a AS recomputed_first, mine.b AS recomputed_last, "
        "CASE WHEN mine.id IS NULL THEN 'missing' WHEN old.id IS NULL THEN 'extra' WHEN old.a = mine.a AND old.b = mine.b THEN 'same' "
        "ELSE 'other years' END AS class FROM series s "
        "LEFT JOIN old ON old.id = s.id AND old.element IS NOT DISTINCT FROM s.element "
        "LEFT JOIN mine ON mine.id = s.id AND mine.element IS NOT DISTINCT FROM s.element"
    )


def _load_audit() -> str:
    """Rows loaded, and left out for their year, by two refreshes; the second loads one year."""
    fig = "SELECT {n} AS run_no, '{f}' AS figure, count(*) FILTER (WHERE {c}) AS amount FROM orders WHERE o_orderstatus = '{s}'"
    runs = []
    for n, status, years in ((1, "F", "1994, 1996"), (2, "O", "1996")):
        inside = f"year(o_orderdate) IN ({years})"
        runs += [fig.format(n=n, f="rows_loaded", c=inside, s=status), fig.format(n=n, f="rows_other_years", c=f"NOT {inside}", s=status)]
    return (
        f"WITH runs AS ({' UNION ALL '.join(runs)})\n"
        "SELECT 'refresh' AS job, 'orders' AS target, CAST(a.run_no AS INTEGER) AS run_no, 'done' AS outcome, a.figure, a.amount, "
        "a.amount - b.amount AS change FROM runs a LEFT JOIN runs b ON b.figure = a.figure AND b.run_no = a.run_no - 1"
    )


ORACLE_SQL |= {
    "listing_changes": _listing_changes(),
    "station_day_moments": _station_day_moments(),
    "daily_metrics_merged": ORACLE_SQL["daily_metrics"],
    "links_refreshed": ORACLE_SQL["nearest_k_stations"],
    "nearest_on_sphere": _nearest_on_sphere(),
    "inventory_reconciled": _inventory_reconciled(),
    "resume_from_table": ORACLE_SQL["resume_date"],
    "clustered_export": "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders "
    "WHERE o_custkey BETWEEN 100 AND 120",
    "named_table": "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders, max(o_orderkey) AS newest FROM orders GROUP BY 1",
    "described_table": "SELECT CAST(position AS INTEGER) AS position, col_name, data_type, position = 4 AS is_partition FROM "
    "(VALUES (1, 'o_orderkey', 'bigint'), (2, 'o_custkey', 'bigint'), (3, 'o_totalprice', 'double'), (4, 'year', 'int')) "
    "t(position, col_name, data_type)",
    "footer_extremes": "SELECT count(*) AS orders, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key, max(o_custkey) AS last_customer FROM orders",
    "load_audit": _load_audit(),
}
