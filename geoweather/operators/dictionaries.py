"""Code dictionaries of the daily data manual: elements, measurement and quality flags.

Each dictionary is a fixed table of at most a few dozen rows, so joining it is a
broadcast hash join with a proven size bound: the big side is never shuffled.
Readings are aggregated first (``flag_summary``) and decoded afterwards, so the
join sees one row per (element, m_flag, q_flag) group, not one per reading.

A blank flag is stored as NULL in the observation table; it is looked up under
the empty code ``""``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The five core elements, as documented (code, description).
CORE_ELEMENT_NAMES = (
    ("PRCP", "Precipitation (tenths of mm)"),
    ("SNOW", "Snowfall (mm)"),
    ("SNWD", "Snow depth (mm)"),
    ("TMAX", "Maximum temperature (tenths of degrees C)"),
    ("TMIN", "Minimum temperature (tenths of degrees C)"),
)

# Weather types, element code "WT" + two digits (code, description).
WEATHER_TYPES = (
    ("01", "Fog, ice fog, or freezing fog (may include heavy fog)"),
    ("02", "Heavy fog or heaving freezing fog (not always distinquished from fog)"),
    ("03", "Thunder"),
    ("04", "Ice pellets, sleet, snow pellets, or small hail"),
    ("05", "Hail (may include small hail)"),
    ("06", "Glaze or rime"),
    ("07", "Dust, volcanic ash, blowing dust, blowing sand, or blowing obstruction"),
    ("08", "Smoke or haze"),
    ("09", "Blowing or drifting snow"),
    ("10", "Tornado, waterspout, or funnel cloud"),
    ("11", "High or damaging winds"),
    ("12", "Blowing spray"),
    ("13", "Mist"),
    ("14", "Drizzle"),
    ("15", "Freezing drizzle"),
    ("16", "Rain (may include freezing rain, drizzle, and freezing drizzle)"),
    ("17", "Freezing rain"),
    ("18", "Snow, snow pellets, snow grains, or ice crystals"),
    ("19", "Unknown source of precipitation"),
    ("21", "Ground fog"),
    ("22", "Ice fog or freezing fog"),
)

# The other elements, as documented (code, description).
OTHER_ELEMENT_NAMES = (
    ("ACMC", "Average cloudiness midnight to midnight from 30-second ceilometer data (percent)"),
    ("ACMH", "Average cloudiness midnight to midnight from manual observations (percent)"),
    ("ACSC", "Average cloudiness sunrise to sunset from 30-second ceilometer data (percent)"),
    ("ACSH", "Average cloudiness sunrise to sunset from manual observations (percent)"),
    ("ADPT", "Average Dew Point Temperature for the day (tenths of degrees C)"),
    ("ASLP", "Average Sea Level Pressure for the day (hPa * 10)"),
    ("ASTP", "Average Station Level Pressure for the day (hPa * 10)"),
    ("AWBT", "Average Wet Bulb Temperature for the day (tenths of degrees C)"),
    ("AWDR", "Average daily wind direction (degrees)"),
    ("AWND", "Average daily wind speed (tenths of meters per second)"),
    ("DAEV", "Number of days included in the multiday evaporation total (MDEV)"),
    ("DAPR", "Number of days included in the multiday precipiation total (MDPR)"),
    ("DASF", "Number of days included in the multiday snowfall total (MDSF)"),
    ("DATN", "Number of days included in the multiday minimum temperature (MDTN)"),
    ("DATX", "Number of days included in the multiday maximum temperature (MDTX)"),
    ("DAWM", "Number of days included in the multiday wind movement (MDWM)"),
    ("DWPR", "Number of days with non-zero precipitation included in multiday precipitation total (MDPR)"),
    ("EVAP", "Evaporation of water from evaporation pan (tenths of mm)"),
    ("FMTM", "Time of fastest mile or fastest 1-minute wind (hours and minutes, i.e., HHMM)"),
    ("FRGB", "Base of frozen ground layer (cm)"),
    ("FRGT", "Top of frozen ground layer (cm)"),
    ("FRTH", "Thickness of frozen ground layer (cm)"),
    ("GAHT", "Difference between river and gauge height (cm)"),
    ("MDEV", "Multiday evaporation total (tenths of mm; use with DAEV)"),
    ("MDPR", "Multiday precipitation total (tenths of mm; use with DAPR and DWPR, if available)"),
    ("MDSF", "Multiday snowfall total"),
    ("MDTN", "Multiday minimum temperature (tenths of degrees C; use with DATN)"),
    ("MDTX", "Multiday maximum temperature (tenths of degress C; use with DATX)"),
    ("MDWM", "Multiday wind movement (km)"),
    ("MNPN", "Daily minimum temperature of water in an evaporation pan (tenths of degrees C)"),
    ("MXPN", "Daily maximum temperature of water in an evaporation pan (tenths of degrees C)"),
    ("PGTM", "Peak gust time (hours and minutes, i.e., HHMM)"),
    ("PSUN", "Daily percent of possible sunshine (percent)"),
    ("RHAV", "Average relative humidity for the day (percent)"),
    ("RHMN", "Minimum relative humidity for the day (percent)"),
    ("RHMX", "Maximum relative humidity for the day (percent)"),
    ("TAXN", "Average daily temperature computed as (TMAX+TMIN)/2.0 (tenths of degrees C)"),
    ("TAVG", "Average daily temperature (tenths of degrees C)"),
    ("THIC", "Thickness of ice on water (tenths of mm)"),
    ("TOBS", "Temperature at the time of observation (tenths of degrees C)"),
    ("TSUN", "Daily total sunshine (minutes)"),
    ("WDF1", "Direction of fastest 1-minute wind (degrees)"),
    ("WDF2", "Direction of fastest 2-minute wind (degrees)"),
    ("WDF5", "Direction of fastest 5-second wind (degrees)"),
    ("WDFG", "Direction of peak wind gust (degrees)"),
    ("WDFI", "Direction of highest instantaneous wind (degrees)"),
    ("WDFM", "Fastest mile wind direction (degrees)"),
    ("WDMV", "24-hour wind movement (km)"),
    ("WESD", "Water equivalent of snow on the ground (tenths of mm)"),
    ("WESF", "Water equivalent of snowfall (tenths of mm)"),
    ("WSF1", "Fastest 1-minute wind speed (tenths of meters per second)"),
    ("WSF2", "Fastest 2-minute wind speed (tenths of meters per second)"),
    ("WSF5", "Fastest 5-second wind speed (tenths of meters per second)"),
    ("WSFG", "Peak gust wind speed (tenths of meters per second)"),
    ("WSFI", "Highest instantaneous wind speed (tenths of meters per second)"),
    ("WSFM", "Fastest mile wind speed (tenths of meters per second)"),
)

# Weather in the vicinity, element code "WV" + two digits (code, description).
VICINITY_TYPES = (
    ("01", "Fog, ice fog, or freezing fog (may include heavy fog)"),
    ("03", "Thunder"),
    ("07", "Ash, dust, sand, or other blowing obstruction"),
    ("18", "Snow or ice crystals"),
    ("20", "Rain or snow shower"),
)

# Soil temperature elements SN (minimum) and SX (maximum) + ground cover code + depth code.
GROUND_COVERS = (
    ("0", "unknown"), ("1", "grass"), ("2", "fallow"), ("3", "bare ground"), ("4", "brome grass"),
    ("5", "sod"), ("6", "straw multch"), ("7", "grass muck"), ("8", "bare muck"),
)
SOIL_DEPTHS = (("1", "5 cm"), ("2", "10 cm"), ("3", "20 cm"), ("4", "50 cm"), ("5", "100 cm"), ("6", "150 cm"), ("7", "180 cm"))

# Source flags (code, meaning); "" is the blank flag.
S_FLAGS = (
    ("", "No source (i.e., data value missing)"),
    ("0", "U.S. Cooperative Summary of the Day (NCDC DSI-3200)"),
    ("6", "CDMP Cooperative Summary of the Day (NCDC DSI-3206)"),
    ("7", "U.S. Cooperative Summary of the Day -- Transmitted via WxCoder3 (NCDC DSI-3207)"),
    ("A", "U.S. Automated Surface Observing System (ASOS) real-time data (since January 1, 2006)"),
    ("a", "Australian data from the Australian Bureau of Meteorology"),
    ("B", "U.S. ASOS data for October 2000-December 2005 (NCDC DSI-3211)"),
    ("b", "Belarus update"),
    ("C", "Environment Canada"),
    ("D", "Short time delay US National Weather Service CF6 daily summaries provided by the High Plains Regional Climate Center"),
    ("d", "Short time delay US National Weather Service Daily Summary Message (DSMs) provided by the High Plains Regional Climate Center"),
    ("E", "European Climate Assessment and Dataset (Klein Tank et al., 2002)"),
    ("F", "U.S. Fort data"),
    ("G", "Official Global Climate Observing System (GCOS) or other government-supplied data"),
    ("H", "High Plains Regional Climate Center real-time data"),
    ("I", "International collection (non U.S. data received through personal contacts)"),
    ("K", "U.S. Cooperative Summary of the Day data digitized from paper observer forms (from 2011 to present)"),
    ("M", "Monthly METAR Extract (additional ASOS data)"),
    ("f", "Data provided courtesy of the Fiji Met Service"),
    ("m", "Data from the Mexican National Water Commission (Comision National del Agua -- CONAGUA)"),
    ("N", "Community Collaborative Rain, Hail,and Snow (CoCoRaHS)"),
    ("Q", "Data from several African countries that had been \"quarantined\", that is, withheld from public release until permission was granted from the respective meteorological services"),
    ("R", "NCEI Reference Network Database (Climate Reference Network and Regional Climate Reference Network)"),
    ("r", "All-Russian Research Institute of Hydrometeorological Information-World Data Center"),
    ("S", "Global Summary of the Day (NCDC DSI-9618)"),
    ("s", "China Meteorological Administration/National Meteorological Information Center/Climatic Data Center"),
    ("T", "SNOwpack TELemtry (SNOTEL) data obtained from the U.S. Department of Agriculture's Natural Resources Conservation Service"),
    ("U", "Remote Automatic Weather Station (RAWS) data obtained from the Western Regional Climate Center"),
    ("u", "Ukraine update"),
    ("W", "WBAN/ASOS Summary of the Day from NCDC's Integrated Surface Data (ISD)"),
    ("X", "U.S. First-Order Summary of the Day (NCDC DSI-3210)"),
    ("Z", "Datzilla official additions or replacements"),
    ("z", "Uzbekistan update"),
)

# Measurement flags (code, meaning); "" is the blank flag.
M_FLAGS = (
    ("", "no measurement information applicable"),
    ("B", "precipitation total formed from two 12-hour totals"),
    ("D", "precipitation total formed from four six-hour totals"),
    ("H", "represents highest or lowest hourly temperature (TMAX or TMIN) or the average of hourly values (TAVG)"),
    ("K", "converted from knots"),
    ("L", "temperature appears to be lagged with respect to reported hour of observation"),
    ("O", "converted from oktas"),
    ("P", "identified as \"missing presumed zero\" in DSI 3200 and 3206"),
    ("T", "trace of precipitation, snowfall, or snow depth"),
    ("W", "converted from 16-point WBAN code (for wind direction)"),
)

# Quality flags (code, meaning); "" is the blank flag.
Q_FLAGS = (
    ("", "did not fail any quality assurance check"),
    ("D", "failed duplicate check"),
    ("G", "failed gap check"),
    ("I", "failed internal consistency check"),
    ("K", "failed streak/frequent-value check"),
    ("L", "failed check on length of multiday period"),
    ("M", "failed megaconsistency check"),
    ("N", "failed naught check"),
    ("O", "failed climatological outlier check"),
    ("R", "failed lagged range check"),
    ("S", "failed spatial consistency check"),
    ("T", "failed temporal consistency check"),
    ("W", "temperature too warm for snow"),
    ("X", "failed bounds check"),
    ("Z", "flagged as a result of an official Datzilla investigation"),
)


def element_names() -> tuple[tuple[str, str], ...]:
    """(element, description) of every documented element; typed ones are composed from their codes."""
    soil = tuple(
        (f"{kind}{c}{d}", f"{name} soil temperature (tenths of degrees C): {cover}, {depth}")
        for kind, name in (("SN", "Minimum"), ("SX", "Maximum"))
        for c, cover in GROUND_COVERS
        for d, depth in SOIL_DEPTHS
    )
    weather = tuple((f"WT{n}", f"Weather type: {d}") for n, d in WEATHER_TYPES)
    vicinity = tuple((f"WV{n}", f"Weather in the vicinity: {d}") for n, d in VICINITY_TYPES)
    return CORE_ELEMENT_NAMES + OTHER_ELEMENT_NAMES + soil + weather + vicinity


def _table(spark: SparkSession, rows, key: str, value: str) -> DataFrame:
    return spark.createDataFrame(list(rows), f"{key} string, {value} string")


def element_table(spark: SparkSession) -> DataFrame:
    return _table(spark, element_names(), "element", "element_name")


def m_flag_table(spark: SparkSession) -> DataFrame:
    return _table(spark, M_FLAGS, "m_code", "m_flag_meaning")


def q_flag_table(spark: SparkSession) -> DataFrame:
    return _table(spark, Q_FLAGS, "q_code", "q_flag_meaning")


def s_flag_table(spark: SparkSession) -> DataFrame:
    return _table(spark, S_FLAGS, "s_code", "s_flag_meaning")


def decode_flags(df: DataFrame) -> DataFrame:
    """Adds ``element_name``, ``m_flag_meaning`` and ``q_flag_meaning`` to each row, and
    ``s_flag_meaning`` where there is an ``s_flag``.

    Unknown codes get NULL (left joins).  All dictionaries are broadcast;
    the input keeps its partitioning and is never shuffled.
    """
    spark = df.sparkSession
    elements = F.broadcast(element_table(spark))
    m = F.broadcast(m_flag_table(spark))
    q = F.broadcast(q_flag_table(spark))
    out = (
        df.join(elements, "element", "left")
        .join(m, F.coalesce(df["m_flag"], F.lit("")) == m["m_code"], "left")
        .join(q, F.coalesce(df["q_flag"], F.lit("")) == q["q_code"], "left")
    )
    added = ["element_name", "m_flag_meaning", "q_flag_meaning"]
    if "s_flag" in df.columns:
        out = out.join(F.broadcast(s_flag_table(spark)), F.coalesce(df["s_flag"], F.lit("")) == F.col("s_code"), "left")
        added.append("s_flag_meaning")
    return out.select(*df.columns, *added)


def flag_summary(obs: DataFrame) -> DataFrame:
    """Readings per (element, m_flag, q_flag) with the decoded names.

    The count is a partial (map-side) aggregation, so the shuffle carries one row
    per group and task; decoding runs on the few aggregated rows.
    """
    counts = obs.groupBy("element", "m_flag", "q_flag").agg(
        F.count(F.lit(1)).alias("readings"),
        F.count("data_value").alias("with_value"),
    )
    return decode_flags(counts).select(
        "element", "element_name", "m_flag", "m_flag_meaning", "q_flag", "q_flag_meaning", "readings", "with_value"
    )
