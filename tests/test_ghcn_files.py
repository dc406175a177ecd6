import datetime as dt

from geoweather.operators.stations import element_inventory, pick_by_source_priority, station_codes
from geoweather.schemas import OBSERVATIONS
from geoweather.sources.ghcn_files import parse_dly_lines, parse_inventory_lines
from tests.conftest import plan_text


def _dly_line(id_, year, month, element, days):
    """days: {day: (value, m, q, s)}; other days missing."""
    blocks = []
    for d in range(1, 32):
        v, m, q, s = days.get(d, (-9999, " ", " ", " "))
        blocks.append(f"{v:>5}{m}{q}{s}")
    line = f"{id_:<11}{year:04d}{month:02d}{element}" + "".join(blocks)
    assert len(line) == 269
    return line


def test_parse_dly(spark):
    lines = [
        _dly_line("USC00026481", 2024, 2, "PRCP", {1: (5, " ", " ", "7"), 29: (0, "T", " ", "7"), 30: (3, " ", " ", "7")}),
        _dly_line("USC00026481", 2024, 4, "TMAX", {15: (-12, " ", "I", "W")}),
    ]
    df = spark.createDataFrame([(l,) for l in lines], "value string")
    rows = sorted(parse_dly_lines(df).collect(), key=lambda r: (r.element, r.date or dt.date.max))
    assert [(r.date, r.data_value, r.m_flag, r.q_flag, r.s_flag) for r in rows] == [
        (dt.date(2024, 2, 1), 5, None, None, "7"),
        (dt.date(2024, 2, 29), 0, "T", None, "7"),
        (None, 3, None, None, "7"),  # a value on Feb 30: kept, no date
        (dt.date(2024, 4, 15), -12, None, "I", "W"),
    ]
    assert {r.year for r in rows} == {2024} and all(r.obs_time is None for r in rows)


def test_source_priority_and_inventory(spark):
    d = dt.date(2024, 1, 1)
    obs = spark.createDataFrame(
        [
            ("A", d, "PRCP", 10, None, None, "W", None),
            ("A", d, "PRCP", 11, None, None, "X", None),  # X outranks W
            ("A", d, "TMAX", 5, None, None, "?", None),  # unknown source ranks last
            ("A", d, "TMAX", 6, None, None, "S", None),
            ("A", dt.date(2020, 5, 1), "TMAX", 1, None, "I", "S", None),  # flagged: not in inventory
            ("A", dt.date(2021, 5, 1), "TMAX", 1, None, None, "S", None),
        ],
        OBSERVATIONS,
    )
    best = {(r.element, r.date): r.data_value for r in pick_by_source_priority(obs).collect()}
    assert best[("PRCP", d)] == 11 and best[("TMAX", d)] == 6
    stations = spark.createDataFrame([("A", 1.0, 2.0)], "id string, latitude double, longitude double")
    inv = {r.element: (r.firstyear, r.lastyear, r.latitude) for r in element_inventory(obs, stations).collect()}
    assert inv == {"PRCP": (2024, 2024, 1.0), "TMAX": (2021, 2024, 1.0)}
    codes = station_codes(spark.createDataFrame([("USC00026481",)], "id string")).collect()[0]
    assert (codes.country_code, codes.network_code) == ("US", "C")


def test_parse_inventory(spark):
    line = "ACW00011604  17.1167  -61.7833 TMAX 1949 1949"
    r = parse_inventory_lines(spark.createDataFrame([(line,)], "value string")).collect()[0]
    assert (r.id, r.latitude, r.longitude, r.element, r.firstyear, r.lastyear) == (
        "ACW00011604", 17.1167, -61.7833, "TMAX", 1949, 1949)


def test_name_station_codes(spark, tmp_path):
    from geoweather.operators.stations import name_station_codes
    from geoweather.sources.ghcn_files import read_countries, read_states

    (tmp_path / "countries.txt").write_text("US United States\nCA Canada\n")
    (tmp_path / "states.txt").write_text("NY NEW YORK\nON ONTARIO\n")
    stations = spark.createDataFrame(
        [("USC00300001", "NY"), ("CA001000001", "ON"), ("ZZX00000001", "  ")], "id string, state string"
    )
    out = name_station_codes(
        stations, read_countries(spark, str(tmp_path / "countries.txt")), read_states(spark, str(tmp_path / "states.txt"))
    )
    assert "SortMergeJoin" not in plan_text(out)
    got = {r["id"]: (r["country_code"], r["network_code"], r["country_name"], r["state_name"]) for r in out.collect()}
    assert got == {
        "USC00300001": ("US", "C", "United States", "NEW YORK"),
        "CA001000001": ("CA", "0", "Canada", "ONTARIO"),
        "ZZX00000001": ("ZZ", "X", None, None),
    }
