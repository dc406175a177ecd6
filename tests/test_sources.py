import datetime as dt
import gzip
import os

from geoweather.sources import (
    list_observation_files,
    list_storm_files,
    read_observations,
    read_stations,
    read_storm_files,
    read_zipcodes,
    selected_paths,
)
from geoweather.sources.observations import observation_rejects

OBS_LINES = """USW00014922,20240101,PRCP,5,,,W,0700
USW00014922,20240101,TMAX,-50,,,W,
USW00014922,20240101,TMIN,-120,,I,W,
USC00000001,20240101,PRCP,,T,,7,2400
USC00000001,20240102,WT01,1,,,7,
USC00000001,2024013X,PRCP,3,,,7,
"""


def _station_line(id_, lat, lon, elev, state, name, gsn, hcn, wmo):
    line = f"{id_:<11} {lat:>8} {lon:>9} {elev:>6} {state:<2} {name:<30} {gsn:<3} {hcn:<3} {wmo:<5}"
    assert len(line) == 85
    return line


def test_observation_csv(spark, tmp_path):
    p = tmp_path / "2024.csv.gz"
    with gzip.open(p, "wt") as f:
        f.write(OBS_LINES)
    rows = read_observations(spark, str(p)).orderBy("id", "date", "element").collect()
    assert len(rows) == 5
    first = [r for r in rows if r.id == "USC00000001" and r.element == "PRCP"][0]
    assert first.data_value is None and first.m_flag == "T" and first.q_flag is None and first.obs_time == "2400"
    w = [r for r in rows if r.element == "PRCP" and r.id == "USW00014922"][0]
    assert w.date == dt.date(2024, 1, 1) and w.obs_time == "0700" and w.year == 2024
    assert [r for r in rows if r.element == "TMIN"][0].q_flag == "I"
    assert observation_rejects(spark, str(p)).count() == 1


def test_fixed_width_stations(spark, tmp_path):
    lines = [
        _station_line("ACW00011604", "17.1167", "-61.7833", "10.1", "", "ST JOHNS COOLIDGE FLD", "", "", ""),
        _station_line("USW00014922", "44.8831", "-93.2289", "265.8", "MN", "MINNEAPOLIS/ST PAUL, AP", "GSN", "HCN", "72658"),
        _station_line("USC00000001", "44.9500", "-93.1000", "-999.9", "MN", 'X "Q" Y', "", "CRN", ""),
    ]
    p = tmp_path / "ghcnd-stations.txt"
    p.write_text("\n".join(lines) + "\n")
    rows = {r.id: r for r in read_stations(spark, str(p)).collect()}
    a = rows["ACW00011604"]
    assert (a.latitude, a.longitude, a.elevation) == (17.1167, -61.7833, 10.1)
    assert a.state == "  " and a.gsn_flag == "   " and a.name == "ST JOHNS COOLIDGE FLD"
    assert rows["USW00014922"].name == "MINNEAPOLIS/ST PAUL, AP" and rows["USW00014922"].wmo_id == "72658"
    c = rows["USC00000001"]
    assert c.elevation == -999.9 and c.name == 'X "Q" Y' and c.hcn_crn_flag == "CRN"


def test_gazetteer_tsv(spark, tmp_path):
    p = tmp_path / "zcta.txt"
    p.write_text(
        "GEOID\tALAND\tAWATER\tALAND_SQMI\tAWATER_SQMI\tINTPTLAT\tINTPTLONG      \n"
        "00601\t166836392\t798613\t64.416\t0.308\t18.180555\t-66.749961   \n"
    )
    r = read_zipcodes(spark, str(p)).collect()[0]
    assert r.GEOID == "00601" and r.ALAND == 166836392 and r.INTPTLONG == -66.749961 and r.INTPTLAT == 18.180555


STORM_HEADER = (
    "BEGIN_YEARMONTH,BEGIN_DAY,BEGIN_TIME,END_YEARMONTH,END_DAY,END_TIME,EPISODE_ID,EVENT_ID,STATE,STATE_FIPS,YEAR,"
    "MONTH_NAME,EVENT_TYPE,CZ_TYPE,CZ_FIPS,CZ_NAME,WFO,BEGIN_DATE_TIME,CZ_TIMEZONE,END_DATE_TIME,INJURIES_DIRECT,"
    "INJURIES_INDIRECT,DEATHS_DIRECT,DEATHS_INDIRECT,DAMAGE_PROPERTY,DAMAGE_CROPS,SOURCE,MAGNITUDE,MAGNITUDE_TYPE,"
    "FLOOD_CAUSE,CATEGORY,TOR_F_SCALE,TOR_LENGTH,TOR_WIDTH,TOR_OTHER_WFO,TOR_OTHER_CZ_STATE,TOR_OTHER_CZ_FIPS,"
    "TOR_OTHER_CZ_NAME,BEGIN_RANGE,BEGIN_AZIMUTH,BEGIN_LOCATION,END_RANGE,END_AZIMUTH,END_LOCATION,BEGIN_LAT,"
    "BEGIN_LON,END_LAT,END_LON,EPISODE_NARRATIVE,EVENT_NARRATIVE,DATA_SOURCE"
)


def storm_row(event_id, ym, day, hhmm, damage="10.00K", narrative="plain", magnitude="1.75", year=None):
    year = year or str(ym)[:4]
    vals = [str(ym), str(day), str(hhmm), str(ym), str(day), str(hhmm), "1", str(event_id), "TEXAS", "48", year,
            "January", "Hail", "C", "1", "X", "HGX", "01-JAN-24 00:00:00", "CST-6", "01-JAN-24 00:00:00", "0", "0", "0",
            "0", damage, "", "Public", magnitude, "", "", "", "", "", "", "", "", "", "", "", "", "", "", "", "",
            "29.1", "-95.1", "29.2", "-95.2", "episode", narrative, "CSV"]
    return ",".join(vals)


def write_storm_file(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with gzip.open(os.path.join(folder, name), "wt") as f:
        f.write(STORM_HEADER + "\n" + "\n".join(rows) + "\n")


def test_storm_csv_multiline_quotes(spark, tmp_path):
    narrative = '"Wind gusts, ""strong"" ones\nover two lines"'
    write_storm_file(str(tmp_path), "StormEvents_details-ftp_v1.0_d2024_c20250101.csv.gz",
                     [storm_row(1, 202401, 5, 905, narrative=narrative), storm_row(2, 202401, 6, 1000)])
    rows = read_storm_files(spark, str(tmp_path)).orderBy("EVENT_ID").collect()
    assert len(rows) == 2
    assert rows[0].EVENT_NARRATIVE == 'Wind gusts, "strong" ones\nover two lines'
    assert rows[0].file_year == 2024 and rows[1].DATA_SOURCE == "CSV"


def test_file_listing_and_year_selection(spark, tmp_path):
    for name in ["2022.csv.gz", "2023.csv.gz", "2024.csv.gz", "readme.txt"]:
        (tmp_path / name).write_bytes(b"x")
    ann = list_observation_files(spark, str(tmp_path), since_year=2021, watermark_year=2023)
    assert [os.path.basename(p) for p in selected_paths(ann)] == ["2023.csv.gz", "2024.csv.gz"]
    sd = tmp_path / "storms"
    sd.mkdir()
    for name in ["StormEvents_details-ftp_v1.0_d2023_c20240101.csv.gz", "StormEvents_details-ftp_v1.0_d2024_c20240601.csv.gz",
                 "StormEvents_details-ftp_v1.0_d2024_c20250101.csv.gz", "StormEvents_fatalities-ftp_v1.0_d2024_c20250101.csv.gz"]:
        (sd / name).write_bytes(b"x")
    ann = list_storm_files(spark, str(sd), since_year=2024)
    assert [os.path.basename(p) for p in selected_paths(ann)] == ["StormEvents_details-ftp_v1.0_d2024_c20250101.csv.gz"]
    ann_all = list_storm_files(spark, str(sd), latest_stamp_only=False)
    assert len(selected_paths(ann_all)) == 3
