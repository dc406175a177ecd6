import datetime as dt
import gzip
import os

from pyspark.sql import functions as F

from geoweather.plans import jobs
from geoweather.sources.lake import lake_view
from tests.test_sources import _station_line


def _write_obs(folder, year, lines):
    os.makedirs(folder, exist_ok=True)
    with gzip.open(os.path.join(folder, f"{year}.csv.gz"), "wt") as f:
        f.write("\n".join(lines) + "\n")


def _staged(spark) -> set[str]:
    """Staging folders of range refreshes currently under the shared folder."""
    from geoweather.session import shared_dir

    base = shared_dir(spark).replace("file:", "")
    return {d for d in os.listdir(base) if d.startswith("range-replace-")}


def test_end_to_end_jobs(spark, tmp_path):
    t = str(tmp_path)
    stations_txt = os.path.join(t, "stations.txt")
    with open(stations_txt, "w") as f:
        f.write("\n".join([
            _station_line("USW00000001", "40.0000", "-75.0000", "10.0", "PA", "NEAR ONE", "", "", ""),
            _station_line("USW00000002", "40.1000", "-75.0000", "12.0", "PA", "NEAR TWO", "", "", ""),
            _station_line("USW00000003", "45.0000", "-75.0000", "12.0", "NY", "FAR AWAY", "", "", ""),
        ]) + "\n")
    gaz = os.path.join(t, "zcta.txt")
    with open(gaz, "w") as f:
        f.write("GEOID\tALAND\tAWATER\tALAND_SQMI\tAWATER_SQMI\tINTPTLAT\tINTPTLONG      \n")
        f.write("19001\t1\t0\t1.0\t0.0\t40.05\t-75.0   \n")
        f.write("00601\t1\t0\t1.0\t0.0\t18.18\t-66.75   \n")
    src = os.path.join(t, "ghcn")
    _write_obs(src, 2023, ["USW00000001,20231231,PRCP,4,,,W,"])
    _write_obs(src, 2024, [
        "USW00000001,20240101,PRCP,10,,,W,0700",
        "USW00000002,20240101,PRCP,20,,,W,",
        "USW00000002,20240102,TMAX,50,,,W,",
        "USW00000003,20240102,TMAX,99,,,W,",
    ])
    stn_t, zip_t, obs_t = (os.path.join(t, n) for n in ("stations", "zipcodes", "obs"))
    links_t, met_t, lake = (os.path.join(t, n) for n in ("links", "metrics", "lake"))

    assert jobs.load_stations(spark, stations_txt, stn_t)["rows"] == 3
    assert jobs.load_zipcodes(spark, gaz, zip_t)["rows"] == 2
    first = jobs.ingest_observations(spark, src, obs_t)
    assert first["files"] == 2 and first["rows_loaded"] == 5
    # a re-run reloads only the newest loaded year (2024), with new content
    _write_obs(src, 2024, ["USW00000001,20240101,PRCP,30,,,W,0700", "USW00000002,20240102,TMAX,50,,,W,"])
    again = jobs.ingest_observations(spark, src, obs_t)
    assert again["watermark_year"] == 2024 and again["files"] == 1
    assert spark.read.parquet(obs_t).count() == 3

    out = jobs.link_stations(spark, zip_t, stn_t, links_t, k=20)
    assert out["rows"] == 2 and out["sample"][0]["zipcode"] == "19001"  # the third station is ~340 miles away

    staged_before = _staged(spark)
    res = jobs.compute_daily_metrics(spark, obs_t, links_t, met_t, "2023-12-01", "2024-01-31", max_miles=20.0)
    rows = {(r.zipcode, r.date): r for r in spark.read.parquet(met_t).collect()}
    assert set(rows) == {("19001", dt.date(2023, 12, 31)), ("19001", dt.date(2024, 1, 1)), ("19001", dt.date(2024, 1, 2))}
    assert rows[("19001", dt.date(2024, 1, 1))].prcp == 30.0
    assert rows[("19001", dt.date(2024, 1, 2))].tmax == 50.0 and rows[("19001", dt.date(2024, 1, 2))].tmax_count == 1
    assert {c["metric"]: c["with_data"] for c in res["coverage"]}["prcp"] == 2
    # incremental run: resumes from the newest stored date, which is recomputed
    res2 = jobs.compute_daily_metrics(spark, obs_t, links_t, met_t, max_date="2024-01-31")
    assert res2["min_date"] == "2024-01-02" and res2["rows_deleted"] == 1 and res2["rows_inserted"] == 1
    assert spark.read.parquet(met_t).count() == 3
    # the refreshes removed their staged copies from the shared folder
    assert _staged(spark) == staged_before

    exp = jobs.export_table(spark, met_t, lake, ("year", "month"), where="prcp IS NOT NULL OR tmax > 0")
    assert exp["partitions"] == 2
    back = lake_view(spark, lake)
    assert back.count() == 3 and back.where(F.col("year") == 2023).count() == 1


def test_stray_and_keyless_observations_go_to_rejects(spark, tmp_path):
    src, target, rejects = tmp_path / "obs", str(tmp_path / "t"), str(tmp_path / "r")
    src.mkdir()

    def write(year, lines):
        with gzip.open(src / f"{year}.csv.gz", "wt") as f:
            f.write("\n".join(lines) + "\n")

    good = [f"USC{i:08d},2022{1 + i % 12:02d}01,PRCP,{i},,,7," for i in range(20)]
    write(2022, good)
    jobs.ingest_observations(spark, str(src), target, rejects_target=rejects)
    write(2024, [g.replace(",2022", ",2024") for g in good] + ["USC00000001,20220101,PRCP,1,,,7,", ",,,,,,,", "USC00000002,,PRCP,1,,,7,", "USC00000003,20240101"])
    out = jobs.ingest_observations(spark, str(src), target, rejects_target=rejects)
    years = {r.year: r["count"] for r in spark.read.parquet(target).groupBy("year").count().collect()}
    assert years == {2022: 20, 2024: 20}
    assert out["rows_rejected"] == 4 and spark.read.parquet(rejects).where("file_year = 2024").count() == 4
