import datetime as dt
import gzip

from pyspark.sql import functions as F

from geoweather.operators.storms import normalise_storms
from geoweather.plans import jobs
from geoweather.schemas import STORM_EVENTS
from tests.test_sources import STORM_HEADER, storm_row, write_storm_file


def test_normalise_rejects_rows_not_files(spark, tmp_path):
    write_storm_file(str(tmp_path), "StormEvents_details-ftp_v1.0_d2024_c20250101.csv.gz", [
        storm_row(1, 202401, 5, 905),
        storm_row(2, 202402, 30, 0),  # no such day: kept, time NULL, reported
        storm_row(3, 202401, 5, 905, damage="ABCK"),  # bad number before suffix: rejected
        storm_row(4, 202401, 5, 905, magnitude="2.50"),
    ])
    from geoweather.sources import read_storm_files

    rows, issues = normalise_storms(read_storm_files(spark, str(tmp_path)))
    assert [f.name for f in rows.schema] == STORM_EVENTS.names
    got = {r.EVENT_ID: r for r in rows.collect()}
    assert set(got) == {1, 2, 4}
    assert got[1].BEGIN_DATE_TIME == dt.datetime(2024, 1, 5, 9, 5) and got[1].DAMAGE_PROPERTY == 10000.0
    assert got[1].MAGNITUDE == 2 and got[4].MAGNITUDE == 2 and got[1].BEGIN_LAT == 29.1
    assert got[2].BEGIN_DATE_TIME is None
    iss = {r.EVENT_ID: (r.rejected, r.reasons) for r in issues.collect()}
    assert iss == {2: (False, "BEGIN_DATE_TIME,END_DATE_TIME"), 3: (True, "DAMAGE_PROPERTY")}


def test_ingest_storms_replaces_newest_year(spark, tmp_path):
    src, target, issues = str(tmp_path / "src"), str(tmp_path / "storms"), str(tmp_path / "issues")
    write_storm_file(src, "StormEvents_details-ftp_v1.0_d2023_c20240101.csv.gz", [storm_row(1, 202305, 1, 100)])
    write_storm_file(src, "StormEvents_details-ftp_v1.0_d2024_c20240601.csv.gz", [storm_row(2, 202403, 1, 100)])
    out = jobs.ingest_storms(spark, src, target, issues_target=issues)
    assert out["files"] == 2 and out["watermark_year"] is None
    # a newer version of 2024 arrives: only 2024 is reloaded, 2023 stays
    write_storm_file(src, "StormEvents_details-ftp_v1.0_d2024_c20250101.csv.gz",
                     [storm_row(3, 202403, 1, 100), storm_row(4, 202404, 31, 100)])
    out = jobs.ingest_storms(spark, src, target, issues_target=issues)
    assert out["watermark_year"] == 2024 and out["files"] == 1
    table = jobs.read_storm_table(spark, target)
    assert sorted(r.EVENT_ID for r in table.collect()) == [1, 3, 4]
    assert spark.read.parquet(issues).where(F.col("EVENT_ID") == 4).count() == 1


def test_reject_filter_is_not_pushed_into_the_casts(spark):
    raw = spark.createDataFrame([("202401", "5", "905", "10K", "1")], "BEGIN_YEARMONTH string, BEGIN_DAY string, BEGIN_TIME string, DAMAGE_PROPERTY string, EVENT_ID string")
    rows, _ = normalise_storms(raw)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.split("\n") if "Filter" in line]
    assert filters and not any("RLIKE" in f for f in filters)


def test_stray_rows_bad_rows_and_bad_files(spark, tmp_path):
    src, target, issues = str(tmp_path / "src"), str(tmp_path / "storms"), str(tmp_path / "issues")
    name = "StormEvents_details-ftp_v1.0_d{}_c{}.csv.gz"
    write_storm_file(src, name.format(2020, 20210101), [storm_row(i, 202005, 1, 100) for i in range(10)])
    write_storm_file(src, name.format(2021, 20220101), [storm_row(20, 202105, 1, 100), storm_row(21, 202105, 1, 100, damage="ABCK")])
    jobs.ingest_storms(spark, src, target, issues_target=issues)
    # 2021 again, clean; 2022 with a row of 2020, a short line and columns in reverse order; 2023 damaged
    write_storm_file(src, name.format(2021, 20230101), [storm_row(21, 202105, 1, 100)])
    rows = [storm_row(30, 202205, 1, 100), storm_row(31, 202005, 1, 100)]
    flip = [",".join(reversed(x.split(","))) for x in [STORM_HEADER, *rows]]
    with gzip.open(f"{src}/{name.format(2022, 20230101)}", "wt") as f:
        f.write("\n".join([*flip, "CSV,only,three"]) + "\n")
    write_storm_file(src, name.format(2023, 20240101), [storm_row(i, 202305, 1, 100) for i in range(3000)])
    damaged = f"{src}/{name.format(2023, 20240101)}"
    whole = open(damaged, "rb").read()
    open(damaged, "wb").write(whole[: len(whole) // 2])
    out = jobs.ingest_storms(spark, src, target, issues_target=issues)
    assert out["files_failed"] == [name.format(2023, 20240101)]
    got = jobs.read_storm_table(spark, target)
    by_year = {r.YEAR: r["count"] for r in got.groupBy("YEAR").count().collect()}
    assert by_year == {2020: 10, 2021: 1, 2022: 1}
    assert got.where("EVENT_ID = 30").first().STATE == "TEXAS"
    said = {(r.EVENT_ID, r.reasons, r.file_year) for r in spark.read.parquet(issues).collect()}
    assert (31, "OTHER_YEAR", 2022) in said and (None, "UNREADABLE_FILE", 2023) in said
    assert any("MALFORMED" in reasons and year == 2022 for _, reasons, year in said)
    assert not any(year == 2021 for _, _, year in said)


def test_overlong_parts_are_reported_not_cut(spark):
    raw = spark.createDataFrame([("1", "202401", "123", "100"), ("2", "202401", "5", "12345"), ("3", "202401", "5", "930")], "EVENT_ID string, BEGIN_YEARMONTH string, BEGIN_DAY string, BEGIN_TIME string")
    rows, issues = normalise_storms(raw)
    times = {r.EVENT_ID: r.BEGIN_DATE_TIME for r in rows.collect()}
    assert times == {1: None, 2: None, 3: dt.datetime(2024, 1, 5, 9, 30)}
    assert {r.EVENT_ID for r in issues.collect()} == {1, 2}


def test_spread_rows_stay_a_fraction_of_a_split(spark):
    from geoweather.operators.storms import spread

    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(12 * cores).coalesce(1)
    for waves in (0, 1, 3):
        sizes = spread(rows, 1, waves).rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
        assert sum(sizes) == 12 * cores and len(sizes) == cores * max(waves, 1)
    assert spread(rows, cores) is rows
