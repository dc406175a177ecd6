import datetime as dt
import glob
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from geoweather.operators.replace import refresh_audit, replace_newest_year
from geoweather.plans import tables
from geoweather.plans.export import export_parquet
from geoweather.sources.lake import lake_view


def _years(spark, rows):
    return spark.createDataFrame(rows, "id long, year int, v string")


def test_replace_years_keeps_untouched_and_is_idempotent(spark, tmp_path):
    target = str(tmp_path / "t")
    tables.replace_years(spark, _years(spark, [(1, 2022, "a"), (2, 2023, "a"), (3, 2024, "a")]), target, "year", [2022, 2023, 2024])
    new = _years(spark, [(4, 2024, "b"), (5, 2025, "b")])
    for _ in range(2):
        out = tables.replace_years(spark, new, target, "year", [2024, 2025])
        got = sorted((r.id, r.year, r.v) for r in spark.read.parquet(target).collect())
        assert got == [(1, 2022, "a"), (2, 2023, "a"), (4, 2024, "b"), (5, 2025, "b")]
        assert out["rows_loaded"] == 2


def test_replace_years_leaves_other_years_alone(spark, tmp_path):
    target = str(tmp_path / "t")
    old = [(i, y, "a") for i, y in enumerate([2022] * 20 + [2023] * 20 + [2024])]
    tables.replace_years(spark, _years(spark, old), target, "year", [2022, 2023, 2024])
    stray = _years(spark, [(100 + i, 2025, "b") for i in range(20)] + [(200, 2022, "b"), (201, None, "b")])
    out = tables.replace_years(spark, stray, target, "year", [2024, 2025])
    counts = {r.year: r["count"] for r in spark.read.parquet(target).groupBy("year").count().collect()}
    assert counts == {2022: 20, 2023: 20, 2025: 20}  # 2024 was reloaded and has no rows now
    assert out == {"rows_loaded": 20, "rows_other_years": 2}
    empty = _years(spark, []).where("false")
    assert tables.replace_years(spark, empty, target, "year", [2025])["rows_loaded"] == 0
    assert tables.partition_numbers(spark, target, "year") == [2022, 2023]


def test_append_rows_conforms(spark, tmp_path):
    from geoweather.schemas import OBSERVATIONS

    target = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", "2024-01-01", "7", 2024)], "id string, date string, data_value string, year int")
    for _ in range(2):
        assert tables.append_rows(rows, target, OBSERVATIONS, ("year",)) == 1
    back = spark.read.parquet(target)
    assert back.count() == 2 and back.select(*OBSERVATIONS.fieldNames()).schema == OBSERVATIONS
    assert {(r.date, r.data_value, r.element) for r in back.collect()} == {(dt.date(2024, 1, 1), 7, None)}


def test_replace_date_range_stages_edge_months_only(spark, tmp_path):
    target, d = str(tmp_path / "m"), dt.date
    days = [d(2024, 1, 5), d(2024, 1, 25), d(2024, 2, 10), d(2024, 3, 5), d(2024, 3, 25), d(2024, 4, 1)]
    tables.replace_date_range(spark, _metric_rows(spark, [("z", x, 1.0) for x in days]), target, "2024-01-01", "2024-12-31")
    new = _metric_rows(spark, [("z", d(2024, 2, 11), 9.0), ("z", d(2024, 3, 6), 9.0), ("z", d(2024, 5, 1), 9.0)])
    res = tables.replace_date_range(spark, new, target, "2024-01-20", "2024-03-10")
    got = sorted((r.date, r.v) for r in spark.read.parquet(target).collect())
    assert got == [(days[0], 1.0), (d(2024, 2, 11), 9.0), (d(2024, 3, 6), 9.0), (days[4], 1.0), (days[5], 1.0)]
    assert (res["rows_deleted"], res["rows_inserted"]) == (3, 2)


def test_resume_from_reports_unreadable_tables(spark, tmp_path):
    import pytest

    p = str(tmp_path / "t")
    spark.createDataFrame([(1,)], "other int").write.parquet(p)
    with pytest.raises(Exception, match="date"):
        tables.resume_from(spark, p)


def test_replace_newest_year_query(spark):
    existing = _years(spark, [(1, 2022, "a"), (2, 2023, "a"), (3, 2023, "a"), (9, None, "n")])
    incoming = _years(spark, [(4, 2021, "b"), (5, 2023, "b"), (6, 2024, "b")])
    got = sorted((r.id, r.v) for r in replace_newest_year(existing, incoming, "year").collect())
    assert got == [(1, "a"), (5, "b"), (6, "b"), (9, "n")]
    audit = refresh_audit(existing, incoming, "year").collect()[0]
    assert (audit.rows_before, audit.rows_deleted, audit.rows_loaded, audit.rows_after) == (4, 2, 2, 4)
    empty = existing.limit(0)
    assert replace_newest_year(empty, incoming, "year").count() == 3


def _metric_rows(spark, rows):
    df = spark.createDataFrame(rows, "zipcode string, date date, v double")
    return df.select("*", F.year("date").alias("year"), F.month("date").alias("month"))


def test_replace_date_range_removes_emptied_partitions(spark, tmp_path):
    target = str(tmp_path / "m")
    d = dt.date
    base = _metric_rows(spark, [("z", d(2024, 1, 30), 1.0), ("z", d(2024, 2, 10), 2.0), ("z", d(2024, 3, 1), 3.0)])
    tables.replace_date_range(spark, base, target, "2024-01-01", "2024-12-31")
    new = _metric_rows(spark, [("z", d(2024, 1, 31), 9.0)])
    for _ in range(2):  # idempotent
        res = tables.replace_date_range(spark, new, target, "2024-01-15", "2024-02-28")
        got = sorted((r.date, r.v) for r in spark.read.parquet(target).collect())
        assert got == [(d(2024, 1, 31), 9.0), (d(2024, 3, 1), 3.0)]
        assert not glob.glob(os.path.join(target, "year=2024", "month=2"))
    assert res["rows_inserted"] == 1


def test_resume_from(spark, tmp_path):
    missing = str(tmp_path / "nope")
    assert tables.resume_from(spark, missing) == dt.date(2000, 1, 1)
    p = str(tmp_path / "empty")
    spark.createDataFrame([], "date date").write.parquet(p)
    assert tables.resume_from(spark, p) == dt.date(1900, 1, 1)
    p2 = str(tmp_path / "some")
    spark.createDataFrame([(dt.date(2024, 5, 1),), (dt.date(2024, 5, 3),)], "date date").write.parquet(p2)
    assert tables.resume_from(spark, p2) == dt.date(2024, 5, 3)


def test_export_partitions_where_and_row_groups(spark, tmp_path):
    dest = str(tmp_path / "lake")
    df = spark.createDataFrame(
        [(i, 2024, 1 + i % 2, "TX" if i % 3 else "OK") for i in range(10)], "id long, year int, month int, state string"
    )
    export_parquet(df, dest, where="state = 'OK' OR id = 1", rows_per_group=2)
    got = sorted(r.id for r in lake_view(spark, dest).collect())
    assert got == [0, 1, 3, 6, 9]  # the OR stays one unit: no row leaks into other partitions
    files = glob.glob(os.path.join(dest, "year=2024", "month=*", "*.parquet"))
    assert max(pq.ParquetFile(f).metadata.num_row_groups for f in files) >= 2
    # a second export of other partitions keeps the first one's partitions
    df2 = spark.createDataFrame([(100, 2025, 1, "OK")], "id long, year int, month int, state string")
    export_parquet(df2, dest)
    assert sorted(r.id for r in lake_view(spark, dest).collect()) == [0, 1, 3, 6, 9, 100]
    # re-export of a partition replaces it whole
    export_parquet(df.where("id = 0"), dest)
    assert sorted(r.id for r in lake_view(spark, dest).collect()) == [0, 1, 3, 9, 100]


def test_stage_removes_its_folder(spark):
    from geoweather.plans.tables import stage

    df = spark.range(100).withColumn("p", F.col("id") % 3)
    with stage(spark, df, "stage-test", ["p"]) as staged:
        files = [f.replace("file:", "") for f in staged.inputFiles()]
        assert files and all(os.path.exists(f) for f in files)
        assert staged.count() == 100
    assert not any(os.path.exists(f) for f in files)
