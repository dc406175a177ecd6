"""Files in one job, recoverable refreshes, tables by name, footers, audit, clustered export."""

import datetime as dt
import glob
import gzip
import os
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from geoweather.plans import audit, catalog, footers, jobs, tables
from geoweather.plans.export import export_parquet
from geoweather.sources.listing import first_lines, list_files, readable_paths
from geoweather.sources.storms import header_groups
from tests.conftest import plan_text


def run_counted(spark, work):
    """What ``work`` returns, and how many Spark jobs it ran."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        out = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def write_files(folder, n):
    os.makedirs(folder, exist_ok=True)
    headers = ["A,B,C", "C,A", '"A", B ,C']
    for i in range(n):
        with gzip.open(os.path.join(folder, f"f{i:03d}.csv.gz"), "wt") as f:
            f.write(headers[i % 3] + "\n" + "\n".join(f"{i},{k},x" for k in range(i % 4)) + ("\n" if i % 4 else ""))
    gzip.open(os.path.join(folder, "g-empty.csv.gz"), "wt").close()


def test_headers_of_many_files_take_as_many_jobs_as_of_few(spark, tmp_path):
    jobs_needed = {}
    for n in (12, 200):
        folder = str(tmp_path / str(n))
        write_files(folder, n)
        paths = [r.path for r in list_files(spark, folder, "*.csv.gz").collect()]
        groups, jobs_needed[n] = run_counted(spark, lambda paths=paths: header_groups(spark, paths))
        assert set(groups) == {("A", "B", "C"), ("C", "A")}
        assert sorted(os.path.basename(p) for p in groups[("C", "A")]) == [f"f{i:03d}.csv.gz" for i in range(1, n, 3)]
        lines = {os.path.basename(r.path): r.lines for r in first_lines(spark, paths).collect()}
        assert lines["f002.csv.gz"] == 3 and lines["f004.csv.gz"] == 1 and "g-empty.csv.gz" not in lines
    assert jobs_needed[200] <= jobs_needed[12] + 1 <= 6  # Spark lists more than 32 paths in a job of its own; one file has no line and is tested


def test_damaged_files_are_found_in_one_job(spark, tmp_path):
    folder = str(tmp_path)
    write_files(folder, 40)
    whole = open(os.path.join(folder, "f007.csv.gz"), "rb").read()
    damage = {
        "f001.csv.gz": whole[:-6], "f002.csv.gz": b"plain text", "f003.csv.gz": whole[:-8] + b"\0\0\0\0" + whole[-4:],
    }
    for name, content in damage.items():
        with open(os.path.join(folder, name), "wb") as f:
            f.write(content)
    with open(os.path.join(folder, "f005.csv.gz"), "ab") as f:  # two members behind each other are one good file
        f.write(whole)
    paths = [r.path for r in list_files(spark, folder, "*.csv.gz").collect()]
    (good, bad), n = run_counted(spark, lambda: readable_paths(spark, paths))
    assert sorted(os.path.basename(p) for p in bad) == sorted(damage) and len(good) == len(paths) - 3 and n <= 3


# ---------------------------------------------------------------- recovery
ROWS = "id int, date date, year int, month int"


def month_rows(spark, spec):
    return spark.createDataFrame([(i, d, d.year, d.month) for i, d in spec], ROWS)


def ids(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).collect())


@pytest.mark.parametrize("where", ["_delete_folders", "overwrite_partitions"])
def test_range_refresh_stopped_half_way_is_finished_by_the_next(spark, tmp_path, monkeypatch, where):
    target = str(tmp_path / "t")
    D = dt.date
    old = month_rows(spark, [(1, D(2024, 1, 5)), (2, D(2024, 1, 25)), (3, D(2024, 2, 5)), (4, D(2024, 3, 5)), (5, D(2024, 3, 25))])
    tables.replace_date_range(spark, old, target, "2024-01-01", "2024-12-31")

    def stop(*_, **__):
        raise RuntimeError("stopped")

    new = month_rows(spark, [(10, D(2024, 1, 21))])
    with monkeypatch.context() as m:
        m.setattr(tables, where, stop)
        with pytest.raises(RuntimeError):
            tables.replace_date_range(spark, new, target, "2024-01-20", "2024-03-10")
    # the next refresh, of other days, first finishes the stopped one: February has no rows left and loses its folder
    out = tables.replace_date_range(spark, month_rows(spark, [(20, D(2024, 3, 31))]), target, "2024-03-31", "2024-03-31")
    assert ids(spark, target) == [1, 5, 10, 20] and out["rows_inserted"] == 1
    assert not os.path.exists(os.path.join(target, "year=2024", "month=2"))
    assert not os.path.exists(target + "_intent") and not tables.recover(spark, target)


def test_staged_rows_of_a_finished_refresh_are_gone(spark, tmp_path):
    from geoweather.session import shared_dir

    base = shared_dir(spark).replace("file:", "")
    target = str(tmp_path / "t")
    for i in range(2):
        tables.replace_date_range(spark, month_rows(spark, [(i, dt.date(2024, 1, 5))]), target, "2024-01-01", "2024-01-31")
    assert ids(spark, target) == [1]
    assert not [d for d in os.listdir(base) if d.startswith("range-replace-")]


def test_year_refresh_stopped_half_way_is_loaded_again(spark, tmp_path, monkeypatch):
    src, target = tmp_path / "obs", str(tmp_path / "t")
    src.mkdir()

    def write(year, value):
        with gzip.open(src / f"{year}.csv.gz", "wt") as f:
            f.write(f"USC00000001,{year}0101,PRCP,{value},,,7,\n")

    for y in (2021, 2022, 2024):
        write(y, 1)
    jobs.ingest_observations(spark, str(src), target)
    write(2021, 2)

    def stop(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(tables, "_delete_folders", stop)
        with pytest.raises(RuntimeError):
            tables.replace_years(spark, spark.read.parquet(target).where("false"), target, "year", [2021])
    assert tables.pending_years(spark, target) == [2021]
    # the watermark is 2024, but 2021 is pending
    assert jobs.ingest_observations(spark, str(src), target)["files"] == 3
    assert {r.year: r.data_value for r in spark.read.parquet(target).collect()} == {2021: 2, 2022: 1, 2024: 1}
    assert tables.pending_years(spark, target) == []
    assert jobs.ingest_observations(spark, str(src), target)["files"] == 1


# ---------------------------------------------------------------- names, footers, audit, clusters
def test_tables_by_name(spark, tmp_path):
    path, name = str(tmp_path / "t"), f"t_{uuid.uuid4().hex[:8]}"
    rows = spark.range(30).select("id", (F.col("id") % 3).cast("int").alias("year"))
    rows.write.partitionBy("year").parquet(path)
    catalog.register_table(spark, name, path, rows.schema, ("year",))
    assert catalog.open_table(spark, name).count() == 30 and catalog.open_table(spark, path).count() == 30
    assert catalog.table_statistics(spark, name)["rows"] == 30
    assert [(r.col_name, r.data_type, r.is_partition) for r in catalog.describe_table(spark, name).collect()] == [("id", "bigint", False), ("year", "int", True)]
    # a new partition is found, a removed one forgotten
    spark.range(5).withColumn("year", F.lit(9)).write.mode("append").partitionBy("year").parquet(path)
    tables._delete_folders(spark, path, ["year=0"])
    catalog.refresh_table(spark, name)
    assert sorted(r.year for r in spark.table(name).select("year").distinct().collect()) == [1, 2, 9]
    assert catalog.table_statistics(spark, name)["rows"] == 25
    assert "PartitionFilters: [isnotnull(year" in plan_text(spark.table(name).where("year = 9"))
    with pytest.raises(ValueError):
        catalog.open_table(spark, "no_such_table")
    assert catalog.drop_table(spark, name) and os.path.exists(path)
    assert not catalog.drop_table(spark, name)
    catalog.register_table(spark, name, path)
    assert catalog.drop_table(spark, name, files=True) and not os.path.exists(path)


def test_extremes_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(100).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date"))
    days.select("date", F.year("date").alias("year"), F.month("date").alias("month")).write.partitionBy("year", "month").parquet(path)
    df = footers.from_footers(spark, path, [F.max("date").alias("m"), F.count(F.lit(1)).alias("n")], F.col("month") == 3)
    assert "PushedAggregation: [MAX(date), COUNT(*)]" in plan_text(df)
    assert tuple(df.first()) == (dt.date(2024, 3, 31), 31)
    assert tables.resume_from(spark, path) == dt.date(2024, 4, 9)
    assert tables.resume_from(spark, str(tmp_path / "none")) == dt.date(2000, 1, 1)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_audit_keeps_every_run_and_errors(spark, tmp_path):
    path = str(tmp_path / "audit")
    for n in (5, 9):
        audit.audited(spark, path, "load", "t", lambda n=n: {"rows": n, "files": ["a"] * n, "note": "x", "flag": True, "none": None})

    def fails():
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        audit.audited(spark, path, "load", "t", fails)
    got = sorted((r.run_no, r.outcome, r.figure, r.amount, r.change) for r in audit.run_history(spark.read.parquet(path)).collect())
    assert got == [(1, "done", "files", 5, None), (1, "done", "rows", 5, None), (2, "done", "files", 9, 4), (2, "done", "rows", 9, 4), (3, "failed", "none", 0, None)]


def test_clustered_export_lets_readers_skip_row_groups(spark, tmp_path):
    rows = spark.range(40_000).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("key"), "id", (F.col("id") % 2).cast("int").alias("year"))
    touched = {}
    for kind, by in (("plain", ()), ("clustered", ("key",))):
        path = str(tmp_path / kind)
        export_parquet(rows, path, ("year",), rows_per_group=1000, cluster_by=by)
        assert spark.read.parquet(path).where("key between 10 and 12").count() == rows.where("key between 10 and 12").count()
        stats = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/**/*.parquet", recursive=True)]
        groups = [m.row_group(g).column(0).statistics for m in stats for g in range(m.num_row_groups)]
        touched[kind] = sum(1 for s in groups if s.max >= 10 and s.min <= 12), len(groups)
    assert touched["plain"][0] == touched["plain"][1] and touched["clustered"][0] <= 0.2 * touched["clustered"][1]
