import csv
import gzip

import pytest

from geoweather.plans import jobs, versions
from geoweather.schemas import STORM_EVENTS
from geoweather.streaming import start_storm_ingest
from geoweather.streaming.storm_files import stored_stamps
from tests.test_sources import STORM_HEADER, storm_row, write_storm_file


def test_storm_stream_available_now(spark, tmp_path):
    landing, target, ckpt = str(tmp_path / "landing"), str(tmp_path / "storms"), str(tmp_path / "ckpt")
    write_storm_file(landing, "StormEvents_details-ftp_v1.0_d2023_c20240101.csv.gz", [storm_row(1, 202305, 1, 100)])
    write_storm_file(landing, "StormEvents_details-ftp_v1.0_d2024_c20240601.csv.gz", [storm_row(2, 202403, 1, 100)])
    q = start_storm_ingest(spark, landing, target, ckpt)
    q.awaitTermination(300)
    assert sorted(r.EVENT_ID for r in spark.read.parquet(target).collect()) == [1, 2]
    # a new version of 2024 lands: the next run sees only that file and replaces 2024
    write_storm_file(landing, "StormEvents_details-ftp_v1.0_d2024_c20250101.csv.gz", [storm_row(3, 202403, 2, 100)])
    q = start_storm_ingest(spark, landing, target, ckpt)
    q.awaitTermination(300)
    assert sorted(r.EVENT_ID for r in spark.read.parquet(target).collect()) == [1, 3]


def _ids(spark, path):
    return sorted(r.EVENT_ID for r in spark.read.parquet(path).collect())


def test_older_version_arriving_later_is_ignored(spark, tmp_path):
    for per_trigger in (None, 1):
        base = tmp_path / f"t{per_trigger}"
        landing, target, ckpt, issues = (str(base / x) for x in ("landing", "storms", "ckpt", "issues"))
        name = "StormEvents_details-ftp_v1.0_d2020_c{}.csv.gz"
        write_storm_file(landing, name.format(20220101), [storm_row(i, 202005, 1, 100) for i in (1, 2)] + [storm_row(5, 202005, 1, 100, damage="ABCK")])
        start_storm_ingest(spark, landing, target, ckpt, issues, max_files_per_trigger=per_trigger).awaitTermination(300)
        assert _ids(spark, target) == [1, 2] and _ids(spark, issues) == [5]
        write_storm_file(landing, name.format(20210101), [storm_row(8, 202005, 1, 100)])
        start_storm_ingest(spark, landing, target, ckpt, issues, max_files_per_trigger=per_trigger).awaitTermination(300)
        assert _ids(spark, target) == [1, 2] and _ids(spark, issues) == [5]
        # a clean newer version clears the year's issues; a stray row of another year replaces nothing
        write_storm_file(landing, name.format(20230101), [storm_row(5, 202005, 1, 100), storm_row(9, 201905, 1, 100)])
        start_storm_ingest(spark, landing, target, ckpt, issues, max_files_per_trigger=per_trigger).awaitTermination(300)
        assert _ids(spark, target) == [5]
        assert [(r.EVENT_ID, r.reasons) for r in spark.read.parquet(issues).collect()] == [(9, "OTHER_YEAR")]


def _run(spark, base, **more):
    landing, target, ckpt, issues = (str(base / x) for x in ("landing", "storms", "ckpt", "issues"))
    start_storm_ingest(spark, landing, target, ckpt, issues, **more).awaitTermination(300)
    return target, issues


def test_stream_rejects_truncated_rows_and_reads_other_column_orders_like_the_batch_job(spark, tmp_path):
    columns = STORM_HEADER.split(",")
    rows = [dict(zip(columns, storm_row(*r, 100).split(","))) for r in ((1, 202105, 1), (2, 202105, 2), (77, 202105, 3), (9, 202206, 1))]
    *good, bad, other = rows
    landing = tmp_path / "landing"
    landing.mkdir()

    def write(name, header, rows):
        with gzip.open(landing / name, "wt", newline="") as f:
            w = csv.writer(f)
            w.writerow(header)
            for row in rows:
                w.writerow(row)

    cut = columns[: columns.index("YEAR") + 1]
    write("StormEvents_details-ftp_v1.0_d2021_c20220101.csv.gz", columns, [[r[c] for c in columns] for r in good] + [[bad[c] for c in cut]])
    turned = [c for c in reversed(columns) if c != "WFO"]
    write("StormEvents_details-ftp_v1.0_d2022_c20230101.csv.gz", turned, [[other[c] for c in turned]])
    target, issues = _run(spark, tmp_path)
    batch, batch_issues = str(tmp_path / "batch"), str(tmp_path / "batch_issues")
    jobs.ingest_storms(spark, str(landing), batch, issues_target=batch_issues)
    assert _ids(spark, target) == _ids(spark, batch) == [1, 2, 9]
    found, want = ([(r.EVENT_ID, r.reasons) for r in spark.read.parquet(p).collect()] for p in (issues, batch_issues))
    assert found == want == [(77, "MALFORMED")]
    both = [sorted(map(str, spark.read.parquet(p).select(*STORM_EVENTS.fieldNames()).collect())) for p in (target, batch)]
    assert both[0] == both[1]


def test_batch_stopped_between_rows_and_stamps_is_run_again(spark, tmp_path, monkeypatch):
    name = "StormEvents_details-ftp_v1.0_d2020_c{}.csv.gz"
    landing = str(tmp_path / "landing")
    write_storm_file(landing, name.format(20220101), [storm_row(1, 202005, 1, 100)])
    _run(spark, tmp_path)
    write_storm_file(landing, name.format(20230101), [storm_row(2, 202005, 1, 100)])

    write = versions.write_version

    def stop(df, path, **more):
        if not path.endswith("_intent"):
            raise RuntimeError("stopped before the stamps")
        return write(df, path, **more)

    with monkeypatch.context() as m:
        m.setattr(versions, "write_version", stop)
        with pytest.raises(Exception, match="stopped before the stamps"):
            _run(spark, tmp_path)
    # the rows are in, the stamps are not: the older stamps are still readable and the batch comes again
    assert stored_stamps(spark, str(tmp_path / "storms_versions")) == {2020: 20220101}
    write_storm_file(landing, name.format(20210101), [storm_row(3, 202005, 1, 100)])
    target, _ = _run(spark, tmp_path)
    assert _ids(spark, target) == [2]
    assert stored_stamps(spark, str(tmp_path / "storms_versions")) == {2020: 20230101}


def test_stream_reports_damaged_files_and_loads_the_others(spark, tmp_path):
    landing = tmp_path / "landing"
    write_storm_file(str(landing), "StormEvents_details-ftp_v1.0_d2020_c20220101.csv.gz", [storm_row(1, 202005, 1, 100)])
    (landing / "StormEvents_details-ftp_v1.0_d2021_c20220101.csv.gz").write_bytes(b"\x1f\x8b\x08 no gzip")
    target, issues = _run(spark, tmp_path)
    assert _ids(spark, target) == [1]
    assert [(r.file_year, r.reasons) for r in spark.read.parquet(issues).collect()] == [(2021, "UNREADABLE_FILE")]
