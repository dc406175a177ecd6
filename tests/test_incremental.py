"""Incremental refreshes give what a rebuild gives."""

import datetime as dt
import gzip
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from geoweather.operators.compare import compare_tables, reconcile_inventory
from geoweather.operators.link_refresh import refresh_links
from geoweather.operators.metrics import daily_metrics
from geoweather.operators.moments import merge_moments, metrics_from_moments, station_day_moments
from geoweather.operators.nearest import nearest_stations
from geoweather.operators.sphere import nearest_stations_on_sphere
from geoweather.plans import jobs, versions

OBS = "id string, date date, element string, data_value int, m_flag string, q_flag string, s_flag string, obs_time string"
LINKS = "zipcode string, station_id string, distance_miles double"
ZIPS = "zipcode string, zipcode_latitude double, zipcode_longitude double"
STATIONS = "station_id string, station_name string, station_latitude double, station_longitude double"


# ---------------------------------------------------------------- changed files
def write_year(folder, year, lines, touched=None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{year}.csv.gz")
    with gzip.open(path, "wt") as f:
        f.write("\n".join(lines) + "\n")
    if touched:
        os.utime(path, (touched, touched))


def loaded(spark, target):
    return sorted((r.id, str(r.date), r.data_value) for r in spark.read.parquet(target).collect())


def line(year, value, station="USC00000001"):
    return f"{station},{year}0105,PRCP,{value},,,7,"


def test_old_year_rewritten_in_place_is_reloaded(spark, tmp_path):
    src, target, snap = (str(tmp_path / x) for x in ("src", "obs", "snapshot"))
    for y in (2021, 2022, 2024):
        write_year(src, y, [line(y, 1)])
    first = jobs.refresh_observations(spark, src, target, snap)
    assert first["years"] == [2021, 2022, 2024] and first["rows_loaded"] == 3
    assert jobs.refresh_observations(spark, src, target, snap)["files"] == 0
    # an old year is rewritten under its name: the newest-year rule would not read it again
    write_year(src, 2021, [line(2021, 5), line(2021, 6, "USC00000002")], touched=2_000_000_000)
    again = jobs.refresh_observations(spark, src, target, snap)
    assert again["years"] == [2021] and again["rows_loaded"] == 2
    assert [v for _, d, v in loaded(spark, target) if d.startswith("2021")] == [5, 6]
    # same length and same content, but an older copy: the time alone shows it
    write_year(src, 2022, [line(2022, 9)], touched=1_000_000_000)
    assert jobs.refresh_observations(spark, src, target, snap)["years"] == [2022]
    os.remove(os.path.join(src, "2024.csv.gz"))
    gone = jobs.refresh_observations(spark, src, target, snap)
    assert gone["files_gone"] == ["2024.csv.gz"] and gone["files"] == 0
    assert len(loaded(spark, target)) == 4
    assert jobs.refresh_observations(spark, src, target, snap)["files_gone"] == []


def test_damaged_file_is_tried_again_and_a_stopped_run_repeats(spark, tmp_path, monkeypatch):
    src, target, snap = (str(tmp_path / x) for x in ("src", "obs", "snapshot"))
    write_year(src, 2021, [line(2021, 1)])
    write_year(src, 2022, [line(2022, 1)])
    with open(os.path.join(src, "2022.csv.gz"), "r+b") as f:
        f.write(b"not gzip at all")
    out = jobs.refresh_observations(spark, src, target, snap)
    assert out["files_failed"] == ["2022.csv.gz"] and out["years"] == [2021]
    assert jobs.refresh_observations(spark, src, target, snap)["files_failed"] == ["2022.csv.gz"]
    write_year(src, 2022, [line(2022, 4)])

    write = versions.write_version

    def stop(df, path, **more):
        if not path.endswith("_intent"):
            raise RuntimeError("stopped before the snapshot")
        return write(df, path, **more)

    with monkeypatch.context() as m:
        m.setattr(versions, "write_version", stop)
        with pytest.raises(RuntimeError):
            jobs.refresh_observations(spark, src, target, snap)
    assert jobs.refresh_observations(spark, src, target, snap)["years"] == [2022]
    assert [v for *_, v in loaded(spark, target)] == [1, 4]


def test_versions_ignore_unfinished_writes(spark, tmp_path):
    path = str(tmp_path / "state")
    assert versions.read_version(spark, path) is None
    for n in (1, 2, 3):
        assert versions.write_version(spark.range(n), path) == n
    assert sorted(os.listdir(path)) == ["version=0000000002", "version=0000000003"]
    half = os.path.join(path, "version=0000000004")
    os.makedirs(half)
    open(os.path.join(half, "part-0"), "w").close()
    assert versions.read_version(spark, path).count() == 3
    assert versions.write_version(spark.range(7), path) == 5
    assert versions.read_version(spark, path).count() == 7 and not os.path.exists(half)


# ---------------------------------------------------------------- comparison
def test_comparison_treats_nulls_as_equal(spark):
    schema = "id string, element string, firstyear int, lastyear int"
    old = [("a", "X", 1990, 2000), ("b", None, 1990, 2000), ("c", "X", 1990, None), ("d", "X", 1, 2), (None, "X", 1, 2)]
    new = [("a", "X", 1990, 2001), ("b", None, 1990, 2000), ("c", "X", 1990, None), ("e", "X", 1, 2), (None, "X", 1, 2)]
    o, n = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    got = {(r.id, r.element): r["class"] for r in reconcile_inventory(o, n).collect()}
    assert got == {("a", "X"): "other years", ("b", None): "same", ("c", "X"): "same", ("d", "X"): "missing", ("e", "X"): "extra", (None, "X"): "same"}
    assert compare_tables(o.limit(0), n, ["id", "element"], ["firstyear"]).where("change <> 'new'").count() == 0


# ---------------------------------------------------------------- moments
def some_observations(seed=1, n=3000):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        element = rng.choice(["PRCP", "SNOW", "SNWD", "TMAX", "TMIN", "WT01", None])
        value = rng.choice([None, rng.randint(-500, 500), 2_000_000_000 + rng.randint(0, 9)])
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(70))
        rows.append((f"S{rng.randrange(12)}", day, element, value, None, rng.choice([None, None, "X"]), "W", None))
    return rows


def some_links():
    return [(f"Z{z}", f"S{s}", float(abs(5 * z - 3 * s))) for z in range(6) for s in range(13)]


def figures(df):
    out = {}
    for r in df.collect():
        d = r.asDict()
        out[(d.pop("zipcode"), d.pop("date"))] = d
    return out


def same_figures(got, want):
    assert got.keys() == want.keys() and got
    for key in want:
        for c, v in want[key].items():
            g = got[key][c]
            assert (g is None) == (v is None), (key, c, g, v)
            assert v is None or math.isclose(g, v, rel_tol=1e-9, abs_tol=1e-6), (key, c, g, v)


@pytest.mark.parametrize("miles", [4.0, 60.0])
def test_metrics_from_merged_moments_equal_daily_metrics(spark, miles):
    rows = some_observations()
    links = spark.createDataFrame(some_links(), LINKS)
    parts = [station_day_moments(spark.createDataFrame(rows[i::3], OBS)) for i in range(3)]
    merged = merge_moments(merge_moments(parts[0], parts[2]), parts[1])
    lo, hi = "2024-01-10", "2024-02-20"
    want = figures(daily_metrics(spark.createDataFrame(rows, OBS), links, lo, hi, max_miles=miles))
    same_figures(figures(metrics_from_moments(merged, links, lo, hi, miles)), want)


def test_spread_does_not_cancel(spark):
    rows = [("S1", dt.date(2024, 1, 1), "PRCP", 2_000_000_000 + v, None, None, "W", None) for v in (0, 1, 2)]
    links = spark.createDataFrame([("Z1", "S1", 1.0)], LINKS)
    r = metrics_from_moments(station_day_moments(spark.createDataFrame(rows, OBS)), links, "2024-01-01", "2024-01-01").first()
    assert r.prcp == 2_000_000_001 and r.prcp_stddev == 1.0 and r.prcp_count == 3


def test_moment_jobs_backfill_only_touched_months(spark, tmp_path):
    obs, links, target, met = (str(tmp_path / x) for x in ("obs", "links", "moments", "metrics"))
    rows = some_observations(2)
    spark.createDataFrame(rows[:2000], OBS).withColumn("year", F.year("date")).write.partitionBy("year").parquet(obs)
    spark.createDataFrame(some_links(), LINKS).write.parquet(links)
    jobs.refresh_moments(spark, obs, target, "2024-01-01", "2024-12-31")
    march = {f: os.path.getmtime(os.path.join(target, "year=2024/month=3", f)) for f in os.listdir(os.path.join(target, "year=2024/month=3"))}
    late = [r for r in rows[2000:] if r[1] < dt.date(2024, 3, 1)]
    assert jobs.backfill_moments(spark, spark.createDataFrame(late, OBS), target) == {"months": 2}
    assert march == {f: os.path.getmtime(os.path.join(target, "year=2024/month=3", f)) for f in os.listdir(os.path.join(target, "year=2024/month=3"))}
    jobs.compute_daily_metrics(spark, "no such table", links, met, "2024-01-01", "2024-12-31", 30.0, moments_path=target)
    want = daily_metrics(spark.createDataFrame(rows[:2000] + late, OBS), spark.createDataFrame(some_links(), LINKS), "2024-01-01", "2024-12-31", max_miles=30.0)
    same_figures(figures(spark.read.parquet(met).select(*want.columns)), figures(want))


# ---------------------------------------------------------------- links
def points(rng, n, kind, lat=(30.0, 36.0), lon=(-100.0, -92.0)):
    out = []
    for i in range(n):
        p = (round(rng.uniform(*lat), 2), round(rng.uniform(*lon), 2))
        out.append((f"{kind}{i:03d}", *([f"name {i}"] if kind == "S" else []), *p))
    return out


def sorted_rows(df):
    return sorted(tuple(r[c] for c in ("zipcode", "rank", "station_id", "station_name", "station_latitude", "zipcode_longitude")) for r in df.collect())


@pytest.mark.parametrize("seed,k,miles", [(1, 5, 150.0), (2, 20, 90.0)])
def test_refreshed_links_equal_a_full_rebuild(spark, seed, k, miles):
    rng = random.Random(seed)
    zips, stations = points(rng, 60, "Z"), points(rng, 80, "S")
    zips_after = [(z, la + (1.0 if z.endswith("4") else 0.0), lo) for z, la, lo in zips if not z.endswith("9")]
    zips_after += [("Znew", 33.0, -95.0), ("Znull", None, -95.0)]
    after = [(s, n + ("!" if s.endswith("7") else ""), la, lo + (0.8 if s.endswith("3") else 0.0)) for s, n, la, lo in stations if not s.endswith("5")]
    after += [(f"T{i}", "new", round(rng.uniform(30, 36), 2), round(rng.uniform(-100, -92), 2)) for i in range(9)]
    after += [("S000tie", "tie", *after[0][2:])]
    z, s = (spark.createDataFrame(zips, ZIPS), spark.createDataFrame(zips_after, ZIPS)), (spark.createDataFrame(stations, STATIONS), spark.createDataFrame(after, STATIONS))
    before = nearest_stations(z[0], s[0], k=k, max_miles=miles)
    assert sorted_rows(refresh_links(before, z, s, k=k, max_miles=miles)) == sorted_rows(nearest_stations(z[1], s[1], k=k, max_miles=miles))


def test_refresh_without_changes_keeps_links(spark):
    rng = random.Random(9)
    z, s = spark.createDataFrame(points(rng, 20, "Z"), ZIPS), spark.createDataFrame(points(rng, 20, "S"), STATIONS)
    links = nearest_stations(z, s, k=4)
    assert sorted_rows(refresh_links(links, (z, z), (s, s), k=4)) == sorted_rows(links)


def test_relink_job_rewrites_the_table(spark, tmp_path):
    gaz = "GEOID string, INTPTLAT double, INTPTLONG double"
    stn = "id string, name string, latitude double, longitude double"
    paths = {n: str(tmp_path / n) for n in ("z", "old", "new", "links")}
    spark.createDataFrame([("1", 33.0, -95.0), ("2", 34.0, -95.0)], gaz).write.parquet(paths["z"])
    spark.createDataFrame([("A", "a", 33.1, -95.0), ("B", "b", 33.3, -95.0)], stn).write.parquet(paths["old"])
    spark.createDataFrame([("B", "b", 33.3, -95.0), ("C", "c", 33.2, -95.0)], stn).write.parquet(paths["new"])
    jobs.link_stations(spark, paths["z"], paths["old"], paths["links"], k=2)
    jobs.relink_stations(spark, paths["links"], (paths["z"], paths["z"]), (paths["old"], paths["new"]), k=2)
    got = sorted((r.zipcode, r.rank, r.station_id) for r in spark.read.parquet(paths["links"]).collect())
    assert got == [("1", 1, "C"), ("1", 2, "B"), ("2", 1, "B"), ("2", 2, "C")]


# ---------------------------------------------------------------- sphere
def miles_between(a, b):
    (la, lo), (lb, mo) = a, b
    h = math.sin(math.radians(lb - la) / 2) ** 2 + math.cos(math.radians(la)) * math.cos(math.radians(lb)) * math.sin(math.radians(mo - lo) / 2) ** 2
    return 2 * 3956 * math.asin(min(1.0, math.sqrt(h)))


@pytest.mark.parametrize("miles,k,pairs", [(150.0, 4, 4_000_000), (900.0, 7, 40), (6000.0, 5, 500)])
def test_sphere_search_equals_plain_distances(spark, miles, k, pairs):
    rng = random.Random(int(miles))
    zips = [(f"Z{i}", rng.choice([rng.uniform(-90, 90), 89.9, -90.0, 70.0]), rng.choice([rng.uniform(-180, 180), 179.95, -179.99, 180.0])) for i in range(60)]
    stations = [(f"S{i:03d}", "n", rng.choice([rng.uniform(-90, 90), 90.0, -89.5, 70.3]), rng.choice([rng.uniform(-180, 180), -180.0, 179.9])) for i in range(90)]
    stations += [("null", "n", None, 1.0), ("same", "n", *zips[0][1:])]
    got = nearest_stations_on_sphere(spark.createDataFrame([*zips, ("Znull", None, 0.0)], ZIPS), spark.createDataFrame(stations, STATIONS), k, miles, pairs)
    found = sorted((r.zipcode, r.rank, r.station_id) for r in got.collect())
    want = []
    for z, *p in zips:
        near = sorted((miles_between(p, (la, lo)), s) for s, _, la, lo in stations if la is not None)
        want += [(z, i, s) for i, (d, s) in enumerate([x for x in near if x[0] <= miles][:k], 1)]
    assert found == sorted(want) and found


def test_sphere_search_needs_a_bound(spark):
    empty = spark.createDataFrame([], ZIPS), spark.createDataFrame([], STATIONS)
    with pytest.raises(ValueError):
        nearest_stations_on_sphere(*empty, 3, None)
    assert nearest_stations_on_sphere(*empty, 3, 10.0).count() == 0
