import datetime as dt

from pyspark.sql import functions as F

from geoweather.operators.coverage import coverage
from geoweather.operators.metrics import daily_metrics
from geoweather.schemas import OBSERVATIONS, ZIPCODE_DAILY_METRICS
from tests.conftest import plan_text

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
LINK_SCHEMA = "zipcode string, station_id string, distance_miles double"


def _obs(spark, rows):
    return spark.createDataFrame(rows, OBSERVATIONS)


def _fixture(spark):
    obs = _obs(
        spark,
        [
            ("A", D1, "PRCP", 10, None, None, "W", "0700"),
            ("B", D1, "PRCP", 20, None, None, "W", None),
            ("A", D1, "TMAX", 100, None, None, "W", None),  # single reading: stddev NULL
            ("A", D1, "TMIN", None, None, None, "W", None),  # value NULL: avg NULL, count 1
            ("B", D1, "TMIN", -5, None, "I", "W", None),  # flagged: excluded
            ("A", D1, "WT01", 1, None, None, "W", None),  # not a core element
            ("C", D2, "PRCP", 7, None, "I", "W", None),  # only flagged rows on D2: D2 still in spine
            ("FAR", D3, "SNOW", 3, None, None, "W", None),  # station beyond max_miles
            ("A", dt.date(2023, 12, 31), "PRCP", 99, None, None, "W", None),  # outside range
        ],
    )
    links = spark.createDataFrame(
        [("z1", "A", 1.0), ("z1", "B", 5.0), ("z2", "B", 15.0), ("z3", "FAR", 50.0)], LINK_SCHEMA
    )
    return obs, links


def test_daily_metrics_semantics(spark):
    obs, links = _fixture(spark)
    out = daily_metrics(obs, links, D1, D3, max_miles=20.0)
    assert out.schema == ZIPCODE_DAILY_METRICS or [f.name for f in out.schema] == ZIPCODE_DAILY_METRICS.names
    rows = {(r.zipcode, r.date): r for r in out.collect()}
    # spine: zips with a station within 20 miles x dates with any raw row in range
    assert set(rows) == {(z, d) for z in ("z1", "z2") for d in (D1, D2, D3)}
    r = rows[("z1", D1)]
    assert (r.prcp, r.prcp_count) == (15.0, 2) and abs(r.prcp_stddev - 7.0710678118654755) < 1e-12
    assert (r.tmax, r.tmax_count, r.tmax_stddev) == (100.0, 1, None)
    assert (r.tmin, r.tmin_count, r.tmin_stddev) == (None, 1, None)
    assert (r.snow, r.snow_count, r.snow_stddev) == (None, None, None)
    assert (r.year, r.month, r.day) == (2024, 1, 1)
    r2 = rows[("z2", D1)]
    assert (r2.prcp, r2.prcp_count, r2.tmin_count) == (20.0, 1, None)
    empty = rows[("z1", D2)]
    assert all(getattr(empty, c) is None for c in ZIPCODE_DAILY_METRICS.names[5:])


def test_daily_metrics_matches_left_join_definition(spark):
    obs, links = _fixture(spark)
    near = links.where("distance_miles <= 20")
    rng = obs.where(F.col("date").between(D1, D3))
    spine = near.select("zipcode").distinct().crossJoin(rng.select("date").distinct())
    reads = rng.where(F.col("element").isin("PRCP", "SNOW", "SNWD", "TMAX", "TMIN") & F.col("q_flag").isNull()).join(
        near, rng.id == near.station_id
    )
    stats = reads.groupBy("zipcode", "date", "element").agg(
        F.avg("data_value").alias("a"), F.count(F.lit(1)).alias("n"), F.stddev_samp("data_value").alias("s")
    )
    piv = stats.groupBy("zipcode", "date").pivot("element", ["PRCP", "SNOW", "SNWD", "TMAX", "TMIN"]).agg(
        F.first("a"), F.first("n"), F.first("s")
    )
    ref = spine.join(piv, ["zipcode", "date"], "left").collect()
    got = daily_metrics(obs, links, D1, D3).collect()
    assert len(ref) == len(got)
    ref_prcp = sorted((r.zipcode, r.date, r["PRCP_first(a)"]) for r in ref)
    got_prcp = sorted((r.zipcode, r.date, r.prcp) for r in got)
    assert ref_prcp == got_prcp


def test_one_aggregate_exchange(spark):
    obs, links = _fixture(spark)
    plan = plan_text(daily_metrics(obs, links, D1, D3))
    assert plan.count("hashpartitioning(zipcode#") >= 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert plan.count("HashAggregate(keys=[zipcode#") <= 6


def test_year_partition_predicate_added(spark):
    obs, links = _fixture(spark)
    obs = obs.withColumn("year", F.year("date"))
    q = daily_metrics(obs, links, D1, D3)
    assert "year" in q._jdf.queryExecution().optimizedPlan().toString()


def test_coverage(spark):
    obs, links = _fixture(spark)
    cov = {r.metric: r for r in coverage(daily_metrics(obs, links, D1, D3)).collect()}
    assert cov["prcp"].total == 6 and cov["prcp"].with_data == 2
    assert abs(cov["prcp"].percentage - 200 / 6) < 1e-12
    empty = spark.createDataFrame([], ZIPCODE_DAILY_METRICS)
    rows = coverage(empty).collect()
    assert len(rows) == 5 and all(r.total == 0 and r.percentage is None for r in rows)


def test_shuffle_join_path_gives_same_rows(spark):
    from geoweather.operators import metrics as m

    obs, links = _fixture(spark)
    broadcast_rows = sorted(map(tuple, daily_metrics(obs, links, D1, D3, broadcast_links=True).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        q = m.daily_metrics(obs, links, D1, D3)
        plan = plan_text(q)
        assert "BroadcastHashJoin" not in plan
        assert sorted(map(tuple, q.collect())) == broadcast_rows
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_date_range_reaches_the_parquet_scan(spark, tmp_path):
    obs, links = _fixture(spark)
    path = str(tmp_path / "obs")
    obs.withColumn("year", F.year("date")).write.partitionBy("year").parquet(path)
    stored = spark.read.parquet(path)
    plan = plan_text(daily_metrics(stored, links, D1, D3))
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line and str(tmp_path) in line]
    assert scans
    for scan in scans:
        # whole years are pruned by folder, the exact dates are pushed into the reader
        assert "PartitionFilters: [isnotnull(year" in scan and "2024" in scan.split("PartitionFilters:")[1]
        assert "GreaterThanOrEqual(date,2024-01-01)" in scan and "LessThanOrEqual(date,2024-01-03)" in scan


def test_observations_are_read_twice_at_most(spark, tmp_path):
    obs, links = _fixture(spark)
    p = str(tmp_path / "obs")
    obs.write.parquet(p)
    plan = plan_text(daily_metrics(spark.read.parquet(p), links, D1, D3))
    assert plan.count("Scan parquet") <= 2
