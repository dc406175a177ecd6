import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from geoweather.functions import haversine_miles
from geoweather.operators.nearest import nearest_stations
from tests.conftest import plan_text

ZIP_SCHEMA = "zipcode string, zipcode_latitude double, zipcode_longitude double"
STN_SCHEMA = "station_id string, station_name string, station_latitude double, station_longitude double"


def brute_force(zips, stations, k, max_miles, box):
    """The definition, evaluated as a plain cross product (test-only reference)."""
    s = stations.where(F.col("station_latitude").isNotNull() & F.col("station_longitude").isNotNull())
    pairs = zips.crossJoin(s).where(
        (F.abs(F.col("zipcode_latitude") - F.col("station_latitude")) <= box)
        & (F.abs(F.col("zipcode_longitude") - F.col("station_longitude")) <= box)
    )
    pairs = pairs.withColumn(
        "distance_miles",
        haversine_miles("zipcode_latitude", "zipcode_longitude", "station_latitude", "station_longitude"),
    ).where(F.col("distance_miles") <= max_miles)
    w = Window.partitionBy("zipcode").orderBy("distance_miles", "station_id")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _rows(df):
    return sorted(
        (r.zipcode, r.station_id, round(r.distance_miles, 9), r.rank)
        for r in df.select("zipcode", "station_id", "distance_miles", "rank").collect()
    )


def _points(spark, n_zip, n_stn, seed):
    rnd = random.Random(seed)
    zips = [(f"{i:05d}", rnd.uniform(24, 50), rnd.uniform(-125, -66)) for i in range(n_zip)]
    # a dense cluster: a third of all ZIPs share one grid cell
    zips += [(f"9{i:04d}", 40.2 + rnd.random() * 0.5, -74.3 + rnd.random() * 0.5) for i in range(n_zip // 2)]
    stns = [(f"S{i:04d}", f"n{i}", rnd.uniform(24, 50), rnd.uniform(-125, -66)) for i in range(n_stn)]
    stns += [(f"T{i:04d}", f"t{i}", 40.0 + rnd.random(), -74.5 + rnd.random()) for i in range(n_stn // 3)]
    stns += [("SNULL", "no coords", None, -100.0)]
    return spark.createDataFrame(zips, ZIP_SCHEMA), spark.createDataFrame(stns, STN_SCHEMA)


def test_grid_join_equals_cross_join(spark):
    zips, stns = _points(spark, 300, 400, 7)
    expected = _rows(brute_force(zips, stns, 20, 200.0, 5.0))
    assert expected
    assert _rows(nearest_stations(zips, stns, k=20, max_miles=200.0, box_deg=5.0)) == expected
    # forced salting on both sides (tiny task budget) gives the same rows
    assert _rows(nearest_stations(zips, stns, k=20, max_miles=200.0, box_deg=5.0, pairs_per_task=50)) == expected
    assert _rows(nearest_stations(zips, stns, k=7, max_miles=150.0, box_deg=5.0, cell_deg=2.5)) == _rows(
        brute_force(zips, stns, 7, 150.0, 5.0)
    )


def test_box_is_a_hard_filter_and_ties_break_by_id(spark):
    zips = spark.createDataFrame(
        [("north", 60.0, 10.0), ("tie", 30.0, -90.0), ("lonely", 0.0, 0.0), ("nullzip", None, 1.0)], ZIP_SCHEMA
    )
    stns = spark.createDataFrame(
        [
            ("N_FAR_LON", "a", 60.0, 15.5),  # ~190 miles at 60N, but 5.5 degrees of longitude: excluded
            ("N_NEAR", "b", 60.0, 14.0),
            ("TIE_B", "c", 30.0, -89.0),
            ("TIE_A", "d", 30.0, -91.0),  # same distance as TIE_B: id order decides
            ("EDGE_IN", "e", 32.85, -90.0),
        ],
        STN_SCHEMA,
    )
    out = {(r.zipcode, r.station_id): r.rank for r in nearest_stations(zips, stns, k=20).collect()}
    assert ("north", "N_FAR_LON") not in out and ("north", "N_NEAR") in out
    assert out[("tie", "TIE_A")] == 1 and out[("tie", "TIE_B")] == 2
    assert not any(z in ("lonely", "nullzip") for z, _ in out)


def test_ranks_dense_and_distance_monotone(spark):
    zips, stns = _points(spark, 200, 300, 11)
    rows = nearest_stations(zips, stns, k=20).collect()
    by_zip = {}
    for r in rows:
        by_zip.setdefault(r.zipcode, []).append((r.rank, r.distance_miles))
    for ranks in by_zip.values():
        ranks.sort()
        assert [r for r, _ in ranks] == list(range(1, len(ranks) + 1))
        assert all(a[1] <= b[1] for a, b in zip(ranks, ranks[1:]))
        assert len(ranks) <= 20


def test_plan_has_no_nested_loop_and_limits_before_shuffle(spark):
    zips, stns = _points(spark, 50, 50, 3)
    plan = plan_text(nearest_stations(zips, stns))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "WindowGroupLimit" in plan


def test_high_latitudes_match_brute_force(spark):
    rnd = random.Random(5)
    zips = [(f"P{i:03d}", rnd.uniform(55, 89.9) * rnd.choice([1, -1]), rnd.uniform(-180, 180)) for i in range(150)]
    stns = [(f"Q{i:03d}", "q", rnd.uniform(55, 90) * rnd.choice([1, -1]), rnd.uniform(-180, 180)) for i in range(600)]
    z = spark.createDataFrame(zips, ZIP_SCHEMA)
    s = spark.createDataFrame(stns, STN_SCHEMA)
    for miles in (200.0, 400.0):
        assert _rows(nearest_stations(z, s, k=20, max_miles=miles)) == _rows(brute_force(z, s, 20, miles, 5.0))


def test_two_pass_search_is_exact(spark):
    zips, stns = _points(spark, 300, 1500, 13)
    expected = _rows(brute_force(zips, stns, 20, 200.0, 5.0))
    for r1 in (40.0, 90.0):
        got = _rows(nearest_stations(zips, stns, k=20, max_miles=200.0, first_pass_miles=r1))
        assert got == expected
    from geoweather.operators.nearest import suggest_first_pass_miles

    r = suggest_first_pass_miles(zips, stns, 20, 200.0)
    assert r is not None and 0 < r < 100  # the dense cluster dominates where the ZIPs are
    assert _rows(nearest_stations(zips, stns, k=20, max_miles=200.0, first_pass_miles=r)) == expected


def test_distance_is_not_pushed_into_the_join(spark):
    zips, stns = _points(spark, 20, 20, 1)
    plan = nearest_stations(zips, stns)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join Inner" in line]
    assert joins and not any("ASIN" in j for j in joins)


def test_stored_first_pass_runs_once(spark, tmp_path):
    from geoweather.operators.nearest import first_pass, second_pass

    zips, stns = _points(spark, 300, 1500, 13)
    first = first_pass(zips, stns, 20, 60.0)
    p = str(tmp_path / "near")
    first.write.parquet(p)
    both = second_pass(spark.read.parquet(p), zips, stns, 20)
    # one spatial join in each step
    assert plan_text(first).count("ShuffledHashJoin") == 1 and plan_text(both).count("ShuffledHashJoin") == 1
    assert _rows(both) == _rows(brute_force(zips, stns, 20, 200.0, 5.0))


def _join_rows(df):
    """Rows put out by the largest hash join of a plan that has run."""
    found, todo = [0], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        elif node.nodeName() == "ShuffledHashJoin":
            found.append(node.metrics().apply("numOutputRows").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return max(found)


def test_pairs_do_not_grow_with_the_stations_in_reach(spark):
    rnd = random.Random(3)
    places = [(40 + rnd.randrange(40) / 40, -75 + rnd.randrange(40) / 40) for _ in range(300)]
    zips = [(f"{i % 190:05d}", 40 + rnd.random(), -75 + rnd.random()) for i in range(200)]  # some zipcodes twice
    zips += [("rural", 41.9, -76.4), ("far", 43.5, -75.0)]
    stns = [(f"S{i:05d}", f"n{i}", *rnd.choice(places)) for i in range(3000)]  # about ten on each point
    z, s = spark.createDataFrame(zips, ZIP_SCHEMA), spark.createDataFrame(stns, STN_SCHEMA)
    got = nearest_stations(z, s, k=5, max_miles=200.0)
    assert _rows(got) == _rows(brute_force(z, s, 5, 200.0, 5.0))
    got.collect()
    assert _join_rows(got) < 10 * len(zips)
