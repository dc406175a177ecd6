import datetime as dt
import math

from pyspark.sql import functions as F

from geoweather.functions import (
    damage_to_dollars,
    haversine_miles,
    parts_to_timestamp,
    round_half_even_to_long,
    storm_file_stamp,
    storm_file_year,
    text_to_double,
    text_to_long,
    yearly_file_year,
)

DAMAGE_CASES = [
    (None, 0.0), ("", 0.0), ("10.00K", 10000.0), ("5k", 5000.0), ("1.5M", 1500000.0), ("2B", 2e9),
    ("K", 0.0), ("M", 0.0), ("5", 5.0), ("5H", 0.0), ("?", 0.0), ("T", 0.0), ("5d", 0.0), ("5f", 0.0),
    ("1E3K", 1e6), ("5KK", 5000.0), ("5K ", 0.0), ("0.00K", 0.0), ("2.5b", 2.5e9), ("ABCK", None),
]


def test_damage_to_dollars(spark):
    df = spark.createDataFrame([(t,) for t, _ in DAMAGE_CASES], "t string")
    got = [r.d for r in df.select(damage_to_dollars("t").alias("d")).collect()]
    assert got == [d for _, d in DAMAGE_CASES]


def test_parts_to_timestamp(spark):
    rows = [
        (202401, 5, 905, dt.datetime(2024, 1, 5, 9, 5)),
        (202402, 30, 0, None),
        (202413, 1, 0, None),
        (202401, 5, 2400, None),
        (202401, 5, 960, None),
        (None, 5, 905, None),
        (202401, None, 905, None),
        (202412, 31, 2359, dt.datetime(2024, 12, 31, 23, 59)),
        (202401, 123, 0, None),  # an overlong part is no time; it is reported, not cut
        (202401, 5, 12345, None),
        (202401, -5, 0, None),
        (20241, 5, 0, None),
        (202400, 5, 0, None),
        (202402, 29, 0, dt.datetime(2024, 2, 29, 0, 0)),
    ]
    df = spark.createDataFrame([r[:3] for r in rows], "ym long, d long, t long")
    got = [r.ts for r in df.select(parts_to_timestamp("ym", "d", "t").alias("ts")).collect()]
    assert got == [r[3] for r in rows]
    assert dict(df.select(parts_to_timestamp("ym", "d", "t").alias("ts")).dtypes)["ts"] == "timestamp_ntz"


def test_magnitude_rounding(spark):
    df = spark.createDataFrame([(1.75,), (0.5,), (2.5,), (1.5,), (-2.5,), (None,)], "x double")
    got = [r.m for r in df.select(round_half_even_to_long("x").alias("m")).collect()]
    assert got == [2, 0, 2, 2, -2, None]


def test_text_to_numbers(spark):
    texts = ["3", " 42 ", "2.5", "1.75", "1e2", "abc", "5d", None, "", "-7", "9007199254740993"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select(text_to_long("t").alias("l"), text_to_double("t").alias("d")).collect()
    assert [r.l for r in out] == [3, 42, 2, 2, 100, None, None, None, None, -7, 9007199254740993]
    assert [r.d for r in out][:7] == [3.0, 42.0, 2.5, 1.75, 100.0, None, None]


def test_haversine(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (40.0, -75.0, 40.0, -75.0)], "a double, b double, c double, d double")
    got = [r.m for r in df.select(haversine_miles("a", "b", "c", "d").alias("m")).collect()]
    assert math.isclose(got[0], 3956 * math.pi / 180, rel_tol=1e-12)
    assert got[1] == 0.0


def test_file_years(spark):
    names = ["StormEvents_details-ftp_v1.0_d2025_c20250520.csv.gz", "StormEvents_details-ftp_v1.0.csv.gz", "2024.csv.gz"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    out = df.select(storm_file_year("n").alias("y"), storm_file_stamp("n").alias("c"), yearly_file_year("n").alias("o")).collect()
    assert [(r.y, r.c) for r in out] == [(2025, 20250520), (None, None), (None, None)]
    assert out[2].o == 2024


def test_no_python_udfs_in_function_plans(spark):
    df = spark.createDataFrame([("5K", 202401, 5, 905)], "t string, ym long, d long, hm long")
    q = df.select(damage_to_dollars("t"), parts_to_timestamp("ym", "d", "hm"), text_to_long(F.col("t")))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
