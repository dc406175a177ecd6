import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from geoweather.operators.metrics import daily_metrics, element_stats_long, element_stats_wide, readings
from geoweather.operators.moments import metrics_from_moments, station_day_moments
from geoweather.operators.places import spread
from geoweather.schemas import OBSERVATIONS
from tests.conftest import plan_text

FACTS = "id string, date date, v int"
LINKS = "zipcode string, station_id string, distance_miles double, zipcode_latitude double, zipcode_longitude double"
D = [dt.date(2024, 1, d) for d in range(1, 5)]


def some_links():
    rng = random.Random(3)
    out = []
    for z in range(60):
        at = (30 + z % 3 * 0.3, -90 - z % 7 * 0.2) if z % 10 else (None, -90.0)
        out += [(f"Z{z}", f"S{rng.randrange(25)}", 1.0, *at) for _ in range(5)]
    out += [("Z1", "S1", 1.0, 55.0, 10.0)] * 2  # a ZIP listed at two places, and a link listed twice
    return out + [(None, "S2", 1.0, 30.0, -90.0), ("Z99", None, 1.0, 30.0, -90.0)]


def some_facts():
    rng = random.Random(4)
    return [(rng.choice([None, *[f"S{i}" for i in range(30)]]), rng.choice([*D, None]), rng.choice([None, 1, 2, 3])) for _ in range(300)]


def as_bag(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("most", [1, 20, 100_000])
@pytest.mark.parametrize("located", [True, False])
def test_spread_equals_the_join(spark, most, located):
    facts, links = spark.createDataFrame(some_facts(), FACTS), spark.createDataFrame(some_links(), LINKS)
    if not located:
        links = links.drop("zipcode_latitude", "zipcode_longitude")
    want = facts.join(links, F.col("id") == F.col("station_id")).select("zipcode", "date", "v")
    got = spread(facts, links, most=most)
    assert as_bag(got.select("zipcode", "date", "v")) == as_bag(want)
    assert got.groupBy("zipcode").agg(F.countDistinct("place").alias("n")).where("n > 1").isEmpty()
    # with dates: a row without a value for each ZIP and date as well
    dates = F.array(*map(F.lit, D))
    spine = links.select("zipcode").distinct().select("zipcode", F.explode(dates).alias("date"), F.lit(None).cast("int").alias("v"))
    assert as_bag(spread(facts, links, dates, most).select("zipcode", "date", "v")) == as_bag(want.unionAll(spine))


def test_places_hold_about_as_many_links_as_asked(spark):
    links = spark.createDataFrame([(f"Z{z}", f"S{s}", 1.0, 30 + z / 1000, -90.0) for z in range(200) for s in range(4)], LINKS)
    facts = spark.createDataFrame([(f"S{s}", D[0], 1) for s in range(4)], FACTS)
    sizes = [r["count"] for r in spread(facts, links, most=100).groupBy("place").count().collect()]
    assert sum(sizes) == 800 and len(sizes) >= 8 and max(sizes) <= 200


def test_pairs_of_readings_and_zips_are_not_shuffled(spark):
    """No sum by ZIP and day has an exchange of its own: the rows before it are many times the observations."""
    links = spark.createDataFrame(some_links(), LINKS)
    obs = spark.createDataFrame([("S1", D[0], "PRCP", 1, None, None, "W", None), ("S2", D[0], "TMAX", 2, None, None, "W", None)], OBSERVATIONS)
    reads = readings(obs, links, by_place=True)
    sums = [
        daily_metrics(obs, links, D[0], D[3]), element_stats_long(reads), element_stats_wide(reads),
        metrics_from_moments(station_day_moments(obs), links, D[0], D[3]),
    ]
    for df in sums:
        assert "place" not in df.columns and df.count()
        assert not re.search(r"hashpartitioning\(zipcode#\d+, date#", plan_text(df))


def test_element_stats_by_place_equal_those_of_the_join(spark):
    rng = random.Random(5)
    rows = [(f"S{rng.randrange(25)}", rng.choice(D), rng.choice(["PRCP", "TMAX", "WT01"]), rng.choice([None, 1, 5]), None, None, "W", None) for _ in range(300)]
    obs, links = spark.createDataFrame(rows, OBSERVATIONS), spark.createDataFrame(some_links(), LINKS)

    def rounded(df):
        return sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.collect())

    for stats in (element_stats_long, element_stats_wide):
        assert rounded(stats(readings(obs, links, by_place=True))) == rounded(stats(readings(obs, links)))
