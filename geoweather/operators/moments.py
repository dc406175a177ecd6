"""Daily metrics from mergeable station-day moments.

``station_day_moments`` reduces the observations once to exact sums per station, day and element: number of
readings, number of values, their sum and their sum of squares.  Values are integers, so the sums
are exact and merging is plain addition, in any order and grouping: a backfill adds the moments of
its rows, another distance or another link table joins the moments again, and neither reads the observations.
Averages and spreads are formed at the very end, the variance from n * squares - sum^2 in
exact decimals, so nothing cancels.

A row with element '' marks that the station reported anything on that day (other elements, flagged
readings): the spine of the metrics needs these days.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoweather.operators.metrics import in_date_range, near_links, observed_dates
from geoweather.operators.places import link_columns, spread
from geoweather.schemas import CORE_ELEMENTS

KEYS = ("id", "date", "element")
SUMS = {"readings": "bigint", "valued": "bigint", "total": "bigint", "squares": "decimal(38,0)"}
ANYTHING = ""


def station_day_moments(obs: DataFrame, elements=CORE_ELEMENTS) -> DataFrame:
    """(id, date, element, readings, valued, total, squares) of unflagged core readings, and the '' rows."""
    counted = F.col("element").isin(*elements) & F.col("q_flag").isNull()
    value = F.when(F.coalesce(counted, F.lit(False)), F.col("data_value"))
    square = value.cast("decimal(20,0)") * value.cast("decimal(10,0)")
    rows = obs.select(
        "id", "date", F.when(counted, F.col("element")).otherwise(F.lit(ANYTHING)).alias("element"), value.alias("v"), square.alias("sq")
    )
    return rows.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("readings"),
        F.count("v").alias("valued"),
        F.coalesce(F.sum(F.col("v").cast("bigint")), F.lit(0)).cast("bigint").alias("total"),
        F.coalesce(F.sum("sq"), F.lit(0)).cast("decimal(38,0)").alias("squares"),
    )


def merge_moments(*parts: DataFrame) -> DataFrame:
    """Moments of all the observations behind ``parts``."""
    together = reduce(lambda a, b: a.unionByName(b), [p.select(*KEYS, *SUMS) for p in parts])
    return together.groupBy(*KEYS).agg(*[F.sum(c).cast(kind).alias(c) for c, kind in SUMS.items()])


def _figures(element: str) -> list[Column]:
    m = element.lower()
    n, total, squares = (F.col(f"_{m}_{c}") for c in ("valued", "total", "squares"))
    wide = total.cast("decimal(19,0)")
    apart = (n.cast("decimal(19,0)") * squares - (wide * wide)).cast("double")
    return [
        F.when(n > 0, total.cast("double") / n).alias(m),
        F.nullif(F.col(f"_{m}_readings"), F.lit(0)).cast("int").alias(f"{m}_count"),
        F.when(n > 1, F.sqrt(apart / (n.cast("double") * (n - 1).cast("double")))).alias(f"{m}_stddev"),
    ]


def metrics_from_moments(
    moments: DataFrame, links: DataFrame, min_date, max_date, max_miles: float = 20.0, elements=CORE_ELEMENTS
) -> DataFrame:
    """The rows of ``operators.metrics.daily_metrics`` over the observations behind ``moments``.

    The moments have one row per station, day and element; they are spread over the linked ZIPs place by place, with the
    spine, and one aggregation on (zipcode, date) reduces both without a shuffle.
    """
    near = near_links(links, max_miles)
    inside = in_date_range(moments, min_date, max_date)
    found = inside.where(F.col("element").isin(*elements)).select(*KEYS, *SUMS)
    rows = spread(found, near.select(*link_columns(near)), observed_dates(inside))
    aggs = [
        F.coalesce(F.sum(F.when(F.col("element") == e, F.col(c))), F.lit(0)).cast(kind).alias(f"_{e.lower()}_{c}")
        for e in elements
        for c, kind in SUMS.items()
    ]
    wide = rows.groupBy("place", "zipcode", "date").agg(*aggs)
    figures = [c for e in elements for c in _figures(e)]
    return wide.select(
        "zipcode", "date", F.year("date").alias("year"), F.month("date").alias("month"), F.dayofmonth("date").alias("day"), *figures
    )
