"""Coverage report: how many metric rows carry a value, per metric, in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweather.schemas import CORE_ELEMENTS

DEFAULT_METRICS = tuple(e.lower() for e in CORE_ELEMENTS)


def coverage(metrics: DataFrame, names=DEFAULT_METRICS) -> DataFrame:
    """(metric, total, with_data, percentage) for each metric column.

    One global aggregate computes all counts; the rows are produced by exploding
    that single result row.  An empty input gives percentage NULL, not an error.
    """
    counts = metrics.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(F.col(m)).alias(f"n_{m}") for m in names],
    )
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"n_{m}").alias("with_data")) for m in names])
    long = counts.select("total", F.inline(rows))
    return long.select(
        "metric",
        "total",
        "with_data",
        F.try_divide(F.col("with_data").cast("double") * F.lit(100.0), F.col("total").cast("double")).alias(
            "percentage"
        ),
    )
