"""Plan guard: filters on computed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_on_output(df: DataFrame, condition: Column) -> DataFrame:
    """``df.where(condition)`` evaluated on ``df``'s output rows.

    Catalyst pushes a filter through any deterministic projection by substituting
    each column's defining expression, and on into join conditions.  For costly
    columns (a great-circle distance, regex-guarded casts) the expression then runs
    twice: once in the pushed filter and once in the projection.  The partition
    id counts as nondeterministic, so a projection carrying it (and a filter that
    references it) stays where it is written; the extra column is dropped again.
    """
    fenced = df.withColumn("_fence", F.spark_partition_id())
    return fenced.where(condition & (F.col("_fence") >= 0)).drop("_fence")
