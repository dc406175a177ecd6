"""Reading a Hive-partitioned Parquet lake folder back as one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def lake_view(spark: SparkSession, base: str, view_name: str | None = None) -> DataFrame:
    """All Parquet files under ``base`` with partition columns discovered from ``k=v`` folders.

    Filters on partition columns prune folders; filters on data columns are pushed
    into the Parquet scan.
    """
    df = spark.read.parquet(base)
    if view_name:
        df.createOrReplaceTempView(view_name)
    return df
