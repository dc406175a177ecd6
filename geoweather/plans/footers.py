"""Counts and extremes of a stored table from its Parquet footers.

Spark answers count, min and max from row-group statistics if the table is read through the V2 file
source with aggregate pushdown on and all filters are on partition columns.  Both are settings of a session, so the scan
gets a session of its own and the caller's settings stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

V2_WITH_PUSHDOWN = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_scan(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``; count, min and max over it (numbers, dates, booleans) read footers only."""
    own = spark.newSession()
    for key, value in V2_WITH_PUSHDOWN.items():
        own.conf.set(key, value)
    return own.read.parquet(path)


def from_footers(spark: SparkSession, path: str, aggregates: list[Column], where: Column | None = None) -> DataFrame:
    """One row of ``aggregates`` over the table at ``path``; ``where`` may use partition columns."""
    scan = footer_scan(spark, path)
    return (scan if where is None else scan.where(where)).agg(*aggregates)
