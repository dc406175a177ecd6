"""Small sorted samples and partition enumeration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def preview(df: DataFrame, by, n: int = 5) -> DataFrame:
    """First ``n`` rows in ``by`` order (a top-n: Spark plans TakeOrderedAndProject)."""
    return df.orderBy(*by).limit(n)


def partition_values(df: DataFrame, cols) -> DataFrame:
    """Distinct partition-column combinations, sorted."""
    return df.select(*cols).distinct().orderBy(*cols)


def filter_rows(df: DataFrame, where: str | None) -> DataFrame:
    """Apply a caller's SQL predicate as one parenthesised unit."""
    return df if not where else df.where(F.expr(f"({where})"))
