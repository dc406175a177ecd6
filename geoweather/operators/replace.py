"""Replacement rules as queries: what a table holds after a refresh.

These return the *resulting table* as a DataFrame, so the rule can be checked and
composed; ``plans.tables`` performs the same refresh physically with partition
overwrites.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def watermark_year(existing: DataFrame, year_expr: Column) -> Column:
    """Scalar subquery: the newest year in ``existing`` (NULL when empty)."""
    return existing.select(F.max(year_expr)).scalar()


def replace_newest_year(
    existing: DataFrame,
    incoming: DataFrame,
    year_col: str,
    watermark: Column | None = None,
) -> DataFrame:
    """The table after a newest-year refresh.

    The newest year W of ``existing`` (or the given ``watermark``) is dropped, and
    every incoming row of year >= W is loaded; older years stay untouched.
    With an empty ``existing`` every incoming row is loaded.
    """
    w = watermark if watermark is not None else watermark_year(existing, F.col(year_col))
    kept = existing.where(~_dropped(F.col(year_col), w))
    loaded = incoming.where(_loaded(F.col(year_col), w))
    return kept.unionByName(loaded)


def _dropped(year: Column, w: Column) -> Column:
    return F.coalesce(year == w, F.lit(False))


def _loaded(year: Column, w: Column) -> Column:
    return w.isNull() | F.coalesce(year >= w, F.lit(False))


def refresh_audit(existing: DataFrame, incoming: DataFrame, year_col: str, watermark: Column | None = None) -> DataFrame:
    """One row of load counts for a newest-year refresh, from a single aggregate pass.

    rows_before, rows_deleted, rows_loaded, rows_after (= before - deleted + loaded).
    """
    w = watermark if watermark is not None else watermark_year(existing, F.col(year_col))
    tagged = existing.select(F.lit(True).alias("is_old"), F.col(year_col).alias("y")).unionByName(
        incoming.select(F.lit(False).alias("is_old"), F.col(year_col).alias("y"))
    )
    old, y = F.col("is_old"), F.col("y")
    counts = tagged.agg(
        F.count(F.when(old, F.lit(1))).alias("rows_before"),
        F.count(F.when(old & _dropped(y, w), F.lit(1))).alias("rows_deleted"),
        F.count(F.when(~old & _loaded(y, w), F.lit(1))).alias("rows_loaded"),
    )
    return counts.select(
        "rows_before",
        "rows_deleted",
        "rows_loaded",
        (F.col("rows_before") - F.col("rows_deleted") + F.col("rows_loaded")).alias("rows_after"),
    )


def replace_date_range(existing: DataFrame, recomputed: DataFrame, min_date, max_date, date_col: str = "date") -> DataFrame:
    """The table after deleting [min_date, max_date] (inclusive) and inserting ``recomputed``."""
    lo, hi = F.lit(min_date).cast("date"), F.lit(max_date).cast("date")
    kept = existing.where(~F.col(date_col).between(lo, hi) | F.col(date_col).isNull())
    return kept.unionByName(recomputed.where(F.col(date_col).between(lo, hi)))
