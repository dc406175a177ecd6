"""Putting a batch of typed storm rows into the storm table and its issue table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoweather.operators.storms import storm_issues
from geoweather.plans import tables
from geoweather.schemas import STORM_EVENTS

NO_YEAR = 0  # issue partition of files whose name tells no year


def with_year_check(typed: DataFrame) -> DataFrame:
    """Rejects rows whose YEAR is not the year of their file (reason OTHER_YEAR)."""
    other = F.col("file_year").isNotNull() & ~F.coalesce(F.col("YEAR") == F.col("file_year"), F.lit(False))
    other = other & F.col("reject_reasons").eqNullSafe("")
    return typed.withColumn("reject_reasons", F.when(other, F.lit("OTHER_YEAR")).otherwise(F.col("reject_reasons")))


def refresh_storms(spark: SparkSession, typed: DataFrame, target: str, years, issues_target: str | None = None, files_failed=()) -> dict:
    """Replace ``years`` of the storm table by the loadable rows of ``typed`` (a staged frame).

    Rows of files without a year in their name go by their own YEAR, but only into ``years``.  The
    issue table is partitioned by ``file_year``; the partitions of all ``years`` are replaced with
    it, so issues of an earlier load of a year never outlive it.  Files that could not be read are
    issues of their year (without touching that year's rows).
    """
    checked = with_year_check(typed)
    good = checked.where(F.col("reject_reasons") == "").select(*STORM_EVENTS.fieldNames())
    counts = tables.replace_years(spark, good, target, "YEAR", years)
    if issues_target:
        issues = storm_issues(checked).withColumn("file_year", F.coalesce("file_year", F.lit(NO_YEAR)))
        issues = issues.select("EVENT_ID", "YEAR", "rejected", "reasons", "source_file", "file_year")
        replaced = {*years, NO_YEAR}
        if files_failed:
            rows = [(None, None, True, "UNREADABLE_FILE", name, year if year is not None else NO_YEAR) for name, year in files_failed]
            issues = issues.unionByName(spark.createDataFrame(rows, issues.schema))
            replaced |= {r[-1] for r in rows}
        tables.replace_years(spark, issues, issues_target, "file_year", replaced)
    return counts
