"""Years and creation stamps parsed from source file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Storm file names look like StormEvents_details-ftp_v1.0_dYYYY_cYYYYMMDD.csv.gz
STORM_FILE_PREFIX = "StormEvents_details"
STORM_YEAR_PATTERN = r"_d(\d{4})_"
STORM_STAMP_PATTERN = r"_c(\d{8})"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _group_or_null(name, pattern: str) -> Column:
    found = F.regexp_extract(_c(name), pattern, 1)
    return F.when(found != F.lit(""), found.cast("int"))


def storm_file_year(name) -> Column:
    """Data year of a storm file name, NULL when the name carries none."""
    return _group_or_null(name, STORM_YEAR_PATTERN)


def storm_file_stamp(name) -> Column:
    """Creation stamp yyyymmdd of a storm file name, NULL when absent."""
    return _group_or_null(name, STORM_STAMP_PATTERN)


def yearly_file_year(name) -> Column:
    """Year of an observation file named 'YYYY.csv.gz' (text before the first dot)."""
    return F.split_part(_c(name), F.lit("."), F.lit(1)).try_cast("int")


def base_name(path) -> Column:
    """File name without folders, e.g. from ``_metadata.file_path``."""
    return F.regexp_extract(_c(path), r"([^/]+)$", 1)
