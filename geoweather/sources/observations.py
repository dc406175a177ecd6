"""Yearly GHCN observation files: 8 positional comma-separated columns, no header.

Files are read with an all-string schema (no inference), then typed with try-casts
so a malformed row never fails a file; ``observation_rejects`` lists such rows.
gzip files are not splittable (one task per file), so callers repartition or write
Parquet once and read that afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoweather.functions.casts import INTEGER_PATTERN
from geoweather.functions.files import yearly_file_year
from geoweather.schemas import OBSERVATIONS, all_strings

OBS_TEXT = all_strings(OBSERVATIONS)
CORRUPT = "_corrupt_record"
DATE_FORMAT = "yyyyMMdd"


def type_observations(text: DataFrame) -> DataFrame:
    """All-string observation columns -> typed ``ghcn_daily_raw`` columns plus ``year`` and ``bad``.

    Bad: no id, date or element, an unreadable date or value, or (where the reader kept it) a
    line with the wrong number of fields.
    """
    date = F.try_to_date(F.col("date"), DATE_FORMAT)
    value = F.when(F.col("data_value").rlike(INTEGER_PATTERN), F.trim("data_value").try_cast("int"))
    bad = date.isNull() | F.col("id").isNull() | F.col("element").isNull() | (F.col("data_value").isNotNull() & value.isNull())
    if CORRUPT in text.columns:
        bad = bad | F.col(CORRUPT).isNotNull()
    kept = [c for c in ("source_file", "file_year", CORRUPT) if c in text.columns]
    return text.select(
        F.col("id"),
        date.alias("date"),
        F.col("element"),
        value.alias("data_value"),
        F.col("m_flag"),
        F.col("q_flag"),
        F.col("s_flag"),
        F.col("obs_time"),
        F.year(date).alias("year"),
        bad.alias("bad"),
        *kept,
    )


def parse_observation_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Text lines (one observation each) -> typed rows (same result as the file reader)."""
    ddl = ", ".join(f"{f.name} STRING" for f in OBS_TEXT.fields)
    parsed = lines.select(F.from_csv(F.col(col), ddl).alias("r"))
    return type_observations(parsed.select("r.*"))


def read_observation_text(spark: SparkSession, paths) -> DataFrame:
    """All-string rows with ``_corrupt_record``, ``source_file`` and ``file_year``."""
    schema = T.StructType([*OBS_TEXT.fields, T.StructField(CORRUPT, T.StringType())])
    rows = spark.read.schema(schema).option("header", False).option("mode", "PERMISSIVE")
    rows = rows.option("columnNameOfCorruptRecord", CORRUPT).csv(paths)
    name = F.col("_metadata.file_name")
    return rows.select("*", name.alias("source_file"), yearly_file_year(name).alias("file_year"))


def read_typed_observations(spark: SparkSession, paths) -> DataFrame:
    """Good and bad rows, typed, with ``bad``, ``source_file`` and ``file_year``."""
    return type_observations(read_observation_text(spark, paths))


def read_observations(spark: SparkSession, paths) -> DataFrame:
    """Typed good rows (``ghcn_daily_raw`` + ``year``)."""
    return read_typed_observations(spark, paths).where(~F.col("bad")).select(*OBSERVATIONS.fieldNames(), "year")


def observation_rejects(spark: SparkSession, paths) -> DataFrame:
    """Rows that cannot be loaded, with the text of lines that have the wrong number of fields."""
    return read_typed_observations(spark, paths).where(F.col("bad")).drop("bad")
