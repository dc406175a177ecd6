"""ZIP-code gazetteer: tab-separated with a header; columns are mapped by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoweather.functions.casts import text_to_double, text_to_long
from geoweather.schemas import ZIPCODES, all_strings

ZIP_TEXT = all_strings(ZIPCODES)


def type_zipcodes(text: DataFrame) -> DataFrame:
    """All-string gazetteer columns -> typed ``zipcodes`` table (GEOID keeps its leading zeros)."""
    cols = []
    for f in ZIPCODES.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.LongType):
            c = text_to_long(c)
        elif isinstance(f.dataType, T.DoubleType):
            c = text_to_double(c)
        cols.append(c.alias(f.name))
    return text.select(*cols)


def parse_zipcode_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    ddl = ", ".join(f"{f.name} STRING" for f in ZIP_TEXT.fields)
    parsed = lines.select(F.from_csv(F.col(col), ddl, {"sep": "\t"}).alias("r"))
    return type_zipcodes(parsed.select("r.*"))


def read_zipcodes(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.schema(ZIP_TEXT).option("sep", "\t").option("header", True).csv(path)
    return type_zipcodes(text)
