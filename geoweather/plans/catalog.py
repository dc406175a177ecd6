"""Tables by name: catalog entries over the Parquet folders that the jobs write.

The folders stay the place of the data; a catalog entry adds a name, a fixed schema, the list of
partitions and statistics.  After a job has written a folder, ``refresh_table`` brings the entry up to date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from geoweather.plans.tables import _delete_path


def _quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def register_table(spark: SparkSession, name: str, path: str, schema: StructType | None = None, partition_by=()) -> None:
    """Make ``name`` stand for the Parquet folder ``path``; an entry of that name is replaced, its files stay.

    ``schema`` (data and partition columns) is taken from the folder if it is not given.
    """
    schema = schema or spark.read.parquet(path).schema
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
    by = f" PARTITIONED BY ({', '.join(map(_quoted, partition_by))})" if partition_by else ""
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {_quoted(name)} ({columns}) USING parquet{by} LOCATION '{place}'")
    refresh_table(spark, name)


def refresh_table(spark: SparkSession, name: str, statistics: bool = True) -> None:
    """Find partitions that were added or removed under the table's folder, and count its rows and bytes."""
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {_quoted(name)} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    if statistics:
        spark.sql(f"ANALYZE TABLE {_quoted(name)} COMPUTE STATISTICS")


def open_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A table of the catalog by its name, or else the Parquet folder at that path."""
    if "/" not in name_or_path and spark.catalog.tableExists(name_or_path):
        return spark.table(name_or_path)
    if "/" not in name_or_path:
        raise ValueError(f"there is no table {name_or_path}")
    return spark.read.parquet(name_or_path)


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """(position, col_name, data_type, is_partition) of a table's columns."""
    rows = [(i, c.name, c.dataType, c.isPartition) for i, c in enumerate(spark.catalog.listColumns(name), 1)]
    return spark.createDataFrame(rows, "position int, col_name string, data_type string, is_partition boolean")


def table_statistics(spark: SparkSession, name: str) -> dict:
    """Rows and bytes as counted by the last ``refresh_table``."""
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").where(F.col("col_name") == "Statistics").first()
    if row is None:
        return {}
    parts = [p.strip().split(" ") for p in row.data_type.split(",")]
    return {unit: int(n) for n, unit in parts}


def drop_table(spark: SparkSession, name: str, files: bool = False) -> bool:
    """Forget a table, and with ``files`` delete its folder; False if there is none."""
    if not spark.catalog.tableExists(name):
        return False
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}")
    place = described.where(F.col("col_name") == "Location").first().data_type
    spark.sql(f"DROP TABLE {_quoted(name)}")
    if files:
        _delete_path(spark, place)
    return True
