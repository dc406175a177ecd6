"""Partitioned Parquet export of a table to a lake folder (local, HDFS or s3a://)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from geoweather.operators.preview import filter_rows

# Fixed value: rows per Parquet row group in exported files.
ROWS_PER_ROW_GROUP = 200_000


def export_parquet(
    df: DataFrame,
    path: str,
    partition_by=("year", "month"),
    where: str | None = None,
    rows_per_group: int = ROWS_PER_ROW_GROUP,
    max_records_per_file: int | None = None,
    cluster_by=(),
) -> str:
    """Write ``df`` (optionally filtered by a SQL predicate) under ``path``.

    With partition columns, output goes to ``col=value`` folders and only the
    partitions present in the data are replaced (dynamic overwrite); other
    partitions already in the lake are kept.  A rebalance on the partition
    columns gives each partition few, large files while AQE splits a partition
    that holds a large share of the rows across several tasks.  With ``cluster_by`` rows are
    range-partitioned by bounds sampled from the data and sorted, so that files and row groups hold narrow
    ranges of these columns and readers skip most of them.  Object-store credentials come from the session's Hadoop configuration, never from here.
    """
    rows = filter_rows(df, where)
    cols = [c for c in (partition_by or ()) if c]
    if cluster_by:
        writer_df = rows.repartitionByRange(*cols, *cluster_by).sortWithinPartitions(*cols, *cluster_by)
    else:
        writer_df = rows.hint("rebalance", *cols) if cols else rows
    writer = (
        writer_df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("parquet.block.row.count.limit", str(rows_per_group))
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    if cols:
        writer = writer.partitionBy(*cols)
    writer.parquet(path)
    return path
