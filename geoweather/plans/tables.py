"""Physical table refreshes on partitioned Parquet folders.

No transactional table format is assumed, so every refresh is:
compute -> stage under the shared folder (cuts lineage; a lost executor recomputes
only from the staged copy) -> dynamic partition overwrite of the target.
Callers name the partitions a refresh may replace; rows of other partitions never
reach the write, so untouched years or months keep their files.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from geoweather.plans import versions
from geoweather.plans.footers import from_footers
from geoweather.session import scratch_path, shared_dir


def metrics(obs: Observation) -> dict:
    """What was observed while writing; empty if Spark planned an empty input away.

    In that one case there is no metric row, which its Python bridge answers by a failed
    assertion; any other error is raised.
    """
    try:
        return obs.get
    except Py4JJavaError as err:
        if "PythonSQLUtils$.toPyRow" in str(err) and "AssertionError" in str(err):
            return {}
        raise


def observed(obs: Observation, key: str) -> int:
    """An observed count; none of an empty input."""
    return metrics(obs).get(key) or 0


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None when it does not exist."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err) or "UNABLE_TO_INFER_SCHEMA" in str(err):
            return None
        raise


def partition_numbers(spark: SparkSession, path: str, col: str) -> list[int]:
    """Integer values of the ``col=value`` folders directly under ``path`` (a listing of folders only)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(int(m.group(1)) for n in names if (m := re.fullmatch(rf"{re.escape(col)}=(-?\d+)", n)))


def newest_partition(spark: SparkSession, path: str, col: str) -> int | None:
    """Largest integer value of partition column ``col`` of the table at ``path``; no rows are read."""
    return max(partition_numbers(spark, path, col), default=None)


def require_table(spark: SparkSession, path: str, what: str) -> DataFrame:
    df = read_table(spark, path)
    if df is None:
        raise ValueError(f"{what} table does not exist at {path}")
    return df


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint under the shared folder: computed once, lineage cut.

    For a frame that several branches of one plan read (each branch would
    otherwise recompute it, since nothing in between is an exchange Spark can reuse).
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def stage(spark: SparkSession, df: DataFrame, name: str, partition_by=()) -> Iterator[DataFrame]:
    """Write ``df`` once under the shared folder and yield the re-read copy.

    The staged folder is deleted when the block ends, so scheduled refreshes do not
    leave a copy of their input behind on every run.
    """
    path = scratch_path(spark, name)
    try:
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _delete_path(spark, path)


def _delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)


def overwrite_partitions(df: DataFrame, target: str, partition_by, sort_within=()) -> None:
    """Replace the partitions of ``target`` that occur in ``df``; keep all others."""
    out = df.hint("rebalance", *partition_by)
    if sort_within:
        out = out.sortWithinPartitions(*sort_within)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(target)
    )


INTENT = "paths array<string>, partition_by array<string>, emptied array<string>, years array<int>"


def _intent_path(target: str) -> str:
    return f"{target.rstrip('/')}_intent"


def _announce(spark: SparkSession, target: str, paths=(), partition_by=(), emptied=(), years=()) -> None:
    """Record what a refresh is about to do to ``target``."""
    row = (list(paths), list(partition_by), list(emptied), list(years))
    versions.write_version(spark.createDataFrame([row], INTENT).coalesce(1), _intent_path(target), kept=1)


def _intent(spark: SparkSession, target: str):
    found = versions.read_version(spark, _intent_path(target))
    return found.first() if found is not None else None


def pending_years(spark: SparkSession, target: str) -> list[int]:
    """Years whose last refresh was announced but not finished; their source files must be loaded again."""
    intent = _intent(spark, target)
    return sorted(intent.years) if intent is not None else []


def _settle_years(spark: SparkSession, target: str, years) -> None:
    """These years are done; others that are still pending stay on record."""
    rest = sorted(set(pending_years(spark, target)) - set(years))
    if rest:
        _announce(spark, target, years=rest)
    else:
        _delete_path(spark, _intent_path(target))


def recover(spark: SparkSession, target: str) -> bool:
    """Finish a range refresh of ``target`` that was announced but not completed; True if there was one.

    The staged rows are written again (a dynamic overwrite can be repeated), emptied partitions removed, and the
    staged copies and the record deleted.
    """
    intent = _intent(spark, target)
    if intent is None or not intent.paths:
        return False
    parts = [spark.read.parquet(path) for path in intent.paths if read_table(spark, path) is not None]
    if parts:
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        overwrite_partitions(rows, target, intent.partition_by)
    _delete_folders(spark, target, intent.emptied)
    _delete_path(spark, _intent_path(target))
    for path in intent.paths:
        _delete_path(spark, path)
    return True


def replace_years(spark: SparkSession, incoming: DataFrame, target: str, year_col: str, years, sort_within=()) -> dict:
    """Replace the partitions ``years`` of ``target`` by the rows of ``incoming`` that lie in them.

    Rows of any other year (or none) are left out and counted: a stray row never replaces
    a year that is not being reloaded.  A reloaded year without rows loses its folder.
    Counts are gathered while writing (no extra scan).  The years are announced before the table is touched and
    the record goes when all is done, so a refresh that stops in between is known (``pending_years``).
    """
    years = sorted(int(y) for y in years)
    _announce(spark, target, years=sorted({*years, *pending_years(spark, target)}))
    obs = Observation("replace_years")
    wanted = F.coalesce(F.col(year_col).isin(years), F.lit(False))
    counted = incoming.observe(
        obs,
        F.count(F.when(wanted, F.lit(1))).alias("rows_loaded"),
        F.count(F.when(~wanted, F.lit(1))).alias("rows_other"),
        F.collect_set(F.when(wanted, F.col(year_col).cast("int"))).alias("present"),
    )
    overwrite_partitions(counted.where(wanted), target, [year_col], sort_within)
    found = metrics(obs)
    present = {int(y) for y in found.get("present") or []}
    _delete_folders(spark, target, [f"{year_col}={y}" for y in years if y not in present])
    _settle_years(spark, target, years)
    return {"rows_loaded": found.get("rows_loaded") or 0, "rows_other_years": found.get("rows_other") or 0}


def append_rows(df: DataFrame, target: str, schema, partition_by=()) -> int:
    """Append ``df``, conformed to ``schema`` (plus its partition columns), to the table at ``target``."""
    fields = {f.name for f in schema.fields}
    extra = [c for c in partition_by if c not in fields]
    casts = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    obs = Observation("append")
    w = df.select(*casts, *extra).observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(target)
    return observed(obs, "rows")


def _months(lo: dt.date, hi: dt.date) -> list[tuple[int, int]]:
    out, y, m = [], lo.year, lo.month
    while (y, m) <= (hi.year, hi.month):
        out.append((y, m))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def _delete_folders(spark: SparkSession, base: str, folders: list[str]) -> None:
    for rel in folders:
        _delete_path(spark, f"{base}/{rel}")


def replace_date_range(
    spark: SparkSession,
    new_rows: DataFrame,
    target: str,
    min_date,
    max_date,
    partition_by=("year", "month"),
) -> dict:
    """Delete target rows with min_date <= date <= max_date and insert ``new_rows``.

    Only the (year, month) partitions that overlap the range are read and rewritten:
    each becomes (its rows outside the range) + (new rows).  A touched partition that
    ends up empty is removed, since a dynamic overwrite never deletes a partition the
    data does not mention.  New and kept rows are staged and announced before the table is touched, so a
    refresh that stops half-way is finished, from the staged rows, at the start of the next.
    """
    recover(spark, target)
    lo, hi = dt.date.fromisoformat(str(min_date)), dt.date.fromisoformat(str(max_date))
    in_range = F.col("date").between(F.lit(lo), F.lit(hi))
    new_rows = new_rows.where(in_range)
    existing = read_table(spark, target)
    if existing is None:
        obs = Observation("range_new")
        overwrite_partitions(new_rows.observe(obs, F.count(F.lit(1)).alias("rows_inserted")), target, list(partition_by))
        return {"rows_deleted": 0, "rows_inserted": observed(obs, "rows_inserted")}

    year, month = partition_by
    months = _months(lo, hi)
    # Only the first and last month can hold rows outside the range; they are merged and staged.
    edges = sorted({months[0], months[-1]})
    month_no = F.col(year) * 12 + F.col(month)
    at_edge = month_no.isin([y * 12 + m for y, m in edges])
    touched = month_no.between(lo.year * 12 + lo.month, hi.year * 12 + hi.month)  # prunes to the touched months
    deleted = existing.where(touched & in_range).count()
    inserted = Observation("range_ins")
    new_rows = new_rows.select(*existing.columns).observe(
        inserted, F.count(F.lit(1)).alias("rows_inserted"), F.collect_set(F.struct(year, month)).alias("present")
    )
    paths = [scratch_path(spark, name) for name in ("range-replace-new", "range-replace-kept")]
    try:
        new_rows.write.partitionBy(*partition_by).parquet(paths[0])
        existing.where(at_edge & ~in_range).write.partitionBy(*partition_by).parquet(paths[1])
        counts = metrics(inserted)
        present = {(r[0], r[1]) for r in counts.get("present") or []}
        kept = read_table(spark, paths[1])
        if kept is not None:
            present |= {(r[0], r[1]) for r in kept.select(*partition_by).distinct().collect()}  # at most two months
        emptied = [f"{year}={y}/{month}={m}" for y, m in months if (y, m) not in present]
        _announce(spark, target, paths, partition_by, emptied)
    except Exception:
        for path in paths:
            _delete_path(spark, path)
        raise
    recover(spark, target)  # from here on a stopped refresh is finished by the next one
    return {"rows_deleted": deleted, "rows_inserted": counts.get("rows_inserted") or 0, "partitions_removed": len(emptied)}


def resume_from(spark: SparkSession, target: str, default_new=dt.date(2000, 1, 1), default_empty=dt.date(1900, 1, 1)) -> dt.date:
    """Start date for an incremental run.

    No table -> ``default_new``; table without dates -> ``default_empty``;
    otherwise its newest date itself (the last day is recomputed), from the Parquet footers.  For a table
    partitioned by year/month only those of the newest partition are read.  A table that cannot be
    read is an error: recomputing the whole history would hide it.
    """
    if read_table(spark, target) is None:
        return default_new
    year = newest_partition(spark, target, "year")
    month = newest_partition(spark, f"{target}/year={year}", "month") if year is not None else None
    inside = (F.col("year") == year) & (F.col("month") == month) if month is not None else None
    newest = from_footers(spark, target, [F.max("date").alias("date")], inside).first()[0]
    return newest if newest is not None else default_empty
