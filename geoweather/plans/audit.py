"""A durable audit of loads: an append-only table with one row per figure of each run.

Jobs return counts that they gathered while writing.  ``audited`` runs a job and appends its figures when
it ends, or the error that ended it, so the table tells what every run did, also of runs that failed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

AUDIT = "run_id string, job string, target string, started timestamp, ended timestamp, outcome string, figure string, amount bigint"
DONE, FAILED = "done", "failed"


def _figures(counts: dict) -> list[tuple[str, int]]:
    """Figures of a job's result: its numbers, and the lengths of its lists."""
    out = []
    for key, value in counts.items():
        if isinstance(value, bool) or value is None:
            continue
        if isinstance(value, int):
            out.append((key, value))
        elif isinstance(value, (list, tuple, set)):
            out.append((key, len(value)))
    return out


def record(spark: SparkSession, audit_path: str, job: str, target: str, started: dt.datetime, outcome: str, figures) -> str:
    """Append one run; returns its id."""
    run_id, ended = uuid.uuid4().hex, dt.datetime.now()
    rows = [(run_id, job, target, started, ended, outcome, key, value) for key, value in figures or [("none", 0)]]
    spark.createDataFrame(rows, AUDIT).coalesce(1).write.mode("append").parquet(audit_path)
    return run_id


def audited(spark: SparkSession, audit_path: str, job: str, target: str, run: Callable[[], dict]) -> dict:
    """Run a job and append what it did to the audit; an error is recorded and raised again."""
    started = dt.datetime.now()
    try:
        counts = run()
    except Exception:
        record(spark, audit_path, job, target, started, FAILED, [])
        raise
    record(spark, audit_path, job, target, started, DONE, _figures(counts))
    return counts


def run_history(audit: DataFrame) -> DataFrame:
    """(job, target, run_no, outcome, figure, amount, change): each figure beside that of the run before of the same job and target."""
    started = Window.partitionBy("job", "target").orderBy("started", "run_id")
    numbered = audit.select("job", "target", "run_id", "started").distinct().withColumn("run_no", F.row_number().over(started))
    rows = audit.join(numbered.select("run_id", "run_no"), "run_id")
    earlier = F.lag("amount").over(Window.partitionBy("job", "target", "figure").orderBy("run_no"))
    return rows.select("job", "target", "run_no", "outcome", "figure", "amount", (F.col("amount") - earlier).alias("change"))
