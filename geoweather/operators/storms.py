"""Storm-event normalisation: all-string staging rows -> typed 51-column table.

* integer columns: integer text casts directly, fractional text (hail sizes) is
  rounded half to even;
* damage columns: suffix text to dollars;
* BEGIN/END_DATE_TIME: rebuilt from the year-month, day and hhmm parts.

Instead of failing a whole file on one bad value, each row is checked: a row whose
non-empty numeric or damage text cannot be converted is *rejected*; a row whose
date parts form no valid time is kept with a NULL timestamp and *reported*.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoweather.functions.casts import text_to_double, text_to_long
from geoweather.functions.damage import damage_to_dollars
from geoweather.functions.timeparts import parts_to_timestamp
from geoweather.operators.fence import filter_on_output
from geoweather.schemas import STORM_EVENTS
from geoweather.sources.storms import CORRUPT

DAMAGE_COLUMNS = ("DAMAGE_PROPERTY", "DAMAGE_CROPS")
TIME_COLUMNS = {
    "BEGIN_DATE_TIME": ("BEGIN_YEARMONTH", "BEGIN_DAY", "BEGIN_TIME"),
    "END_DATE_TIME": ("END_YEARMONTH", "END_DAY", "END_TIME"),
}


# Where a row came from; kept beside the typed columns if the input has them.
PROVENANCE = ("source_file", "file_year", "stamp")


def _typed(name: str, dtype: T.DataType, src: Column) -> Column:
    if name in DAMAGE_COLUMNS:
        return damage_to_dollars(src)
    if isinstance(dtype, T.LongType):
        return text_to_long(src)
    if isinstance(dtype, T.DoubleType):
        return text_to_double(src)
    return src.cast(dtype)


def _present(src: Column) -> Column:
    return src.isNotNull() & (F.trim(src) != F.lit(""))


def spread(df: DataFrame, splits: int, waves: int = 1) -> DataFrame:
    """Round-robin the rows over all cores when the input has fewer splits than cores.

    Typing costs microseconds per value, so a handful of large input splits (a
    gzip file is one split) would leave most cores idle.  With enough input
    splits (any large table) this is a no-op and adds no shuffle.  ``waves`` is the number of
    parts per core: with as many as there are full splits, a part stays a fraction of one split.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * max(waves, 1)) if splits < cores else df


def typed_storms(raw: DataFrame, splits: int | None = None, waves: int = 1) -> DataFrame:
    """Typed storm columns plus ``reject_reasons`` and ``time_issues`` (comma-joined column names, '' if none).

    Columns of ``PROVENANCE`` that ``raw`` has are passed on; a row whose ``_corrupt_record`` is
    set is rejected as MALFORMED.  ``splits`` is the number of input splits, if it is known (``waves``: see ``spread``).

    Three projections, each expensive conversion computed once per row: the
    checks in later steps refer to the converted columns, and Spark does not
    inline an expensive column that is used more than once.  Reasons are joined
    with ``concat_ws`` (skips NULLs) rather than array lambdas, which would drop
    the projection out of whole-stage codegen.
    """
    have = set(raw.columns)
    typed_cols, raw_cols, checks = [], [], []
    for f in STORM_EVENTS.fields:
        if f.name in TIME_COLUMNS:
            continue
        src = F.col(f.name).cast("string") if f.name in have else F.lit(None).cast("string")
        typed_cols.append(_typed(f.name, f.dataType, src).alias(f.name))
        if not isinstance(f.dataType, T.StringType) and f.name in have:
            raw_cols.append(src.alias(f"_raw_{f.name}"))
            checks.append(F.when(_present(F.col(f"_raw_{f.name}")) & F.col(f.name).isNull(), F.lit(f.name)))
    if CORRUPT in have:
        raw_cols.append(F.col(CORRUPT).alias(f"_raw_{CORRUPT}"))
        checks.append(F.when(F.col(f"_raw_{CORRUPT}").isNotNull(), F.lit("MALFORMED")))
    kept = [c for c in PROVENANCE if c in have]
    step1 = (raw if splits is None else spread(raw, splits, waves)).select(*typed_cols, *raw_cols, *kept)
    times = [
        parts_to_timestamp(F.col(ym), F.col(day), F.col(hhmm)).alias(name)
        for name, (ym, day, hhmm) in TIME_COLUMNS.items()
    ]
    step2 = step1.select(
        *[c for c in step1.columns if not c.startswith("_raw_")],
        *times,
        (F.concat_ws(",", *checks) if checks else F.lit("")).alias("reject_reasons"),
    )
    issues = []
    for name, (ym, day, hhmm) in TIME_COLUMNS.items():
        parts_known = F.col(ym).isNotNull() & F.col(day).isNotNull() & F.col(hhmm).isNotNull()
        issues.append(F.when(parts_known & F.col(name).isNull(), F.lit(name)))
    step3 = step2.select("*", F.concat_ws(",", *issues).alias("time_issues"))
    return step3.select(*[F.col(f.name) for f in STORM_EVENTS.fields], "reject_reasons", "time_issues", *kept)


def normalise_storms(raw: DataFrame, splits: int | None = None, waves: int = 1) -> tuple[DataFrame, DataFrame]:
    """(rows, issues).

    ``rows``: loadable rows in the ``storm_events`` schema (invalid times are NULL).
    ``issues``: EVENT_ID, YEAR, rejected flag and reasons for every row with a problem.
    Both come from one typed projection; callers that write both should stage it
    once (see ``plans.tables.ingest_storms``).
    """
    typed = typed_storms(raw, splits, waves)
    rows = filter_on_output(typed, F.col("reject_reasons") == "").select(*[f.name for f in STORM_EVENTS.fields])
    return rows, storm_issues(typed)


def storm_issues(typed: DataFrame) -> DataFrame:
    """EVENT_ID, YEAR, rejected, reasons for typed rows with any problem."""
    rejected = F.col("reject_reasons") != ""
    return filter_on_output(typed, rejected | (F.col("time_issues") != "")).select(
        "EVENT_ID",
        "YEAR",
        rejected.alias("rejected"),
        F.concat_ws(",", F.nullif("reject_reasons", F.lit("")), F.nullif("time_issues", F.lit(""))).alias("reasons"),
        *[c for c in PROVENANCE if c in typed.columns],
    )
