"""Year-month / day / hhmm integer parts to a wall-clock timestamp (no time zone).

* year-month must have exactly 6 digits: year = ym div 100, month = ym mod 100;
* day is 0..99, hhmm 0..9999 with hour = hhmm div 100 and minute = hhmm mod 100;
* a longer part is not cut to fit: like any part that forms no valid calendar time
  (month 13, Feb 30, hour 24, a negative part) it gives NULL, which callers report.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parts_text(yearmonth, day, hhmm) -> Column:
    """The textual form 'YYYYMM-DD HHMM' of the parts (for display and reports)."""
    return F.concat(
        _c(yearmonth).cast("string"),
        F.lit("-"),
        F.lpad(_c(day).cast("string"), 2, "0"),
        F.lit(" "),
        F.lpad(_c(hhmm).cast("string"), 4, "0"),
    )


def parts_to_timestamp(yearmonth, day, hhmm) -> Column:
    """TIMESTAMP_NTZ from integer parts; NULL when a part is NULL or the parts form no valid time."""
    ym, d, t = _c(yearmonth).cast("bigint"), _c(day).cast("bigint"), _c(hhmm).cast("bigint")
    valid_text = ym.between(100000, 999999) & d.between(0, 99) & t.between(0, 9999)
    dd, tt = d.cast("int"), t.cast("int")
    return F.when(
        valid_text,
        F.try_make_timestamp_ntz(
            (ym / 100).cast("int"), (ym % 100).cast("int"), dd, (tt / 100).cast("int"), tt % 100, F.lit(0)
        ),
    )


def timestamp_is_valid(yearmonth, day, hhmm) -> Column:
    """True when all parts are NULL-free and form a real time, or when a part is missing."""
    any_null = _c(yearmonth).isNull() | _c(day).isNull() | _c(hhmm).isNull()
    return any_null | parts_to_timestamp(yearmonth, day, hhmm).isNotNull()
