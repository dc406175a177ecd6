"""Guarded text-to-number casts.

Spark's string->double cast accepts Java float suffixes (``5d``, ``5f``) that other
engines reject, so every text cast goes through a numeric pattern first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as a number in source text (decimal, exponent, inf/nan words).
NUMBER_PATTERN = r"(?i)^\s*[+-]?(((\d+\.?\d*)|(\.\d+))(e[+-]?\d+)?|inf|infinity|nan)\s*$"
INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_number(text) -> Column:
    return _c(text).rlike(NUMBER_PATTERN)


def text_to_double(text) -> Column:
    """NULL unless the text is a plain number; never raises."""
    t = _c(text).cast("string")
    return F.when(t.rlike(NUMBER_PATTERN), F.trim(t).try_cast("double"))


def round_half_even_to_long(value) -> Column:
    """double -> bigint rounding half to even (1.75 -> 2, 2.5 -> 2, 0.5 -> 0)."""
    return F.bround(_c(value).cast("double"), 0).try_cast("bigint")


def text_to_long(text) -> Column:
    """Integer text casts directly; other numeric text is rounded half to even."""
    t = _c(text).cast("string")
    return F.when(t.rlike(INTEGER_PATTERN), F.trim(t).try_cast("bigint")).otherwise(
        round_half_even_to_long(text_to_double(t))
    )
