"""Storm damage text ("10.00K", "1.5M", "2B") to dollars, as one column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoweather.functions.casts import text_to_double

# Damage suffix letters and their multipliers, checked in this order.
DAMAGE_SUFFIXES = (("K", 1_000.0), ("M", 1_000_000.0), ("B", 1_000_000_000.0))


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def damage_to_dollars(text) -> Column:
    """Dollar amount of a damage text.

    NULL or empty -> 0.  Upper-cased text ending in K/M/B: every occurrence of that
    letter is removed and the rest is scaled (an empty rest is 0).  Any other text
    is read as a plain number, or 0 when it is not one.  A suffixed text whose rest
    is not a number yields NULL; ``damage_is_valid`` flags those rows for rejection.
    """
    s = _c(text).cast("string")
    upper = F.upper(s)
    last = F.substring(upper, -1, 1)
    scale = F.lit(None).cast("double")
    for letter, factor in reversed(DAMAGE_SUFFIXES):
        scale = F.when(last == F.lit(letter), F.lit(factor)).otherwise(scale)
    rest = F.replace(upper, last, F.lit(""))
    return (
        F.when(s.isNull() | (s == F.lit("")), F.lit(0.0))
        .when(scale.isNotNull(), F.when(rest == F.lit(""), F.lit(0.0)).otherwise(text_to_double(rest) * scale))
        .otherwise(F.coalesce(text_to_double(s), F.lit(0.0)))
    )


def damage_is_valid(text) -> Column:
    """False only where ``damage_to_dollars`` had to give up (bad number before a suffix)."""
    return damage_to_dollars(text).isNotNull()
