"""Row-by-row comparison of two states of a table (listings, station lists, inventories)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEW, REMOVED, CHANGED, SAME = "new", "removed", "changed", "same"


def compare_tables(before: DataFrame, after: DataFrame, keys, values) -> DataFrame:
    """Keys, ``before_*`` and ``after_*`` of each value column, and ``change`` (new, removed, changed or same).

    One full outer equi-join on the keys, which identify rows within each side; nulls equal
    each other in keys and values.  Rows of a key that repeats within a side are compared pairwise.
    """
    keys, values = list(keys), list(values)
    old = before.select(*[F.col(k).alias(f"_old_{k}") for k in keys], *[F.col(v).alias(f"before_{v}") for v in values], F.lit(True).alias("_in_old"))
    new = after.select(*[F.col(k).alias(f"_new_{k}") for k in keys], *[F.col(v).alias(f"after_{v}") for v in values], F.lit(True).alias("_in_new"))
    on = reduce(lambda a, b: a & b, [F.col(f"_old_{k}").eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    both = old.join(new, on, "full")
    equal = reduce(lambda a, b: a & b, [F.col(f"before_{v}").eqNullSafe(F.col(f"after_{v}")) for v in values], F.lit(True))
    change = (
        F.when(F.col("_in_old").isNull(), F.lit(NEW))
        .when(F.col("_in_new").isNull(), F.lit(REMOVED))
        .when(equal, F.lit(SAME))
        .otherwise(F.lit(CHANGED))
    )
    return both.select(
        *[F.when(F.col("_in_new").isNull(), F.col(f"_old_{k}")).otherwise(F.col(f"_new_{k}")).alias(k) for k in keys],
        *[c for v in values for c in (f"before_{v}", f"after_{v}")],
        change.alias("change"),
    )


# Classes of the inventory comparison by what happened to a row from the published to the recomputed table.
INVENTORY_CLASSES = {NEW: "extra", REMOVED: "missing", CHANGED: "other years", SAME: "same"}


def reconcile_inventory(published: DataFrame, recomputed: DataFrame) -> DataFrame:
    """(id, element, published and recomputed first and last year, class) of every series either table knows.

    ``missing``: published, but no unflagged reading; ``extra``: read, but not published; ``other
    years``: both, with another first or last year.
    """
    found = compare_tables(published, recomputed, ["id", "element"], ["firstyear", "lastyear"])
    names = F.create_map(*[F.lit(x) for pair in INVENTORY_CLASSES.items() for x in pair])
    return found.select(
        "id",
        "element",
        F.col("before_firstyear").alias("published_first"),
        F.col("before_lastyear").alias("published_last"),
        F.col("after_firstyear").alias("recomputed_first"),
        F.col("after_lastyear").alias("recomputed_last"),
        names[F.col("change")].alias("class"),
    )
