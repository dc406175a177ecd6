"""Daily weather metrics per ZIP code from nearby station readings.

Semantics (one output row per ZIP x date):
* ZIPs: those with at least one linked station within ``max_miles``;
* dates: every date that has *any* raw observation in [min_date, max_date]
  (any element, any flag, any station);
* per core element: AVG, COUNT(*) and sample STDDEV of unflagged readings of
  the linked stations; all three NULL when the element has no reading.

Plan: readings (observations spread over the linked ZIPs) and the
ZIP x date spine are reduced by ONE conditional aggregation on
(zipcode, date).  Every reading's key is in the spine, so this equals the
spine LEFT JOIN pivoted-metrics formulation with no separate join.  Both are made
place by place (``operators.places``), so neither the readings, many times the
observations, nor their sums are shuffled.  Groups are small by construction: a ZIP
has at most k linked stations.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoweather.operators.places import link_columns, spread
from geoweather.schemas import CORE_ELEMENTS

# Broadcast the near links (zipcode, station_id, distance) up to this many rows
# (~64 MB as a hash relation); beyond it the readings join shuffles.
MAX_BROADCAST_LINKS = 1_000_000


def _as_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def in_date_range(obs: DataFrame, min_date, max_date) -> DataFrame:
    """Observations with min_date <= date <= max_date.

    When the frame carries a ``year`` partition column the equivalent year bounds
    are added, so partition pruning skips whole years (a date predicate alone does
    not prune ``year=`` folders).
    """
    lo, hi = _as_date(min_date), _as_date(max_date)
    cond = F.col("date").between(F.lit(lo), F.lit(hi))
    if "year" in obs.columns:
        cond = F.col("year").between(F.lit(lo.year), F.lit(hi.year)) & cond
    return obs.where(cond)


def near_links(links: DataFrame, max_miles: float) -> DataFrame:
    """Links whose station lies within ``max_miles`` of the ZIP."""
    return links.where(F.col("distance_miles") <= F.lit(float(max_miles)))


def _good(obs_in_range: DataFrame, elements) -> DataFrame:
    """(id, date, element, data_value) of unflagged core readings."""
    return obs_in_range.where(F.col("element").isin(*elements) & F.col("q_flag").isNull()).select("id", "date", "element", "data_value")


def readings(
    obs_in_range: DataFrame, links: DataFrame, elements=CORE_ELEMENTS, by_place: bool = False
) -> DataFrame:
    """(zipcode, date, element, data_value, distance_miles) for unflagged core readings of linked stations.

    For sums by ZIP, ``by_place`` keeps each ZIP's readings in one partition, known by ``place``, which replaces the distance.
    """
    good = _good(obs_in_range, elements)
    if by_place:
        return spread(good, links.select(*link_columns(links)))
    lk = links.select(F.col("station_id").alias("id"), "zipcode", "distance_miles")
    return good.join(lk, "id").select("zipcode", "date", "element", "data_value", "distance_miles")


def observed_dates(obs_in_range: DataFrame) -> Column:
    """The dates that have any observation, as one array (at most one entry per day of the range)."""
    return obs_in_range.agg(F.collect_set("date")).scalar()


def zip_date_spine(links: DataFrame, obs_in_range: DataFrame) -> DataFrame:
    """Every linked ZIP x every date that has any observation in range.

    The observed dates are gathered by one aggregation into an array that each ZIP expands;
    the observations' dates are read once.
    """
    return links.select("zipcode").distinct().select("zipcode", F.explode(observed_dates(obs_in_range)).alias("date"))


def _element_aggs(elements=CORE_ELEMENTS) -> list[Column]:
    out = []
    for element in elements:
        m = element.lower()
        hit = F.col("element") == F.lit(element)
        value = F.when(hit, F.col("data_value"))
        out += [
            F.avg(value).alias(m),
            F.nullif(F.count(F.when(hit, F.lit(1))), F.lit(0)).cast("int").alias(f"{m}_count"),
            F.stddev_samp(value).alias(f"{m}_stddev"),
        ]
    return out


def _place(rows: DataFrame) -> list[str]:
    """The key that rows of ``spread`` are dealt by; it depends on the ZIP alone."""
    return [c for c in rows.columns if c == "place"]


def element_stats_long(reads: DataFrame) -> DataFrame:
    """AVG / COUNT(*) / sample STDDEV per (zipcode, date, element)."""
    return reads.groupBy(*_place(reads), "zipcode", "date", "element").agg(
        F.avg("data_value").alias("mean"),
        F.count(F.lit(1)).alias("readings"),
        F.stddev_samp("data_value").alias("spread"),
    ).drop("place")


def element_stats_wide(reads: DataFrame, elements=CORE_ELEMENTS) -> DataFrame:
    """One row per (zipcode, date) with avg/count/stddev columns per element (no spine)."""
    return reads.groupBy(*_place(reads), "zipcode", "date").agg(*_element_aggs(elements)).drop("place")


def daily_metrics(
    obs: DataFrame,
    links: DataFrame,
    min_date,
    max_date,
    max_miles: float = 20.0,
    elements=CORE_ELEMENTS,
    broadcast_links: bool = False,
) -> DataFrame:
    """The ``zipcode_daily_metrics`` rows for [min_date, max_date].

    ``broadcast_links`` is for callers that have counted the near links (at most
    ``MAX_BROADCAST_LINKS``): they are then joined where the observations are read and only
    aggregates shuffle.  Otherwise the observations are spread place by place.
    """
    near = near_links(links, max_miles)
    obs_r = in_date_range(obs, min_date, max_date)
    if broadcast_links:
        near = near.select("zipcode", "station_id", "distance_miles")
        spine = zip_date_spine(near, obs_r).select(
            "zipcode",
            "date",
            F.lit(None).cast("string").alias("element"),
            F.lit(None).cast("int").alias("data_value"),
        )
        reads = readings(obs_r, F.broadcast(near), elements).select("zipcode", "date", "element", "data_value")
        rows = spine.unionByName(reads)
    else:
        rows = spread(_good(obs_r, elements), near.select(*link_columns(near)), observed_dates(obs_r))
    wide = rows.groupBy(*_place(rows), "zipcode", "date").agg(*_element_aggs(elements))
    metric_cols = [c for e in elements for c in (e.lower(), f"{e.lower()}_count", f"{e.lower()}_stddev")]
    return wide.select(
        "zipcode",
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        *metric_cols,
    )
