"""Exact k nearest stations of every ZIP, on a grid whose cells follow the density of the stations.

A fixed radius holds more stations the more there are, so its pairs grow with ZIPs x stations.  Here cells are halved
from a base size, ``LEVELS`` times, and the stations of each cell are counted on every level (a point counts k stations
at most: of stations on one point only the k with the smallest ids can be among the k nearest).  A cell is *settled* if the
block of it and its neighbours holds k stations that all pass the limits: the k-th station of any ZIP in it
is then no farther than the block's extent.  A settled cell's parent is settled too.  Each ZIP belongs to the finest settled cell around it, its
*leaf* (else to its base cell, with the full reach), and meets the stations within the leaf's bound alone: a small
multiple of k where density is even, whatever it is.

Stations of a leaf are packed in arrays of at most ``CHUNK``; a ZIP takes the k nearest of each array, so only they
are shuffled and ranked by ``zipcode``.  Leaves with many ZIPs are split by salts.  No table passes the driver or is assumed small.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVELS = 10
CHUNK = 512
STATION = ("station_id", "station_name", "station_latitude", "station_longitude")
ZIP = ("zipcode", "zipcode_latitude", "zipcode_longitude")


class Space(NamedTuple):
    """Geometry of a search.  Frames carry a point's coordinates as ``_p0``, ``_p1``, ...; a cell is ``_c0``, ``_c1``, ... of a ``_level``.

    ``bound``: upper bound of the distance from a ZIP in the cell to a station in its block;
    ``settles``: whether all pairs of that kind pass the limits; ``full``: the reach of a base cell;
    ``reach``: per axis, how far from the cell a station within ``_bound`` can lie; ``touches``: whether points of the
    space can lie in a cell; ``within``: False only if no ZIP in the cell is within ``_bound`` of the point.
    """

    axes: int
    base: float
    bound: Callable[[Column], Column]
    settles: Callable[[Column, Column], Column]
    full: Column
    reach: Callable[[Column], list[Column]]
    touches: Callable[[Column], Column] | None
    within: Callable[[Column], Column]


def _size(space: Space, level="_level") -> Column:
    return F.lit(space.base) / F.pow(F.lit(2.0), F.greatest(F.col(level), F.lit(0)))


def _ancestors(space: Space) -> list[Column]:
    """Cells on ``_level`` from those on the finest."""
    return [F.expr(f"shiftright(_f{i}, {LEVELS} - greatest(_level, 0))").alias(f"_c{i}") for i in range(space.axes)]


def _on_finest(df: DataFrame, space: Space) -> DataFrame:
    width = F.lit(space.base / 2**LEVELS)
    return df.withColumns({f"_f{i}": F.floor(F.col(f"_p{i}") / width) for i in range(space.axes)})


def _settled_cells(stations: DataFrame, space: Space, k: int) -> DataFrame:
    """(_level, cell) of the settled cells."""
    cell = [f"_c{i}" for i in range(space.axes)]
    finest = [f"_f{i}" for i in range(space.axes)]
    points = stations.groupBy(*finest).agg(F.count(F.lit(1)).alias("_n"))
    levels = points.select(*finest, "_n", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("_level"))
    blocks = levels.select("_level", "_n", *_ancestors(space)).groupBy("_level", *cell).agg(F.sum("_n").alias("_n"))
    for c in cell:
        blocks = blocks.select(*[x for x in blocks.columns if x != c], F.explode(F.sequence(F.col(c) - 1, F.col(c) + 1)).alias(c))
    if space.touches is not None:
        blocks = blocks.where(space.touches(_size(space)))
    blocks = blocks.groupBy("_level", *cell).agg(F.sum("_n").alias("_n")).where(F.col("_n") >= F.lit(max(k, 1)))
    return blocks.where(space.settles(_size(space), space.bound(_size(space)))).select("_level", *cell)


def nearest_in_space(
    zips: DataFrame, stations: DataFrame, space: Space, k: int, passes: Callable[[Column, Column], Column],
    distance: Callable[[Column], Column], pairs_per_task: int,
) -> DataFrame:
    """The k nearest stations of each ZIP among the pairs that pass, ranked per zipcode, ties to the smaller station_id.

    ``distance`` and ``passes`` take a station (a struct of ``STATION``), the latter with its distance.
    """
    cell = [f"_c{i}" for i in range(space.axes)]
    finest = [f"_f{i}" for i in range(space.axes)]
    coords = [f"_p{i}" for i in range(space.axes)]
    leaf = ["_leaf", *cell]

    on_point = Window.partitionBy(*coords).orderBy("station_id")
    s = stations.withColumn("_nth", F.row_number().over(on_point)).where(F.col("_nth") <= F.lit(max(k, 1))).drop("_nth")
    s = _on_finest(s, space)
    z = _on_finest(zips, space)
    settled = _settled_cells(s, space, k)
    levels = F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("_level")

    # The leaf of each place that holds ZIPs: the finest settled cell around it.
    places = z.groupBy(*finest).agg(F.count(F.lit(1)).alias("_zips"))
    around = places.select(*finest, "_zips", levels)
    around = around.select(*finest, "_zips", "_level", *_ancestors(space))
    around = around.join(settled.withColumn("_settled", F.lit(True)), ["_level", *cell], "left")
    homes = around.groupBy(*finest, "_zips").agg(F.coalesce(F.max(F.when(F.col("_settled"), F.col("_level"))), F.lit(-1)).alias("_level"))
    homes = homes.select(*finest, "_zips", F.col("_level").alias("_leaf"), *_ancestors(space))
    in_leaf = F.sum("_zips").over(Window.partitionBy(*leaf))
    homes = homes.select(*finest, *leaf, F.ceil(in_leaf / F.lit(max(1, pairs_per_task // CHUNK))).cast("int").alias("_salts"))
    leaves = homes.select(*leaf, "_salts").distinct()

    # Stations within a leaf's bound.
    size = _size(space, "_leaf")
    wide = leaves.withColumn("_bound", F.when(F.col("_leaf") < 0, space.full).otherwise(space.bound(size)))
    lows, highs = [f"_lo{i}" for i in range(space.axes)], [f"_hi{i}" for i in range(space.axes)]
    wide = wide.withColumns({x: F.col(c) * size for x, c in zip(lows, cell)} | {x: (F.col(c) + 1) * size for x, c in zip(highs, cell)})
    wide = wide.select("*", *[r.alias(f"_r{i}") for i, r in enumerate(space.reach(F.col("_bound")))])
    for i in range(space.axes):
        first, last = (F.floor(x / size) for x in (F.col(f"_lo{i}") - F.col(f"_r{i}"), F.col(f"_hi{i}") + F.col(f"_r{i}")))
        wide = wide.withColumn(f"_at{i}", F.explode(F.sequence(first, last)))
    if space.touches is not None:
        # ``touches`` looks at the cell columns, which are those of the leaf here.
        other = wide.select("*", *[F.col(c).alias(f"_own{i}") for i, c in enumerate(cell)]).withColumns({c: F.col(f"_at{i}") for i, c in enumerate(cell)})
        other = other.where(space.touches(size)).withColumns({c: F.col(f"_own{i}") for i, c in enumerate(cell)})
        wide = other.drop(*[f"_own{i}" for i in range(space.axes)])
    wide = wide.withColumn("_at", F.greatest(F.col("_leaf"), F.lit(0)))
    held = s.select(*STATION, *coords, *finest, levels)
    held = held.select(*STATION, *coords, F.col("_level").alias("_at"), *[c.alias(f"_at{i}") for i, c in enumerate(_ancestors(space))])
    near = wide.join(held, ["_at", *[f"_at{i}" for i in range(space.axes)]]).where(space.within(F.col("_bound")))
    near = near.select(*leaf, "_salts", *STATION)
    nth = F.row_number().over(Window.partitionBy(*leaf).orderBy("station_id"))
    near = near.withColumn("_chunk", F.floor((nth - 1) / F.lit(CHUNK)))
    packed = near.groupBy(*leaf, "_salts", "_chunk").agg(F.collect_list(F.struct(*STATION)).alias("_stations"))
    packed = packed.select(*leaf, "_stations", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"))

    salt = F.pmod(F.xxhash64(*ZIP), F.col("_salts")).cast("int")
    z = z.join(homes, finest).select(*ZIP, *leaf, salt.alias("_salt"))

    def measured(station: Column) -> Column:
        return F.struct(distance(station).alias("distance_miles"), *[station[c].alias(c) for c in STATION])

    pairs = F.filter(F.transform("_stations", measured), lambda p: passes(p, p["distance_miles"]))
    nearest = F.slice(F.sort_array(pairs), 1, max(k, 1))
    found = z.join(packed.hint("shuffle_hash"), [*leaf, "_salt"]).select(*ZIP, F.explode(nearest).alias("_s"))
    found = found.select("zipcode", *[F.col(f"_s.{c}").alias(c) for c in STATION], *ZIP[1:], F.col("_s.distance_miles").alias("distance_miles"))
    by_zip = Window.partitionBy("zipcode").orderBy("distance_miles", "station_id")
    return found.withColumn("rank", F.row_number().over(by_zip).cast("int")).where(F.col("rank") <= F.lit(k))
