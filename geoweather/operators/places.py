"""Facts of stations spread over the ZIPs linked to them, without a shuffle of the pairs.

A station's facts belong to every ZIP linked to it, so their pairs with ZIPs are many times the facts, and a sum by ZIP and
day that shuffles pairs moves all of them.  Here ZIPs are dealt to *places*: parts of a degree cell that hold about
``LINKS_PER_PLACE`` links (ZIPs without coordinates are dealt by hash), and a place's links are packed in one row.  Facts go
once to each place with a ZIP of their station, which neighbouring ZIPs share, and meet the packed row there.  All pairs of
a ZIP are then in one partition, and a sum whose keys begin with ``place`` needs no further shuffle.  ``place`` is a function
of ``zipcode``, so it never splits a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LINKS_PER_PLACE = 20_000
HASHED_CELLS = 1024
LEVELS = 12
COORDINATES = ("zipcode_latitude", "zipcode_longitude")


def link_columns(links: DataFrame) -> list[str]:
    """The columns of links that a spread needs."""
    return ["zipcode", "station_id", *[c for c in COORDINATES if c in links.columns]]


def _placed_zips(links: DataFrame, most: int) -> DataFrame:
    """(place, zipcode, ids): each ZIP with its station ids, as often as they are linked."""
    at = [F.min(c) if c in links.columns else F.lit(None).cast("double") for c in COORDINATES]
    zips = links.groupBy("zipcode").agg(F.collect_list("station_id").alias("ids"), *[c.alias(f"_p{i}") for i, c in enumerate(at)])
    known = F.col("_p0").isNotNull() & F.col("_p1").isNotNull()
    hashed = F.pmod(F.xxhash64("zipcode"), F.lit(HASHED_CELLS))
    zips = zips.withColumn("_cell", F.when(known, F.xxhash64(F.floor("_p0"), F.floor("_p1"))).otherwise(hashed))
    held = F.size("ids") + F.lit(1)

    def share(*keys: str) -> Column:
        return F.sum(held).over(Window.partitionBy(*keys)) / F.lit(float(most))

    # A cell is halved along both axes until its parts hold ``most`` links on average; a part that holds more is split by hash.
    level = F.least(F.lit(LEVELS), F.greatest(F.lit(0), F.ceil(F.log(4.0, share("_cell")))))
    zips = zips.withColumn("_scale", F.pow(F.lit(2.0), level))
    zips = zips.withColumns({f"_part{i}": F.floor(F.col(f"_p{i}") * F.col("_scale")) for i in (0, 1)})
    zips = zips.withColumn("_salt", F.pmod(F.xxhash64("zipcode"), F.ceil(share("_cell", "_part0", "_part1"))))
    return zips.select(F.xxhash64("_cell", "_part0", "_part1", "_salt").alias("place"), "zipcode", "ids")


def spread(facts: DataFrame, links: DataFrame, dates: Column | None = None, most: int = LINKS_PER_PLACE) -> DataFrame:
    """``facts`` (id, date, ...) for every ZIP linked to their station: (place, zipcode, date, ...).

    With ``dates`` (an array), every linked ZIP also gets one row a date, empty otherwise.
    """
    n = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [c for c in facts.columns if c != "id"]
    zips = _placed_zips(links, most).repartition(n, "place").select("place", "zipcode", F.explode_outer("ids").alias("id"))
    stations = zips.groupBy("place", "id").agg(F.collect_list(F.struct("zipcode")).alias("zips"))
    packed = stations.groupBy("place").agg(F.sort_array(F.collect_list(F.struct("id", "zips"))).alias("stations"))

    # A station is known by its position in the place's row.
    pairs = packed.select("place", F.posexplode(F.transform("stations", lambda s: s["id"])).alias("_nth", "id"))
    rows = facts.join(pairs.where(F.col("id").isNotNull()), "id").select("place", "_nth", *columns)
    zips_of = F.transform("stations", lambda s: F.transform(s["zips"], lambda z: z["zipcode"]))
    found = F.get("_zips", F.col("_nth"))
    lists = [zips_of.alias("_zips")]
    if dates is not None:
        empty = [F.lit(None).cast(facts.schema[c].dataType).alias(c) for c in columns if c != "date"]
        days = packed.select("place", F.explode(dates).alias("date"))
        rows = rows.unionByName(days.select("place", F.lit(None).cast("int").alias("_nth"), "date", *empty))
        lists.append(F.array_distinct(F.flatten(zips_of)).alias("_all"))
        found = F.when(F.col("_nth").isNull(), F.col("_all")).otherwise(found)
    links_of = packed.select("place", *lists).hint("shuffle_hash")
    return rows.repartition(n, "place").join(links_of, "place").select("place", F.explode(found).alias("zipcode"), *columns)
