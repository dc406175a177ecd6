"""Connected components of an undirected graph given as links (a, b) of longs.

Alternating large-star and small-star steps: every round replaces links by links to the
smallest neighbour, so the number of rows never grows beyond the links, whatever the shape of
a component, and the rounds needed grow with the logarithm of its diameter.  Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweather.llm.common import stage


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("least"))


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link."""
    pair = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pair = stage(pair, "cc-links")
    checksum = (F.count("*"), F.bit_xor(F.xxhash64("u", "v")))
    seen = pair.agg(*checksum).first()
    while seen[0]:
        # Large star: every larger neighbour of u is linked to the smallest one around u.
        both = pair.unionByName(pair.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both).select("of", F.least("of", "least").alias("least"))
        star = both.where("v > u").join(least, F.col("u") == F.col("of")).select(F.col("v").alias("u"), F.col("least").alias("v"))
        star = stage(star.where("u <> v").distinct(), "cc-large")
        # Small star: smaller neighbours of u, and u, are linked to the smallest of them.
        joined = star.join(_least(star), F.col("u") == F.col("of"))
        small = joined.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(joined.select("u", F.col("least").alias("v")))
        pair = stage(small.where("u <> v").distinct(), "cc-small")
        now = pair.agg(*checksum).first()
        if now == seen:
            break
        seen = now
    found = pair.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.unionByName(pair.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
