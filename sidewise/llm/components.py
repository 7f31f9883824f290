"""Connected components by alternating large-star and small-star steps, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) for every node of ``links`` (columns a and b).

    Each step is written to the shared folder; nothing but a count and a checksum of
    the links comes to the driver.  Self links and repeated links are ignored.
    """
    u, v = F.col("u"), F.col("v")
    stars = stored(
        links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    seen = None
    while True:
        # Large star: larger neighbours move to the smallest of the neighbourhood.
        both = stars.unionByName(stars.select(v.alias("u"), u.alias("v")))
        least = both.groupBy(u.alias("k")).agg(F.least(F.min("v"), F.min("u")).alias("m"))
        large = both.where(v > u).join(least, u == F.col("k")).select(v.alias("u"), F.col("m").alias("v")).distinct()
        # Small star: smaller neighbours and the node itself move to the smallest.
        least = large.groupBy(u.alias("k")).agg(F.min("v").alias("m"))
        met = large.join(least, u == F.col("k"))
        small = met.where(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v")))
        stars = stored(small.distinct(), "links")
        state = tuple(stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if state == seen:
            break
        seen = state
    return stars.select(u.alias("node"), v.alias("component")).unionByName(stars.select(v.alias("node"), v.alias("component")).distinct())
