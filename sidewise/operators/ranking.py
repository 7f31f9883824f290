"""Top-N, newest-wins and full numbering inside groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def last_n(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group in ``order_by``, with their rank.

    The rank filter sits directly on the window, so Spark adds a group limit
    before the exchange: each map task ships at most ``n`` rows per group, and a
    group that holds most of the input never lands whole in one task.
    """
    ranked = df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order_by)))
    return ranked.where(F.col(rank) <= n)


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order_by``."""
    return last_n(df, keys, order_by, 1, "_newest").drop("_newest")


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    block: Column,
    tie_break: Sequence[str] = (),
    rank: str = "position",
    size: str | None = None,
) -> DataFrame:
    """Full row numbering (and group size) that splits large groups.

    ``block`` must grow with ``order_by`` (a string prefix, a day of a
    timestamp).  Rows are counted per (group, block); the counts before a block
    are its offset; numbering then runs inside (group, block), so a hot group is
    spread over as many tasks as it has blocks.
    """
    blocked = df.withColumn("_block", block)
    per_block = blocked.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_rows"))
    group = W.partitionBy(*keys)
    before = group.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_block.select(
        *keys,
        "_block",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(group).alias("_size"),
    )
    on = [blocked[k].eqNullSafe(offsets[k]) for k in (*keys, "_block")]
    joined = blocked.join(offsets, on, "inner").select(blocked["*"], "_offset", "_size")
    inside = W.partitionBy(*keys, "_block").orderBy(order_by, *tie_break)
    out = joined.withColumn(rank, F.row_number().over(inside) + F.col("_offset"))
    if size:
        out = out.withColumn(size, F.col("_size"))
    return out.drop("_block", "_offset", "_size")
