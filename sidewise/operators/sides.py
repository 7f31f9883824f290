"""From one row per event to one row per (event, side), and pairs of sides."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import as_col

HOME, AWAY = "HOME", "AWAY"


def side_union(
    df: DataFrame,
    keep: Sequence[str],
    home: Mapping[str, Column | str],
    away: Mapping[str, Column | str],
    tag: str = "location",
) -> DataFrame:
    """Unpivot the two sides in a single pass over ``df``.

    ``home`` and ``away`` map the same output names to the column of that side.
    The pair of structs is exploded in place: no second scan and no shuffle.
    """
    if list(home) != list(away):
        raise ValueError("home and away must describe the same output columns")

    def one(label: str, cols: Mapping[str, Column | str]) -> Column:
        return F.struct(F.lit(label).alias(tag), *[as_col(c).alias(name) for name, c in cols.items()])

    both = F.explode(F.array(one(HOME, home), one(AWAY, away))).alias("side")
    return df.select(*keep, both).select(*keep, "side.*")


def unordered_pair(df: DataFrame, a: str, b: str, first: str, second: str) -> DataFrame:
    """Add the smaller and the larger of two ids, so (a, b) and (b, a) meet."""
    return df.withColumns({first: F.least(a, b), second: F.greatest(a, b)})
