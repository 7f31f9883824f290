"""Bronze models: typed match rows and the long statistics table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.documents import (
    compare_sides, explode_counted_stats, flatten_match_json, stat_document_kinds,
)
from ..operators.joins import missing_from
from ..operators.loads import hwm_filter

STATS_KEY = ["match_id", "period", "group_name", "statistic_key"]


def full_matches_data(raw_matches: DataFrame, loaded: DataFrame | None = None, mode: str = "hwm", strict: bool = True) -> DataFrame:
    """New typed matches of a load.

    Without ``loaded`` everything is flattened.  ``mode="hwm"`` takes matches that
    start after the newest loaded one, ``mode="anti"`` those with an unknown id.
    """
    rows = flatten_match_json(raw_matches, strict=strict)
    if loaded is None:
        return rows
    return hwm_filter(rows, loaded, "start_timestamp", mode, ["match_id"])


def full_matches_kinds(raw_matches: DataFrame, strict: bool = True) -> list[DataFrame]:
    """The rows of ``full_matches_data`` from documents whose id is the match_id of the raw row, and from the others.

    The first kind takes the id from the raw row, so typed rows stay in its buckets and are not moved.
    """
    rows = flatten_match_json(raw_matches.withColumn("_filed", F.col("match_id")), strict=strict, keep=["_filed"])
    agrees = F.col("match_id").eqNullSafe(F.col("_filed"))
    columns = [c for c in rows.columns if c != "_filed"]
    filed = F.col("_filed").cast(rows.schema["match_id"].dataType).alias("match_id")
    own = rows.where(agrees).select(*[filed if c == "match_id" else c for c in columns])
    return [own, rows.where(~agrees).select(*columns)]


def season_of_match(matches: DataFrame) -> DataFrame:
    return matches.groupBy("match_id").agg(F.min("season_id").alias("season_id"))


def full_stats_data(
    raw_stats: DataFrame,
    matches: DataFrame,
    loaded: DataFrame | None = None,
    strict: bool = True,
) -> DataFrame:
    """One row per (match, period, group, statistic) with comparisons and counts.

    Order and counts come from inside the document, so exploded rows are neither
    written in between nor shuffled; with documents and matches stored by buckets
    of match_id nothing is.  The document text is not carried along: exploded rows
    would repeat it a hundred times; ``match_id`` leads back to the raw row.
    """
    return reduce(DataFrame.unionByName, full_stats_kinds(raw_stats, matches, loaded, strict))


def full_stats_kinds(raw_stats: DataFrame, matches: DataFrame, loaded: DataFrame | None = None, strict: bool = True) -> list[DataFrame]:
    """The rows of ``full_stats_data`` from matches with one document and from those with several; each keeps its buckets."""
    return [compare_sides(rows) for rows in counted_stats_kinds(raw_stats, matches, loaded, strict)]


def counted_stats_kinds(raw_stats: DataFrame, matches: DataFrame, loaded: DataFrame | None = None, strict: bool = True) -> list[DataFrame]:
    """The same rows before the comparison of the sides, which takes nothing but the row itself."""
    docs = raw_stats if loaded is None else missing_from(raw_stats, loaded, ["match_id"])
    # The season joins the documents, a hundred times fewer than their items.
    keep = ["match_id", "tournament_id", "season_id"]
    kinds = stat_document_kinds(docs, carried=["tournament_id"], beside=season_of_match(matches))
    return [explode_counted_stats(documents, keep, strict) for documents in kinds]
