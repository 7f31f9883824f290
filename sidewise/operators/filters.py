"""Row filters and the argument checks that go with them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import epoch_date
from ..functions.measures import as_col, quotient

# Statuses and descriptions that keep an event out of a layer.
NOT_STAGED = ["postponed", "cancelled", "retired"]
NOT_PLAYED = ["Canceled", "Cancelled", "Postponed", "Abandoned"]
REMOVED = "Removed"
FINISHED_WORDS = ["finished", "ended", "played", "ft"]
EXCLUDED_STATUSES = ["postponed", "canceled", "cancelled", "abandoned", "interrupted", "suspended"]


def validate_params(tournament_id: int, season_id: int, max_pages: int) -> None:
    for label, value in (("tournament_id", tournament_id), ("season_id", season_id), ("max_pages", max_pages)):
        if value <= 0:
            raise ValueError(f"{label} must be positive, got {value}")


def param_problem(tournament: Column | str, season: Column | str, pages: Column | str) -> Column:
    """The rule of ``validate_params`` over a table of requests: the first problem of a row, or null."""
    out = F.lit(None).cast("string")
    for label, value in reversed((("tournament_id", as_col(tournament)), ("season_id", as_col(season)), ("max_pages", as_col(pages)))):
        text = F.coalesce(value.cast("string"), F.lit("nothing"))
        out = F.when(value > 0, out).otherwise(F.concat(F.lit(f"{label} must be positive, got "), text))
    return out


def validate_cutoff(text: str, today: date) -> date:
    try:
        cutoff = date.fromisoformat(text)
    except ValueError as error:
        raise ValueError(f"cutoff {text!r} is not a YYYY-MM-DD date") from error
    if cutoff > today:
        raise ValueError(f"cutoff {text} lies in the future")
    return cutoff


def filter_scope(df: DataFrame, tournament: Column | str, season: Column | str, key: str, tournament_id: int, season_id: int) -> DataFrame:
    """Only the configured tournament and season, and only identified records."""
    return df.where(
        (as_col(tournament) == tournament_id) & (as_col(season) == season_id) & F.col(key).isNotNull()
    )


def filter_date_range(df: DataFrame, seconds: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Inclusive range on the UTC date; with a bound given, undated rows go."""
    if not start and not end:
        return df
    day = epoch_date(seconds)
    keep = day.isNotNull()
    if start:
        keep = keep & (day >= F.lit(start).cast("date"))
    if end:
        keep = keep & (day <= F.lit(end).cast("date"))
    return df.where(keep)


def filter_newer_than(df: DataFrame, seconds: str, cutoff: str) -> DataFrame:
    return df.where(epoch_date(seconds) > F.lit(cutoff).cast("date"))


def after_partition(df: DataFrame, day: str, cutoff: str) -> DataFrame:
    """Partitions strictly after the cutoff; a value that is no date is skipped."""
    return df.where(F.col(day).try_cast("date") > F.lit(cutoff).cast("date"))


def page_stops(
    df: DataFrame, page: str, seconds: str, cutoff: str, threshold: float = 0.8
) -> DataFrame:
    """Per page: rows, rows on or before the cutoff, and whether the scan ends there."""
    old = F.count_if(epoch_date(seconds) <= F.lit(cutoff).cast("date"))
    counted = df.groupBy(page).agg(F.count(F.lit(1)).alias("page_rows"), old.alias("old_rows"))
    return counted.withColumn(
        "stops", quotient(F.col("old_rows"), F.col("page_rows")) > F.lit(threshold)
    )


def scan_cutoff_page(
    df: DataFrame,
    page: str,
    seconds: str,
    cutoff: str,
    threshold: float = 0.8,
    max_pages: int | None = None,
) -> DataFrame:
    """New rows of the pages a newest-first scan would visit.

    Pages are numbered from 0.  The scan ends after the first page with mostly
    old rows or before the first page without rows; ``max_pages`` may end it
    earlier.  One count per page decides.
    """
    scanned = df.where(F.col(page) >= 0)
    if max_pages is not None:
        scanned = scanned.where(F.col(page) < max_pages)
    stops = page_stops(scanned, page, seconds, cutoff, threshold)
    stop = stops.where("stops").agg(F.min(page).alias("stop_page"))
    # The first page without rows is page 0 or follows one with rows.
    following = stops.select((F.col(page) + 1).alias("next_page"))
    following = following.unionByName(df.sparkSession.range(1).select(F.col("id").cast(following.schema[0].dataType).alias("next_page")))
    gap = following.join(stops, F.col("next_page") == F.col(page), "left_anti").agg(F.min("next_page").alias("gap"))
    last = F.coalesce(stop.scalar(), F.col(page))
    return filter_newer_than(scanned.where((F.col(page) <= last) & (F.col(page) < gap.scalar())), seconds, cutoff)


def _usable(matches: DataFrame) -> DataFrame:
    return matches.where(~F.col("status_type").isin(NOT_STAGED))


def in_doubt(matches: DataFrame) -> DataFrame:
    """Usable events without a description or with that of a removed one: only their statistics keep them."""
    return _usable(matches).where(~F.coalesce(F.col("status_description") != REMOVED, F.lit(False)))


def stage_filter(matches: DataFrame, stats: DataFrame, key: str = "match_id") -> DataFrame:
    """Drop unusable statuses; a removed event stays only if it has statistics.

    An event without a description is treated like a removed one.  Only these
    few take part in the existence test, against the distinct ids of the
    statistics, and all other rows pass without a join.
    """
    described = _usable(matches).where(F.col("status_description") != REMOVED)
    # Distinct first: the rows of an id lie together, so a task moves and joins one of them.
    return described.unionByName(in_doubt(matches).join(stats.select(key).distinct(), key, "left_semi"))


def finished_filter(df: DataFrame) -> DataFrame:
    return df.where(
        (F.col("status_type") == "finished") & ~F.col("status_description").isin(NOT_PLAYED)
    )


def require_non_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(columns))


def recent_window(df: DataFrame, day: str, as_of: str | Column, days: int = 90) -> DataFrame:
    anchor = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    return df.where(F.col(day) >= F.date_sub(anchor, days))


def ingested_on(df: DataFrame, ts: str, as_of: str) -> DataFrame:
    return df.where(F.to_date(ts) == F.lit(as_of).cast("date"))
