"""Silver models: staging, dimensions and facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import fill_second_half, metric_key, normalize_period, period_label
from ..functions.keys import surrogate_key
from ..functions.measures import STAT_TYPE
from ..operators.filters import finished_filter, stage_filter
from ..operators.loads import hwm_filter, insert_if_absent
from ..operators.pivot import agg_pivot, pivot_listed
from ..operators.sides import side_union
from ..session import write_bucketed

# Columns of the two staging tables.
STAGING_MATCH_COLUMNS = [
    "match_id", "match_slug", "start_timestamp", "status_type", "status_description",
    "winner_code", "home_score_current", "away_score_current",
    "home_score_period1", "home_score_period2", "away_score_period1", "away_score_period2",
    "home_team_id", "home_team_name", "away_team_id", "away_team_name",
    "tournament_id", "tournament_name", "season_id", "season_name", "season_year",
    "country_name", "injury_time_2", "current_period_start_timestamp",
]
STAGING_STAT_COLUMNS = [
    "match_id", "period", "group_name", "statistic_key", "statistic_name",
    "tournament_id", "season_id", "statistics_type", "value_type",
    "home_value_text", "away_value_text", "home_value_numeric", "away_value_numeric",
    "advantage", "home_percentage", "away_percentage", "value_difference",
    "stat_order_in_group", "stats_count_in_group", "total_statistics_count",
    "periods_count", "groups_count", "statistics_in_period",
]


def staging_matches(matches: DataFrame, stats: DataFrame) -> DataFrame:
    return stage_filter(matches, stats).select(*STAGING_MATCH_COLUMNS)


def staging_stats(stats: DataFrame, staged: DataFrame) -> DataFrame:
    """Statistics of staged matches only; all columns must be there."""
    kept = stats.join(staged.select("match_id"), "match_id", "left_semi")
    return kept.select(*STAGING_STAT_COLUMNS)


def stage_incremental(staged: DataFrame, matches: DataFrame, stats: DataFrame, mode: str = "hwm") -> DataFrame:
    """Staging after adding the new matches; a key that is already there stays."""
    fresh = hwm_filter(staging_matches(matches, stats), staged, "start_timestamp", mode, ["match_id"], "1900-01-01")
    return insert_if_absent(staged, fresh.select(*staged.columns), ["match_id"], [F.asc("start_timestamp"), F.xxhash64(*staged.columns)])


def dim_date(staged: DataFrame, padded: bool = False) -> DataFrame:
    """One row per day from the first match to a year after the last.

    ``padded`` gives day and month names the blank padding of a fixed-width field.
    """
    day = F.to_date("start_timestamp")
    span = staged.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    days = span.select(F.explode(F.sequence("first", F.add_months("last", 12))).alias("date_day"))
    d = F.col("date_day")
    weekday = F.dayofweek(d) - 1

    def name(pattern: str):
        text = F.date_format(d, pattern)
        return F.rpad(text, 9, " ") if padded else text

    return days.select(
        "date_day",
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"),
        weekday.alias("day_of_week"),
        name("EEEE").alias("day_name"),
        name("MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        weekday.isin(0, 6).alias("is_weekend"),
    )


def dim_period(stats: DataFrame) -> DataFrame:
    codes = stats.where(F.col("period").isNotNull()).select(F.col("period").alias("period_code")).distinct()
    return codes.withColumn("period_name", period_label("period_code"))


def _distinct(df: DataFrame, key: str, *columns: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).select(key, *columns).distinct()


def dim_seasons(staged: DataFrame) -> DataFrame:
    return _distinct(staged, "season_id", "season_name", "season_year")


def dim_tournaments(staged: DataFrame) -> DataFrame:
    return _distinct(staged, "tournament_id", "tournament_name", "country_name")


def dim_stat_types(stats: DataFrame) -> DataFrame:
    return _distinct(stats, "statistic_key", "statistic_name", "group_name", "statistics_type", "value_type")


def dim_teams(staged: DataFrame) -> DataFrame:
    sides = side_union(
        staged,
        [],
        {"team_id": "home_team_id", "team_name": "home_team_name"},
        {"team_id": "away_team_id", "team_name": "away_team_name"},
    )
    return _distinct(sides, "team_id", "team_name")


def fact_match(staged: DataFrame) -> DataFrame:
    """Finished matches with the second half filled in."""

    def second(side: str):
        return fill_second_half(
            f"{side}_score_current", f"{side}_score_period1", f"{side}_score_period2"
        ).alias(f"{side}_score_period2")

    return finished_filter(staged).select(
        "match_id",
        "match_slug",
        F.to_date("start_timestamp").alias("match_date"),
        "start_timestamp",
        "status_type",
        "status_description",
        "winner_code",
        F.col("home_score_current").alias("home_score"),
        F.col("away_score_current").alias("away_score"),
        "home_score_period1",
        second("home"),
        "away_score_period1",
        second("away"),
        "home_team_id",
        "home_team_name",
        "away_team_id",
        "away_team_name",
        "tournament_id",
        "tournament_name",
        "season_id",
        "season_name",
        "season_year",
        "country_name",
        # Always 1: only finished matches are left.  See with_stats_present.
        F.lit(1).alias("has_statistics"),
    )


def with_stats_present(facts: DataFrame, stats: DataFrame) -> DataFrame:
    """Add ``stats_present``: whether the match really has statistics."""
    ids = stats.select("match_id").distinct().withColumn("_found", F.lit(True))
    joined = facts.join(ids, "match_id", "left")
    return joined.select(facts["*"], F.coalesce("_found", F.lit(False)).alias("stats_present"))


def side_values(stats: DataFrame) -> DataFrame:
    """The long silver table: per statistic its key, normal period and one value per side.

    Percentage statistics use the computed share of the side where there is one.
    Facts and season totals read it as a stored table, so that their filters on
    period and metric are on plain columns and reach the scan.
    """
    is_share = F.col("value_type").ilike("%percent%")

    def value(side: str):
        raw = F.col(f"{side}_value_numeric")
        share = F.when(is_share, F.col(f"{side}_percentage"))
        return F.coalesce(share, raw).cast(STAT_TYPE).alias(f"{side}_value")

    return stats.select(
        "match_id",
        normalize_period("period").alias("period"),
        metric_key("statistic_key", "statistic_name").alias("metric"),
        value("home"),
        value("away"),
    )


def write_side_values(stats: DataFrame, path: str, buckets: int | None = None, more: Sequence[DataFrame] = ()) -> str:
    """Store the long silver table, a folder per period, in buckets of match_id whose rows are ordered by metric.

    Of statistics in the same buckets nothing is shuffled, here or in the pivots and joins by
    match that read the table; a large period is spread over the buckets.  The rows of ``more`` follow
    those of ``stats``.  Returns the table's name.
    """
    return write_bucketed(side_values(stats), path, "match_id", buckets, "metric", ["period"], [side_values(part) for part in more])


def match_stats(
    values: DataFrame, columns: Sequence[tuple[str, str]], period: str | None = None, listed_only: bool = False
) -> DataFrame:
    """Statistics pivoted at match grain, ``home_*`` and ``away_*`` columns side by side.

    ``values`` is the long silver table.  ``listed_only`` reads just the listed
    metrics, so a match that has none of them gives no row; use it where the
    result is left-joined.
    """
    keys = ["match_id", "period"]
    if period is not None:
        values, keys = values.where(F.col("period") == period), ["match_id"]
    if listed_only:
        values = values.where(F.col("metric").isin([raw for raw, _ in columns]))
    return agg_pivot(values, keys, "metric", {"home_": "home_value", "away_": "away_value"}, columns)


def fact_team_match(values: DataFrame, staged: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per (match, team, period), one column per metric of the long silver table.

    The long table, in buckets of match_id, is aggregated at match grain first, so nothing of it is
    shuffled and half as many rows are joined as when the sides are split before the pivot.
    """
    teams = staged.select("match_id", "home_team_id", "home_team_name", "away_team_id", "away_team_name")
    raw_keys = [raw for raw, _ in columns]
    slots = pivot_listed(values, ["match_id", "period"], "metric", ["home_value", "away_value"], raw_keys, dealt=True)
    place = {raw: n for n, raw in enumerate(sorted(set(raw_keys)))}

    def side(label: str) -> dict[str, str]:
        return {"team_id": f"{label}_team_id", "team_name": f"{label}_team_name", "values": f"{label}_value"}

    rows = side_union(slots.join(teams.hint("shuffle_hash"), "match_id"), ["match_id", "period"], side("home"), side("away"))
    return rows.select(
        surrogate_key("match_id", "team_id", "period").alias("match_team_period_key"),
        "match_id", "team_id", "team_name", "period",
        *[F.get("values", F.lit(place[raw])).alias(name) for raw, name in columns],
    )


def fact_season_team(values: DataFrame, staged: DataFrame) -> DataFrame:
    """Season totals over matches that have full-match statistics; points by score.

    ``values`` is the long silver table, of which only the ids of the folder of
    period ALL are read.  ``season_team_key`` ignores the tournament, as its consumers expect;
    ``season_team_stage_key`` is unique for seasons played in several stages.
    """
    counted = values.where(F.col("period") == "ALL").select("match_id").distinct()
    whole = staged.join(counted, "match_id", "left_semi")

    def side(own: str, other: str) -> dict[str, str]:
        return {
            "team_id": f"{own}_team_id", "team_name": f"{own}_team_name",
            "gf": f"{own}_score_current", "ga": f"{other}_score_current",
        }

    scored = side_union(
        whole, ["season_id", "season_name", "season_year", "tournament_id"], side("home", "away"), side("away", "home")
    )
    points = F.when(F.col("gf") > F.col("ga"), 3).when(F.col("gf") == F.col("ga"), 1).otherwise(0)
    keys = ["season_id", "season_name", "season_year", "tournament_id", "team_id", "team_name"]
    totals = scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("matches_played"),
        F.sum("gf").alias("goals_for"),
        F.sum("ga").alias("goals_against"),
        F.sum(points).alias("points"),
    )
    return totals.select(
        surrogate_key("season_id", "team_id").alias("season_team_key"),
        surrogate_key("season_id", "tournament_id", "team_id").alias("season_team_stage_key"),
        *totals.columns,
    )


UPCOMING_REQUIRED = [
    "match_id", "start_timestamp", "home_team_id", "home_team_name", "away_team_id", "away_team_name",
    "tournament_id", "tournament_name", "season_id", "season_name",
]
