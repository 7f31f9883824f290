"""The wide (match, team) relation that every season rollup reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import STAT_TYPE
from ..operators.pivot import name_columns, with_columns_present
from ..operators.sides import side_union
from .silver import match_stats

# The statistics that the season rollups use, by theme.
ATTACK_METRICS = [
    "expectedGoals", "bigChanceCreated", "bigChanceMissed", "bigChanceScored", "shotsOnGoal",
    "shotsOffGoal", "blockedScoringAttempt", "totalShotsInsideBox", "totalShotsOutsideBox",
    "hitWoodwork", "cornerKicks", "dribblesPercentage", "touchesInOppBox",
]
DEFENSE_METRICS = [
    "goalkeeperSaves", "totalTackle", "wonTacklePercent", "interceptionWon", "totalClearance",
    "blockedScoringAttempt", "ballRecovery", "aerialDuelsPercentage", "groundDuelsPercentage",
    "duelWonPercent", "errorsLeadToGoal", "errorsLeadToShot", "expectedGoals",
]
POSSESSION_METRICS = [
    "ballPossession", "accuratePasses", "passes", "accurateLongBalls", "accurateCross",
    "finalThirdEntries", "touchesInOppBox", "dispossessed", "throwIns", "goalKicks",
]
DISCIPLINE_METRICS = ["yellowCards", "redCards", "fouls", "offsides", "freeKicks"]
SCORER_METRICS = ["expectedGoals", "shotsOnGoal", "ballPossession"]
XG_METRICS = ["expectedGoals"]
ALL_METRICS = list(
    dict.fromkeys(ATTACK_METRICS + DEFENSE_METRICS + POSSESSION_METRICS + DISCIPLINE_METRICS)
)
XG = "stat_expectedgoals"
XG_AGAINST = "xg_against"

_KEEP = [
    "match_id", "match_date", "start_timestamp", "season_id", "season_name", "season_year",
    "winner_code",
]


def _side(own: str, other: str, win: int, loss: int) -> dict[str, object]:
    return {
        "team_id": f"{own}_team_id",
        "team_name": f"{own}_team_name",
        "opponent_id": f"{other}_team_id",
        "goals_for": f"{own}_score",
        "goals_against": f"{other}_score",
        "first_half_for": f"{own}_score_period1",
        "first_half_against": f"{other}_score_period1",
        "own_code": F.lit(win),
        "other_code": F.lit(loss),
    }


def team_sides(fact_match: DataFrame) -> DataFrame:
    """One row per finished match and side, without statistics."""
    played = fact_match.where(F.col("status_type") == "finished")
    return side_union(played, _KEEP, _side("home", "away", 1, 2), _side("away", "home", 2, 1))


def appearances(fact_match: DataFrame, values: DataFrame, metrics: Sequence[str] = ALL_METRICS) -> DataFrame:
    """Sides with their full-match statistics and the opponent's xG.

    ``values`` is the long silver table.  Statistics are pivoted per match, joined once on the match id, and only then
    split into sides: the opponent's value is already in the row, and the join
    moves one row per match.  A match without statistics keeps NULLs.
    """
    columns = name_columns(metrics)
    wide = match_stats(values, columns, period="ALL", listed_only=True)
    played = fact_match.where(F.col("status_type") == "finished").join(wide, "match_id", "left")

    def side(own: str, other: str, win: int, loss: int) -> dict[str, object]:
        cols = _side(own, other, win, loss) | {name: f"{own}_{name}" for _, name in columns}
        if XG in cols:
            cols[XG_AGAINST] = f"{other}_{XG}"
        return cols

    return side_union(played, _KEEP, side("home", "away", 1, 2), side("away", "home", 2, 1))


def appearances_from_facts(fact_match: DataFrame, fact_team_match: DataFrame, metrics: Sequence[str] = ALL_METRICS) -> DataFrame:
    """The same relation from the (match, team, period) fact.

    The opponent is known from the match row, so its xG comes through an equi
    join on (match, opponent) rather than a self join with an inequality.
    """
    names = [name for _, name in name_columns(metrics)]
    whole = with_columns_present(fact_team_match.where(F.col("period") == "ALL"), names, STAT_TYPE)
    out = team_sides(fact_match).join(whole.select("match_id", "team_id", *names), ["match_id", "team_id"], "left")
    if XG in names:
        against = whole.select("match_id", F.col("team_id").alias("opponent_id"), F.col(XG).alias(XG_AGAINST))
        out = out.join(against, ["match_id", "opponent_id"], "left")
    return out


def summed(long: DataFrame) -> DataFrame:
    """Sum, rows other than 0 and rows of each (team, season, metric) of (team_id, season_id, metric, value) rows.

    All three are linear, so a stored state of them takes signed changes.  Partial
    aggregation leaves one row per (team, season, metric) and task.
    """
    value = F.col("value")
    return long.where(value.isNotNull()).groupBy("team_id", "season_id", "metric").agg(
        F.sum(value).alias("total"), F.count_if(value != 0).alias("nonzero"), F.count(F.lit(1)).alias("n")
    )


def totals_of(sums: DataFrame) -> DataFrame:
    """One map of totals per team and season; it holds at most the listed metrics."""
    entry = F.struct("metric", F.struct("total", "nonzero"))
    return sums.groupBy("team_id", "season_id").agg(F.map_from_entries(F.collect_list(entry)).alias("totals"))


def _totals(long: DataFrame) -> DataFrame:
    return totals_of(summed(long))


def season_totals(fact_match: DataFrame, values: DataFrame, metrics: Sequence[str] = ALL_METRICS) -> DataFrame:
    """Season totals of full-match statistics straight from the long silver table."""
    return _totals(season_entries(fact_match, values, metrics))


def season_entries(fact_match: DataFrame, values: DataFrame, metrics: Sequence[str] = ALL_METRICS) -> DataFrame:
    """What each match adds to the totals of its teams, as (season_id, team_id, metric, value) rows.

    Sums, zero-filled means and means of non-zero values are all linear, so no
    per-match pivot is needed: a metric that appears in several groups is made
    unique per match, joined to its match, split into sides and summed.
    """
    whole = values.where((F.col("period") == "ALL") & F.col("metric").isin(list(metrics)))
    once = whole.groupBy("match_id", "metric").agg(
        F.max("home_value").alias("home_value"), F.max("away_value").alias("away_value")
    )
    played = fact_match.where(F.col("status_type") == "finished").select(
        "match_id", "season_id", "home_team_id", "away_team_id"
    )

    def entry(team: str, metric: Column, value: str) -> Column:
        return F.struct(F.col(team).alias("team_id"), metric.alias("metric"), F.col(value).alias("value"))

    metric, against = F.col("metric"), F.lit(XG_AGAINST)
    is_xg = metric == "expectedGoals"
    entries = F.array(
        entry("home_team_id", metric, "home_value"),
        entry("away_team_id", metric, "away_value"),
        F.when(is_xg, entry("home_team_id", against, "away_value")),
        F.when(is_xg, entry("away_team_id", against, "home_value")),
    )
    return once.join(played, "match_id").select("season_id", F.inline(F.array_compact(entries)))


def season_totals_from_facts(
    fact_match: DataFrame, fact_team_match: DataFrame, metrics: Sequence[str] = ALL_METRICS
) -> DataFrame:
    """The same totals from the (match, team, period) fact."""
    sides = appearances_from_facts(fact_match, fact_team_match, metrics)
    cells = {raw: name for raw, name in name_columns(metrics)}
    if XG_AGAINST in sides.columns:
        cells[XG_AGAINST] = XG_AGAINST
    entries = F.array(
        *[F.struct(F.lit(raw).alias("metric"), F.col(name).alias("value")) for raw, name in cells.items()]
    )
    return _totals(sides.select("team_id", "season_id", F.inline(entries)))
