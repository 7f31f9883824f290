"""Closed-form outcome scorer on venue features and recent form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import flag, zero
from ..operators.filters import recent_window
from ..operators.sides import AWAY, HOME, side_union
from .gold import STANDARD_CODES, TEAM_SEASON

# Weights, form steps and limits of the scoring formula.
WEIGHTS = {"win_rate": 0.35, "xg": 0.30, "shots": 0.15, "possession": 0.10, "recent_goals": 0.10}
DRAW_WEIGHTS = {"draw_rate": 0.50, "xg_gap": 0.25, "form_gap": 0.25}
FORM_STEPS = [(12, 1.2), (9, 1.1), (6, 1.0), (3, 0.9)]
FORM_FLOOR = 0.8
FORM_SPAN = 0.4
UNKNOWN_RATE = 0.33
OUTLOOK_GAP = 0.15
SMALLEST_PRICED = 0.01
LONGEST_ODDS = 99.99


def rounded(c: Column, digits: int) -> Column:
    """Half-up rounding of a double, after dropping representation noise below 1e-10."""
    return F.round(c.cast("decimal(38,10)"), digits)


def _avg(c: Column, among: Column) -> Column:
    """Mean as double from an exact sum."""
    total = F.sum(F.when(among, c)).cast("double")
    return total / F.nullif(F.count(F.when(among, c)).cast("double"), F.lit(0.0))


def venue_features(sides: DataFrame, codes: dict[str, int] = STANDARD_CODES) -> DataFrame:
    """Per (team, season): averages and win/draw rates at home and away, in one aggregation."""
    code = F.col("winner_code")
    aggs = []
    for venue in (HOME, AWAY):
        name, here = venue.lower(), F.col("location") == venue
        win = code == codes[name]
        measures = {
            "goals_scored": F.col("goals_for"),
            "goals_conceded": F.col("goals_against"),
            "xg": zero("stat_expectedgoals"),
            "shots": zero("stat_shotsongoal"),
            "possession": zero("stat_ballpossession"),
            "win_rate": flag(win),
            "draw_rate": flag(code == codes["draw"]),
        }
        aggs += [_avg(c, here).alias(f"{name}_{measure}") for measure, c in measures.items()]
    return sides.groupBy(*TEAM_SEASON).agg(*aggs)


def recent_matches(fact_match: DataFrame, as_of: str | Column, days: int = 90) -> DataFrame:
    """Finished matches of the last ``days``."""
    return recent_window(fact_match.where(F.col("status_type") == "finished"), "match_date", as_of, days)


def history_of(matches: DataFrame, fact_match: DataFrame) -> DataFrame:
    """The rows of ``fact_match`` that play a team of ``matches`` in the same season.

    Features of these teams and seasons need no other row, so the statistics and
    the windows of all other seasons are never touched.
    """
    teams = side_union(matches, ["season_id"], {"team_id": "home_team_id"}, {"team_id": "away_team_id"})
    wanted = teams.select("team_id", F.col("season_id").alias("_season")).distinct()
    plays = (F.col("team_id") == F.col("home_team_id")) | (F.col("team_id") == F.col("away_team_id"))
    return fact_match.join(wanted, (F.col("season_id") == F.col("_season")) & plays, "left_semi")


# Feature of the scored match: output name without side, source in the two feature tables.
_VENUE = {
    "avg_goals_scored": "goals_scored", "avg_goals_conceded": "goals_conceded", "avg_xg": "xg",
    "avg_shots_on_target": "shots", "avg_possession": "possession", "win_rate": "win_rate",
}
_FORM = ["points_last_5", "wins_last_5", "goals_for_last_5", "goals_against_last_5"]


def with_features(matches: DataFrame, venue: DataFrame, form: DataFrame) -> DataFrame:
    """Attach home features of the home team and away features of the away team.

    Both feature tables have one row per (team, season) and are joined once per
    side; a match of a team without history gets zeros and ``UNKNOWN_RATE``.
    """
    per_team = venue.join(form.select(*TEAM_SEASON, *_FORM), TEAM_SEASON, "full")
    out = matches
    for side in ("home", "away"):
        columns = [F.col("team_id").alias(f"{side}_team_id"), "season_id"]
        for name, source in _VENUE.items():
            columns.append(F.col(f"{side}_{source}").alias(f"{side}_{name}_{side}"))
        columns.append(F.col(f"{side}_draw_rate").alias(f"{side}_draw_rate_{side}"))
        columns += [F.col(c).alias(f"{side}_{c}") for c in _FORM]
        out = out.join(per_team.select(*columns), [f"{side}_team_id", "season_id"], "left")
    for side in ("home", "away"):
        rates = {f"{side}_raw_{r}": F.coalesce(f"{side}_{r}_{side}", F.lit(UNKNOWN_RATE)) for r in ("win_rate", "draw_rate")}
        filled = [f"{side}_{name}_{side}" for name in _VENUE] + [f"{side}_{c}" for c in _FORM]
        out = out.withColumns(rates).fillna(0, subset=filled)
    return out


def form_multiplier(points: Column) -> Column:
    out = F.lit(FORM_FLOOR)
    for least, factor in reversed(FORM_STEPS):
        out = F.when(points >= least, factor).otherwise(out)
    return out


def score(features: DataFrame, integer_share: bool = True) -> DataFrame:
    """Predicted goals, normalised outcome probabilities, outlook and fair odds.

    ``integer_share`` divides recent goals as whole numbers, which leaves 0 or 1;
    pass False for the true share.
    """
    c = F.col
    xg_h, xg_a = c("home_avg_xg_home"), c("away_avg_xg_away")
    goals_h = (c("home_avg_goals_scored_home") * 0.5 + xg_h * 0.5 + c("away_avg_goals_conceded_away")) / 2
    goals_a = (c("away_avg_goals_scored_away") * 0.5 + xg_a * 0.5 + c("home_avg_goals_conceded_home")) / 2
    out = features.withColumns(
        {
            "predicted_home_goals": rounded(goals_h, 2),
            "predicted_away_goals": rounded(goals_a, 2),
            "predicted_total_xg": rounded((xg_h + xg_a) / 2, 2),
            "_form_home": form_multiplier(c("home_points_last_5")),
            "_form_away": form_multiplier(c("away_points_last_5")),
        }
    )
    recent = c("home_goals_for_last_5") + c("away_goals_for_last_5")

    def share(own: Column, total: Column) -> Column:
        return own / F.nullif(total, F.lit(0.0))

    def recent_share(own: Column) -> Column:
        if integer_share:
            # own never exceeds the total, so the whole-number quotient is 1 only at equality.
            return F.when(recent > 0, F.when(own == recent, 1.0).otherwise(0.0))
        return share(own.cast("double"), recent.cast("double"))

    def strength(side: str) -> Column:
        shots = c("home_avg_shots_on_target_home") + c("away_avg_shots_on_target_away")
        parts = (
            c(f"{side}_raw_win_rate") * WEIGHTS["win_rate"]
            + share(c(f"{side}_avg_xg_{side}"), xg_h + xg_a) * WEIGHTS["xg"]
            + share(c(f"{side}_avg_shots_on_target_{side}"), shots) * WEIGHTS["shots"]
            + c(f"{side}_avg_possession_{side}") / 100 * WEIGHTS["possession"]
            + recent_share(c(f"{side}_goals_for_last_5")) * WEIGHTS["recent_goals"]
        )
        return parts * c(f"_form_{side}")

    gap = F.abs(xg_h - xg_a) / F.nullif(F.greatest(xg_h, xg_a), F.lit(0.0))
    form_gap = F.abs(c("_form_home") - c("_form_away")) / FORM_SPAN
    draw = (
        (c("home_raw_draw_rate") + c("away_raw_draw_rate")) / 2 * DRAW_WEIGHTS["draw_rate"]
        + (1 - gap) * DRAW_WEIGHTS["xg_gap"]
        + (1 - form_gap) * DRAW_WEIGHTS["form_gap"]
    )
    out = out.withColumns({"_home": strength("home"), "_away": strength("away"), "_draw": draw})
    total = F.nullif(c("_home") + c("_away") + c("_draw"), F.lit(0.0))
    out = out.withColumns({f"p_{o}": c(f"_{o}") / total for o in ("home", "draw", "away")})

    outlook = (
        F.when(c("p_home") > c("p_away") + OUTLOOK_GAP, "HOME_FAVORITE")
        .when(c("p_away") > c("p_home") + OUTLOOK_GAP, "AWAY_FAVORITE")
        .otherwise("BALANCED")
    )
    columns = {"match_outlook": outlook}
    for outcome, name in (("home", "home_win"), ("draw", "draw"), ("away", "away_win")):
        p = c(f"p_{outcome}")
        columns[f"{name}_probability"] = rounded(F.coalesce(p, F.lit(UNKNOWN_RATE)) * 100, 1)
        priced = rounded(1 / F.when(p > SMALLEST_PRICED, p), 2)
        columns[f"{name}_fair_odds"] = F.coalesce(priced, F.lit(LONGEST_ODDS).cast("decimal(38,2)"))
    return out.withColumns(columns)


IDENTITY = [
    "match_id", "match_date", "season_id", "season_name", "season_year", "home_team_id", "home_team_name",
    "away_team_id", "away_team_name", "tournament_name",
]
FEATURES = [
    f"{side}_{name}"
    for side in ("home", "away")
    for name in [f"{f}_{side}" for f in _VENUE] + _FORM
]
PREDICTION = ["predicted_home_goals", "predicted_away_goals", "predicted_total_xg", "match_outlook"] + [
    f"{o}_{k}" for k in ("probability", "fair_odds") for o in ("home_win", "draw", "away_win")
]


def mart_match_predictions(
    fact_match: DataFrame, venue: DataFrame, form: DataFrame, as_of: str | Column, days: int = 90,
    integer_share: bool = True,
) -> DataFrame:
    """Scored finished matches of the last ``days``, with the actual outcome.

    Season features include the scored match itself: the mart validates the
    formula, it does not forecast.  ``venue`` and ``form`` need only hold the
    teams and seasons of ``history_of(recent_matches(...), fact_match)``.
    """
    scored = score(with_features(recent_matches(fact_match, as_of, days), venue, form), integer_share)
    home, away = F.col("home_score"), F.col("away_score")
    p_home, p_draw, p_away = F.col("p_home"), F.col("p_draw"), F.col("p_away")
    actual = (
        F.when(home > away, "HOME_WIN").when(home < away, "AWAY_WIN").when(home == away, "DRAW").otherwise("UNKNOWN")
    )
    best = (
        F.when((p_home > p_draw) & (p_home > p_away), "HOME_WIN")
        .when((p_draw > p_home) & (p_draw > p_away), "DRAW")
        .when((p_away > p_home) & (p_away > p_draw), "AWAY_WIN")
    )
    return scored.select(
        *IDENTITY,
        *FEATURES,
        *PREDICTION,
        home.alias("actual_home_score"),
        away.alias("actual_away_score"),
        actual.alias("actual_result"),
        F.coalesce(best == actual, F.lit(False)).alias("prediction_correct"),
        F.abs(F.col("predicted_home_goals") - home).alias("home_goals_error"),
        F.abs(F.col("predicted_away_goals") - away).alias("away_goals_error"),
    )


def mart_upcoming_predictions(fixtures: DataFrame, venue: DataFrame, form: DataFrame, integer_share: bool = True) -> DataFrame:
    """Scored fixtures that have not started."""
    waiting = fixtures.where(F.col("status_type") == "notstarted").withColumn("match_date", F.col("start_timestamp"))
    return score(with_features(waiting, venue, form), integer_share).select(*IDENTITY, *PREDICTION)
