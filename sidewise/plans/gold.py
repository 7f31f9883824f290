"""Season marts: one row per (team, season), per pair of teams, or per season.

Team marts combine one aggregation over the sides of the matches with the season
totals of the long statistics.  Rows are grouped on the ids alone and the names
ride along as ``max``: a renamed team stays one row.  ``matches_played`` counts
rows, which are unique per (match, team).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import (
    SUM_TYPE, flag, mean, mean_filled, over_rates, percent, quotient, rate, zero,
)
from ..operators.filters import require_non_null
from ..operators.ranking import dedupe_latest, last_n
from ..operators.sides import AWAY, HOME, unordered_pair
from .appearances import XG, XG_AGAINST, team_sides
from .silver import UPCOMING_REQUIRED

TEAM_SEASON = ["team_id", "season_id"]
IDENTITY = ["team_id", "team_name", "season_id", "season_name", "season_year"]

# Two readings of the winner code: points for (home win, away win, draw).
STANDARD_CODES = {"home": 1, "away": 2, "draw": 3}
ALTERNATE_CODES = {"home": 1, "away": 3, "draw": 2}


def _rows() -> Column:
    return F.count(F.lit(1))


def _names() -> list[Column]:
    return [F.max(c).alias(c) for c in ("team_name", "season_name", "season_year")]


def _rollup(sides: DataFrame, measures: dict[str, Column]) -> DataFrame:
    named = [column.alias(name) for name, column in measures.items()]
    out = sides.groupBy(*TEAM_SEASON).agg(*_names(), *named)
    return out.select(*IDENTITY, *[c for c in out.columns if c not in IDENTITY])


def _won() -> Column:
    return F.col("winner_code") == F.col("own_code")


def _lost() -> Column:
    return F.col("winner_code") == F.col("other_code")


def _drawn() -> Column:
    return F.col("winner_code") == STANDARD_CODES["draw"]


def _total(*metrics: str) -> Column:
    """Season total over one or more metrics; a missing metric counts as 0."""
    out = F.lit(0).cast(SUM_TYPE)
    for metric in metrics:
        out = out + F.coalesce(F.col("totals")[metric]["total"], F.lit(0).cast(SUM_TYPE))
    return out.cast(SUM_TYPE)


def _per_match(total: Column, digits: int = 2) -> Column:
    return F.round(quotient(total, F.col("matches_played")), digits)


def _per_game(metric: str, name: str, digits: int = 2) -> dict[str, Column]:
    return {f"total_{name}": _total(metric), f"{name}_per_game": _per_match(_total(metric), digits)}


def _nonzero_mean(metric: str) -> Column:
    cell = F.col("totals")[metric]
    return F.round(quotient(cell["total"], cell["nonzero"]), 1)


def played() -> dict[str, Column]:
    return {"matches_played": _rows()}


def overview_measures() -> dict[str, Column]:
    points = F.when(_won(), 3).when(_drawn(), 1).when(_lost(), 0)
    goals_for, goals_against = F.sum("goals_for"), F.sum("goals_against")
    clean = F.sum(flag(F.col("goals_against") == 0))
    return {
        "wins": F.sum(flag(_won())),
        "draws": F.sum(flag(_drawn())),
        "losses": F.sum(flag(_lost())),
        "total_points": F.sum(points),
        "points_per_game": F.round(quotient(F.sum(points), _rows()), 2),
        "goals_for": goals_for,
        "goals_against": goals_against,
        "goal_difference": goals_for - goals_against,
        "goals_per_game": F.round(quotient(goals_for, _rows()), 2),
        "goals_conceded_per_game": F.round(quotient(goals_against, _rows()), 2),
        "clean_sheets": clean,
        "clean_sheet_percentage": percent(clean, _rows()),
    }


def scored_measures() -> dict[str, Column]:
    return {"total_goals": F.sum("goals_for"), "goals_per_game": mean("goals_for", 2)}


def conceded_measures() -> dict[str, Column]:
    clean = F.sum(flag(F.col("goals_against") == 0))
    return {
        "total_goals_conceded": F.sum("goals_against"),
        "goals_conceded_per_game": mean("goals_against", 2),
        "clean_sheets": clean,
        "clean_sheet_pct": percent(clean, _rows()),
        "_mean_conceded": mean("goals_against"),
    }


def attack_measures() -> dict[str, Column]:
    xg = _total("expectedGoals")
    gap = F.col("total_goals").cast(SUM_TYPE) - xg
    shots = _total("shotsOnGoal", "shotsOffGoal", "blockedScoringAttempt")
    return {
        "total_xg": xg,
        "xg_per_game": _per_match(xg),
        "xg_difference": F.round(gap, 2),
        "xg_diff_per_game": _per_match(gap),
        **_per_game("bigChanceCreated", "big_chances_created"),
        **_per_game("bigChanceMissed", "big_chances_missed"),
        **_per_game("bigChanceScored", "big_chances_scored"),
        **_per_game("shotsOnGoal", "shots_on_target"),
        **_per_game("shotsOffGoal", "shots_off_target"),
        **_per_game("blockedScoringAttempt", "blocked_shots"),
        "total_shots": shots,
        "shots_per_game": _per_match(shots),
        **_per_game("totalShotsInsideBox", "shots_inside_box"),
        **_per_game("totalShotsOutsideBox", "shots_outside_box"),
        "total_hit_woodwork": _total("hitWoodwork"),
        **_per_game("cornerKicks", "corners"),
        "avg_dribbles_success_pct": _nonzero_mean("dribblesPercentage"),
        **_per_game("touchesInOppBox", "touches_in_box"),
    }


def defense_measures() -> dict[str, Column]:
    """``blocked_shots`` are the team's own blocked attempts, as in the attack mart."""
    xga = _total(XG_AGAINST)
    mean_xga = quotient(xga, F.col("matches_played"))
    return {
        "total_xga": xga,
        "xga_per_game": _per_match(xga),
        "xga_difference": F.round(F.col("total_goals_conceded").cast(SUM_TYPE) - xga, 2),
        "xga_difference_per_game": F.round(F.col("_mean_conceded") - mean_xga, 2),
        **_per_game("goalkeeperSaves", "saves"),
        **_per_game("totalTackle", "tackles"),
        "avg_tackles_won_pct": _nonzero_mean("wonTacklePercent"),
        **_per_game("interceptionWon", "interceptions"),
        **_per_game("totalClearance", "clearances"),
        **_per_game("blockedScoringAttempt", "blocked_shots"),
        **_per_game("ballRecovery", "ball_recoveries"),
        "avg_aerial_duels_pct": _nonzero_mean("aerialDuelsPercentage"),
        "avg_ground_duels_pct": _nonzero_mean("groundDuelsPercentage"),
        "avg_duels_won_pct": _nonzero_mean("duelWonPercent"),
        "total_errors_lead_to_goal": _total("errorsLeadToGoal"),
        "total_errors_lead_to_shot": _total("errorsLeadToShot"),
    }


def possession_measures() -> dict[str, Column]:
    return {
        "avg_possession_pct": _nonzero_mean("ballPossession"),
        **_per_game("accuratePasses", "accurate_passes", digits=1),
        "total_passes": _total("passes"),
        "total_passes_per_game": _per_match(_total("passes"), 1),
        "pass_accuracy_pct": percent(_total("accuratePasses"), _total("passes")),
        **_per_game("accurateLongBalls", "accurate_long_balls"),
        **_per_game("accurateCross", "accurate_crosses"),
        **_per_game("finalThirdEntries", "final_third_entries"),
        **_per_game("touchesInOppBox", "touches_in_box"),
        **_per_game("dispossessed", "dispossessed"),
        **_per_game("throwIns", "throw_ins"),
        **_per_game("goalKicks", "goal_kicks"),
    }


def discipline_measures() -> dict[str, Column]:
    return {
        **_per_game("yellowCards", "yellow_cards"),
        "total_red_cards": _total("redCards"),
        **_per_game("fouls", "fouls"),
        **_per_game("offsides", "offsides"),
        **_per_game("freeKicks", "free_kicks"),
    }


def _season_mart(
    fact_match: DataFrame, totals: DataFrame, goals: dict[str, Column], statistics: dict[str, Column]
) -> DataFrame:
    """Goal measures aggregated over sides, joined with the statistics totals.

    Both inputs of the join have one row per (team, season).
    """
    base = _rollup(team_sides(fact_match), played() | goals)
    out = base.join(totals, TEAM_SEASON, "left").withColumns(statistics)
    hidden = [c for c in out.columns if c.startswith("_")]
    return out.drop("totals", *hidden)


def mart_team_overview(sides: DataFrame) -> DataFrame:
    return _rollup(sides, played() | overview_measures())


def mart_team_attack(fact_match: DataFrame, totals: DataFrame) -> DataFrame:
    return _season_mart(fact_match, totals, scored_measures(), attack_measures())


def mart_team_defense(fact_match: DataFrame, totals: DataFrame) -> DataFrame:
    return _season_mart(fact_match, totals, conceded_measures(), defense_measures())


def mart_team_possession(fact_match: DataFrame, totals: DataFrame) -> DataFrame:
    return _season_mart(fact_match, totals, {}, possession_measures())


def mart_team_discipline(fact_match: DataFrame, totals: DataFrame) -> DataFrame:
    return _season_mart(fact_match, totals, {}, discipline_measures())


# --- recent form -----------------------------------------------------------

FORM_WINDOWS = (5, 10, 15, 20)
VENUE_WINDOW = 5


def _code_points(codes: dict[str, int]) -> Column:
    """3 for the side's own win code, 1 for the draw code, otherwise 0."""
    own = F.when(F.col("location") == HOME, codes["home"]).otherwise(codes["away"])
    return F.when(F.col("winner_code") == own, 3).when(F.col("winner_code") == codes["draw"], 1).otherwise(0)


def results(fact_match: DataFrame, codes: dict[str, int] = STANDARD_CODES) -> DataFrame:
    """Sides with result letter and points.

    Letters always follow the standard codes; only points follow ``codes``.
    """
    letter = F.when(_won(), "W").when(_lost(), "L").when(_drawn(), "D")
    return team_sides(fact_match).withColumns({"result": letter, "points": _code_points(codes)})


def mart_team_form(fact_match: DataFrame, codes: dict[str, int] = STANDARD_CODES) -> DataFrame:
    """Last 5/10/15/20 matches overall, last 5 at each venue, and season splits.

    Each side is ranked once overall and once per venue, as two scopes of one
    window with a group limit of 20; everything recent then comes from a single
    aggregation over at most 60 rows per team and season.
    """
    sides = results(fact_match, codes)
    scoped = sides.select(
        *IDENTITY, "match_id", "start_timestamp", "result", "points", "goals_for", "goals_against",
        F.explode(F.array(F.lit("ALL"), F.col("location"))).alias("scope"),
    )
    newest = [F.desc("start_timestamp"), F.desc("match_id")]
    recent = last_n(scoped, ["team_id", "season_id", "scope"], newest, max(FORM_WINDOWS))

    letters = F.array_sort(F.collect_list(F.struct("scope", "rank", "result")))

    def spell(scope: str, n: int) -> Column:
        entries = F.filter("letters", lambda e: (e["scope"] == scope) & (e["rank"] <= n))
        return F.array_join(F.transform(entries, lambda e: e["result"]), "")

    def among(scope: str, n: int, value: Column) -> Column:
        return F.sum(F.when((F.col("scope") == scope) & (F.col("rank") <= n), value))

    aggs = [letters.alias("letters")]
    for n in FORM_WINDOWS:
        aggs.append(among("ALL", n, F.col("points")).alias(f"points_last_{n}"))
        for word, letter in (("wins", "W"), ("draws", "D"), ("losses", "L")):
            aggs.append(among("ALL", n, flag(F.col("result") == letter)).alias(f"{word}_last_{n}"))
        aggs.append(among("ALL", n, F.col("goals_for")).alias(f"goals_for_last_{n}"))
        aggs.append(among("ALL", n, F.col("goals_against")).alias(f"goals_against_last_{n}"))
    for scope in (HOME, AWAY):
        points = F.coalesce(among(scope, VENUE_WINDOW, F.col("points")), F.lit(0))
        aggs.append(points.alias(f"points_last_5_{scope.lower()}"))
    form = recent.groupBy(*TEAM_SEASON).agg(*_names(), *aggs)

    text = {f"last_{n}_results": F.nullif(spell("ALL", n), F.lit("")) for n in FORM_WINDOWS}
    text |= {f"last_5_results_{s.lower()}": spell(s, VENUE_WINDOW) for s in (HOME, AWAY)}
    spelled = form.withColumns(text).drop("letters")
    out = spelled.join(season_splits(sides), TEAM_SEASON, "left")
    return out.select(*FORM_COLUMNS)


def season_splits(sides: DataFrame) -> DataFrame:
    """Results after leading at half time and after conceding at all.

    The second group is every match with a goal against, whoever scored first:
    the data hold no goal times.
    """
    led = F.col("first_half_for") > F.col("first_half_against")
    conceded = F.col("goals_against") > 0
    n_led, n_conceded = F.sum(flag(led)), F.sum(flag(conceded))
    led_won = F.sum(flag(led & (F.col("result") == "W")))
    points = F.sum(F.when(conceded, F.col("points")))

    def if_any(count: Column, value: Column) -> Column:
        return F.when(count > 0, value)

    return sides.groupBy(*TEAM_SEASON).agg(
        F.nullif(n_led, F.lit(0)).alias("halftime_leading_count"),
        if_any(n_led, led_won).alias("halftime_leading_wins"),
        if_any(n_led, F.sum(flag(led & (F.col("result") == "D")))).alias("halftime_leading_draws"),
        if_any(n_led, F.sum(flag(led & (F.col("result") == "L")))).alias("halftime_leading_losses"),
        percent(led_won, n_led).alias("halftime_leading_win_pct"),
        F.nullif(n_conceded, F.lit(0)).alias("conceded_first_count"),
        points.alias("points_after_conceding_first"),
        percent(points, n_conceded * 3).alias("points_pct_after_conceding_first"),
    )


def _window_columns(n: int) -> list[str]:
    return [
        f"last_{n}_results", f"points_last_{n}", f"wins_last_{n}", f"draws_last_{n}", f"losses_last_{n}",
        f"goals_for_last_{n}", f"goals_against_last_{n}",
    ]


SPLIT_COLUMNS = [
    "halftime_leading_count", "halftime_leading_wins", "halftime_leading_draws", "halftime_leading_losses",
    "halftime_leading_win_pct", "conceded_first_count", "points_after_conceding_first",
    "points_pct_after_conceding_first",
]
FORM_COLUMNS = (
    IDENTITY
    + _window_columns(5)
    + ["last_5_results_home", "points_last_5_home", "last_5_results_away", "points_last_5_away"]
    + [c for n in (10, 15, 20) for c in _window_columns(n)]
    + SPLIT_COLUMNS
)


# --- pairs -----------------------------------------------------------------


def mart_head_to_head(fact_match: DataFrame) -> DataFrame:
    """Record of every unordered pair of teams, with its five latest results."""
    finished = fact_match.where(F.col("status_type") == "finished")
    pairs = unordered_pair(finished, "home_team_id", "away_team_id", "team_id_1", "team_id_2")
    first_home = F.col("home_team_id") == F.col("team_id_1")
    code = F.col("winner_code")
    first_won = F.when(first_home, code == 1).otherwise(code == 2)
    second_won = F.when(first_home, code == 2).otherwise(code == 1)
    goals_1 = F.when(first_home, F.col("home_score")).otherwise(F.col("away_score"))
    goals_2 = F.when(first_home, F.col("away_score")).otherwise(F.col("home_score"))
    # A match without a winner code also reads as 2.
    letter = F.when(first_won, "1").when(code == 3, "X").otherwise("2")
    games = pairs.select(
        "team_id_1", "team_id_2", "match_id", "match_date", "winner_code",
        F.when(first_home, F.col("home_team_name")).otherwise(F.col("away_team_name")).alias("name_1"),
        F.when(first_home, F.col("away_team_name")).otherwise(F.col("home_team_name")).alias("name_2"),
        first_won.alias("first_won"), second_won.alias("second_won"),
        goals_1.alias("goals_1"), goals_2.alias("goals_2"), letter.alias("letter"),
    )
    keys = ["team_id_1", "team_id_2"]
    newest = [F.desc("match_date"), F.desc("match_id")]
    latest = last_n(games, keys, newest, 5).withColumn(
        "text", F.concat("letter", F.lit(" ("), "goals_1", F.lit("-"), "goals_2", F.lit(")"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("rank", "text")))
    joined = F.array_join(F.transform(ordered, lambda e: e["text"]), " | ")
    strings = latest.groupBy(*keys).agg(F.nullif(joined, F.lit("")).alias("last_5_results"))
    total = F.col("goals_1") + F.col("goals_2")
    record = games.groupBy(*keys).agg(
        F.max("name_1").alias("team_1_name"),
        F.max("name_2").alias("team_2_name"),
        _rows().alias("total_matches"),
        F.sum(flag(F.col("first_won"))).alias("team_1_wins"),
        F.sum(flag(code == 3)).alias("draws"),
        F.sum(flag(F.col("second_won"))).alias("team_2_wins"),
        F.sum("goals_1").alias("team_1_goals"),
        F.sum("goals_2").alias("team_2_goals"),
        mean("goals_1", 2).alias("team_1_avg_goals"),
        mean("goals_2", 2).alias("team_2_avg_goals"),
        rate(total > 1).alias("over_15_pct"),
        rate(total > 2).alias("over_25_pct"),
        rate(total > 3).alias("over_35_pct"),
        rate((F.col("goals_1") > 0) & (F.col("goals_2") > 0)).alias("btts_pct"),
        F.max("match_date").alias("last_meeting_date"),
    )
    return record.join(strings, keys, "left")


# --- both teams to score ---------------------------------------------------


def _scope_measures(prefix: str, among: Column | None) -> dict[str, Column]:
    """The block that exists overall and for each venue."""

    def within(c: Column | str) -> Column:
        value = F.col(c) if isinstance(c, str) else c
        return value if among is None else F.when(among, value)

    def share(predicate: Column) -> Column:
        return rate(predicate, 1, among)

    both = (F.col("goals_for") > 0) & (F.col("goals_against") > 0)
    return {
        f"{prefix}_win_pct": share(_won()),
        f"{prefix}_avg_goals_per_match": mean(within(F.col("goals_for") + F.col("goals_against")), 2),
        f"{prefix}_avg_scored": mean(within("goals_for"), 2),
        f"{prefix}_avg_conceded": mean(within("goals_against"), 2),
        f"{prefix}_btts_pct": share(both),
        f"{prefix}_clean_sheet_pct": share(F.col("goals_against") == 0),
        f"{prefix}_avg_xg": mean(within(zero(XG)), 2),
        f"{prefix}_avg_xga": mean(within(zero(XG_AGAINST)), 2),
    }


def mart_team_btts_analysis(sides: DataFrame) -> DataFrame:
    measures = played() | _scope_measures("overall", None) | over_rates("goals_against", "overall_conceded")
    for venue in (HOME, AWAY):
        name, at_venue = venue.lower(), F.col("location") == venue
        measures[f"{name}_matches_played"] = F.nullif(F.sum(flag(at_venue)), F.lit(0))
        measures |= _scope_measures(name, at_venue)
        measures |= over_rates("goals_for", f"{name}_scored", among=at_venue)
        blank = rate(F.col("goals_for") == 0, 1, at_venue)
        measures[f"{name}_failed_to_score_pct"] = F.coalesce(blank, F.lit(0))
        measures |= over_rates("goals_against", f"{name}_conceded", among=at_venue)
    return _rollup(sides, measures)


# --- season summary --------------------------------------------------------


def venue_measures() -> dict[str, Column]:
    """Record, scoring by half and conceding by half for each venue."""
    out: dict[str, Column] = {}
    for venue in (HOME, AWAY):
        name, at_venue = venue.lower(), F.col("location") == venue
        for word, outcome in (("wins", _won()), ("draws", _drawn()), ("losses", _lost())):
            out[f"{name}_{word}"] = F.sum(flag(at_venue & outcome))
        own = {"1h": F.col("first_half_for"), "2h": F.col("goals_for") - F.col("first_half_for")}
        against = {"1h": F.col("first_half_against"), "2h": F.col("goals_against") - F.col("first_half_against")}
        for half in ("1h", "2h"):
            out[f"{name}_scored_{half}_pct"] = rate(own[half] > 0, 1, at_venue)
            out[f"{name}_avg_goals_{half}"] = mean(F.when(at_venue, own[half]), 2)
            out[f"{name}_clean_sheet_{half}_pct"] = rate(against[half] == 0, 1, at_venue)
            out[f"{name}_avg_conceded_{half}"] = mean(F.when(at_venue, against[half]), 2)
        out[f"{name}_scored_both_halves_pct"] = rate((own["1h"] > 0) & (own["2h"] > 0), 1, at_venue)
    return out


# Columns of the summary, by block.
SUMMARY_OVERVIEW = [
    "matches_played", "wins", "draws", "losses", "total_points", "points_per_game", "goals_for",
    "goals_against", "goal_difference", "goals_per_game", "goals_conceded_per_game", "clean_sheets",
    "clean_sheet_percentage", "home_wins", "home_draws", "home_losses", "away_wins", "away_draws",
    "away_losses",
]
SUMMARY_ATTACK = [
    "total_xg", "xg_per_game", "xg_difference", "xg_diff_per_game", "total_big_chances_created",
    "big_chances_created_per_game", "total_big_chances_missed", "big_chances_missed_per_game",
    "total_shots", "shots_per_game", "total_shots_on_target", "shots_on_target_per_game",
    "total_shots_inside_box", "shots_inside_box_per_game", "total_shots_outside_box",
    "shots_outside_box_per_game", "total_corners", "corners_per_game", "avg_dribbles_success_pct",
    "total_hit_woodwork",
]
SUMMARY_DEFENSE = [
    "total_saves", "saves_per_game", "total_tackles", "tackles_per_game", "avg_tackles_won_pct",
    "total_interceptions", "interceptions_per_game", "total_clearances", "clearances_per_game",
    "total_blocked_shots", "blocked_shots_per_game", "total_ball_recoveries", "ball_recoveries_per_game",
    "avg_aerial_duels_pct", "avg_ground_duels_pct", "avg_duels_won_pct", "total_errors_lead_to_goal",
    "total_errors_lead_to_shot",
]
SUMMARY_POSSESSION = [
    "avg_possession_pct", "total_accurate_passes", "total_passes", "pass_accuracy_pct",
    "accurate_passes_per_game", "total_passes_per_game", "total_accurate_long_balls",
    "accurate_long_balls_per_game", "total_accurate_crosses", "accurate_crosses_per_game",
    "total_final_third_entries", "final_third_entries_per_game", "total_touches_in_box_possession",
    "touches_in_box_per_game_possession", "total_dispossessed", "dispossessed_per_game",
]
SUMMARY_DISCIPLINE = [
    "total_yellow_cards", "yellow_cards_per_game", "total_red_cards", "total_fouls", "fouls_per_game",
    "total_offsides", "offsides_per_game", "total_free_kicks", "free_kicks_per_game",
]
SUMMARY_FORM = [
    "last_5_results", "points_last_5", "wins_last_5", "draws_last_5", "losses_last_5", "goals_for_last_5",
    "goals_against_last_5", "halftime_leading_count", "halftime_leading_wins", "halftime_leading_win_pct",
    "conceded_first_count", "points_after_conceding_first", "points_pct_after_conceding_first",
]
SUMMARY_HALVES = [
    f"{venue}_{name}"
    for venue in ("home", "away")
    for name in (
        "scored_1h_pct", "scored_2h_pct", "scored_both_halves_pct", "avg_goals_1h", "avg_goals_2h",
        "clean_sheet_1h_pct", "clean_sheet_2h_pct", "avg_conceded_1h", "avg_conceded_2h",
    )
]
SUMMARY_COLUMNS = (
    ["season_id", "season_name", "season_year", "team_id", "team_name"]
    + SUMMARY_OVERVIEW + SUMMARY_ATTACK + SUMMARY_DEFENSE + SUMMARY_POSSESSION + SUMMARY_DISCIPLINE
    + SUMMARY_FORM + SUMMARY_HALVES
)


def team_themes() -> dict[str, Column]:
    """Attack, defense, possession and discipline; a measure that two themes share appears once."""
    return attack_measures() | defense_measures() | possession_measures() | discipline_measures()


def team_season_wide(fact_match: DataFrame, totals: DataFrame) -> DataFrame:
    """All themes in one pass over the sides and one over the statistics, not one per mart."""
    goals = scored_measures() | conceded_measures() | overview_measures() | venue_measures()
    return _season_mart(fact_match, totals, goals, team_themes())


def mart_team_season_summary(fact_match: DataFrame, totals: DataFrame, form: DataFrame) -> DataFrame:
    wide = team_season_wide(fact_match, totals).withColumns(
        {
            "total_touches_in_box_possession": F.col("total_touches_in_box"),
            "touches_in_box_per_game_possession": F.col("touches_in_box_per_game"),
        }
    )
    wide = wide.fillna(0, subset=SUMMARY_HALVES)
    recent = form.select(*TEAM_SEASON, *SUMMARY_FORM)
    return wide.join(recent, TEAM_SEASON, "left").select(*SUMMARY_COLUMNS)


# --- league averages -------------------------------------------------------

# Fixed values: (column, digits) averaged over teams; the source has the name without "avg_"
# unless given.
LEAGUE_MEANS = [
    ("avg_goals_per_game_per_team", "goals_per_game", 2),
    ("avg_xg_difference", "xg_difference", 2),
    ("avg_xg_diff_per_game", "xg_diff_per_game", 2),
    ("avg_big_chances_created_per_game", "big_chances_created_per_game", 2),
    ("avg_big_chances_missed_per_game", "big_chances_missed_per_game", 2),
    ("avg_big_chances_scored_per_game", "big_chances_scored_per_game", 2),
    ("avg_shots_per_game", "shots_per_game", 2),
    ("avg_shots_on_target_per_game", "shots_on_target_per_game", 2),
    ("avg_shots_off_target_per_game", "shots_off_target_per_game", 2),
    ("avg_blocked_shots_per_game", "blocked_shots_per_game", 2),
    ("avg_shots_inside_box_per_game", "shots_inside_box_per_game", 2),
    ("avg_shots_outside_box_per_game", "shots_outside_box_per_game", 2),
    ("avg_corners_per_game", "corners_per_game", 2),
    ("avg_dribbles_success_pct", "avg_dribbles_success_pct", 1),
    ("avg_touches_in_box_per_game", "touches_in_box_per_game", 2),
    ("avg_goals_conceded_per_game", "goals_conceded_per_game", 2),
    ("avg_xga_per_game", "xga_per_game", 2),
    ("avg_xga_difference", "xga_difference", 2),
    ("avg_xga_difference_per_game", "xga_difference_per_game", 2),
    ("avg_clean_sheet_pct", "clean_sheet_pct", 1),
    ("avg_saves_per_game", "saves_per_game", 2),
    ("avg_tackles_per_game", "tackles_per_game", 2),
    ("avg_tackles_won_pct", "avg_tackles_won_pct", 1),
    ("avg_interceptions_per_game", "interceptions_per_game", 2),
    ("avg_clearances_per_game", "clearances_per_game", 2),
    ("avg_blocked_shots_per_game_def", "blocked_shots_per_game", 2),
    ("avg_ball_recoveries_per_game", "ball_recoveries_per_game", 2),
    ("avg_aerial_duels_pct", "avg_aerial_duels_pct", 1),
    ("avg_ground_duels_pct", "avg_ground_duels_pct", 1),
    ("avg_duels_won_pct", "avg_duels_won_pct", 1),
    ("avg_possession_pct", "avg_possession_pct", 1),
    ("avg_pass_accuracy_pct", "pass_accuracy_pct", 1),
    ("avg_accurate_passes_per_game", "accurate_passes_per_game", 1),
    ("avg_total_passes_per_game", "total_passes_per_game", 1),
    ("avg_accurate_long_balls_per_game", "accurate_long_balls_per_game", 2),
    ("avg_accurate_crosses_per_game", "accurate_crosses_per_game", 2),
    ("avg_final_third_entries_per_game", "final_third_entries_per_game", 2),
    ("avg_touches_in_box_per_game_poss", "touches_in_box_per_game", 2),
    ("avg_dispossessed_per_game", "dispossessed_per_game", 2),
    ("avg_throw_ins_per_game", "throw_ins_per_game", 2),
    ("avg_goal_kicks_per_game", "goal_kicks_per_game", 2),
    ("avg_yellow_cards_per_game", "yellow_cards_per_game", 2),
    ("avg_fouls_per_game", "fouls_per_game", 2),
    ("avg_offsides_per_game", "offsides_per_game", 2),
    ("avg_free_kicks_per_game", "free_kicks_per_game", 2),
]
# Season totals and the team total each one sums.
LEAGUE_TOTALS = [
    ("total_xg_in_season", "total_xg"),
    ("total_shots_in_season", "total_shots"),
    ("total_shots_on_target_in_season", "total_shots_on_target"),
    ("total_hit_woodwork_in_season", "total_hit_woodwork"),
    ("total_big_chances_created", "total_big_chances_created"),
    ("total_big_chances_missed", "total_big_chances_missed"),
    ("total_big_chances_scored", "total_big_chances_scored"),
    ("total_corners_in_season", "total_corners"),
    ("total_xga_in_season", "total_xga"),
    ("total_saves_in_season", "total_saves"),
    ("total_tackles_in_season", "total_tackles"),
    ("total_interceptions_in_season", "total_interceptions"),
    ("total_errors_lead_to_goal_in_season", "total_errors_lead_to_goal"),
    ("total_errors_lead_to_shot_in_season", "total_errors_lead_to_shot"),
    ("total_accurate_passes_in_season", "total_accurate_passes"),
    ("total_passes_in_season", "total_passes"),
    ("total_accurate_long_balls_in_season", "total_accurate_long_balls"),
    ("total_accurate_crosses_in_season", "total_accurate_crosses"),
    ("total_final_third_entries_in_season", "total_final_third_entries"),
    ("total_yellow_cards_in_season", "total_yellow_cards"),
    ("total_red_cards_in_season", "total_red_cards"),
    ("total_fouls_in_season", "total_fouls"),
    ("total_offsides_in_season", "total_offsides"),
    ("total_free_kicks_in_season", "total_free_kicks"),
]


def league_outcomes(fact_match: DataFrame) -> DataFrame:
    home, away, code = F.col("home_score"), F.col("away_score"), F.col("winner_code")
    return fact_match.where(F.col("status_type") == "finished").groupBy("season_id").agg(
        F.max("season_name").alias("season_name"),
        F.max("season_year").alias("season_year"),
        F.min("tournament_id").alias("tournament_id"),
        F.min("tournament_name").alias("tournament_name"),
        _rows().alias("total_matches"),
        mean(home + away, 2).alias("avg_goals_per_match"),
        mean(home, 2).alias("avg_home_goals"),
        mean(away, 2).alias("avg_away_goals"),
        F.sum(home + away).alias("total_goals_in_season"),
        rate(code == 1).alias("home_win_pct"),
        rate(code == 2).alias("away_win_pct"),
        rate(code == 3).alias("draw_pct"),
        rate((home > 0) & (away > 0)).alias("btts_pct"),
        rate((home == 0) | (away == 0)).alias("clean_sheet_pct"),
    )


def league_blocks(teams: DataFrame) -> DataFrame:
    """Unweighted averages of the rounded team figures, and season totals."""
    xg_per_game = F.round(quotient(mean_filled("total_xg"), mean_filled("matches_played")), 2)
    return teams.groupBy("season_id").agg(
        F.count("team_id").alias("teams_count"),
        xg_per_game.alias("avg_xg_per_game"),
        *[mean_filled(source, digits).alias(name) for name, source, digits in LEAGUE_MEANS],
        *[F.sum(zero(source)).alias(name) for name, source in LEAGUE_TOTALS],
    )


def mart_league_averages(fact_match: DataFrame, totals: DataFrame) -> DataFrame:
    """One row per season.

    All team themes come from one aggregation, so the block join has two inputs
    of one row per season each.
    """
    goals = scored_measures() | conceded_measures()
    blocks = league_blocks(_season_mart(fact_match, totals, goals, team_themes()))
    out = league_outcomes(fact_match).join(blocks, "season_id", "left")
    identity = ["season_id", "season_name", "season_year", "tournament_id", "tournament_name", "total_matches"]
    return out.fillna(0, subset=[c for c in out.columns if c not in identity])


# --- upcoming fixtures -----------------------------------------------------


def mart_upcoming_fixtures(upcoming: DataFrame) -> DataFrame:
    """Newest extraction of each match, defaults filled, incomplete rows dropped."""
    latest = dedupe_latest(upcoming, ["match_id"], [F.desc("extracted_at"), F.xxhash64(*upcoming.columns)])
    rows = latest.select(
        "match_id",
        "match_slug",
        F.coalesce("custom_id", F.lit("N/A")).alias("custom_id"),
        "start_timestamp",
        F.coalesce("status_type", F.lit("notstarted")).alias("status_type"),
        "home_team_id",
        "home_team_name",
        "away_team_id",
        "away_team_name",
        F.col("tournament_id_metadata").alias("tournament_id"),
        "tournament_name",
        F.col("season_id_metadata").alias("season_id"),
        "season_name",
        F.coalesce("season_year", F.year("start_timestamp").cast("string")).alias("season_year"),
        F.coalesce("round_number", F.lit(0)).alias("round_number"),
        "extraction_date",
        "extracted_at",
    )
    return require_non_null(rows, UPCOMING_REQUIRED)
