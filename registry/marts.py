"""Models: bronze, silver, gold, scorer."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sidewise.plans import appearances as A
from sidewise.plans import bronze, gold, scorer, silver, upkeep
from sidewise.session import scratch_path

from . import query
from .duck import AS_OF, mean, mean0, rnd, share, sql, stat
from .inputs import Inputs

FIXED = A.ALL_METRICS


# --- silver ------------------------------------------------------------------

STAGED_COLUMNS = (
    "match_id, match_slug, start_timestamp, status_type, status_description, winner_code, home_score_current, "
    "away_score_current, home_score_period1, home_score_period2, away_score_period1, away_score_period2, "
    "home_team_id, home_team_name, away_team_id, away_team_name, tournament_id, tournament_name, season_id, "
    "season_name, season_year, country_name, injury_time_2"
)


@query(
    "staging_matches",
    sql(
        f"""select {STAGED_COLUMNS}, case when injury_time_2 is not null then start_timestamp + interval 1 hour end as current_period_start_timestamp
        from staged"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return i.staged


_STAT_VALUES = """
  home_cents / 100.0::double as home_value_numeric, away_cents / 100.0::double as away_value_numeric,
  case when home_cents > away_cents then 'HOME' when away_cents > home_cents then 'AWAY'
       when home_cents = away_cents then 'EQUAL' else 'UNKNOWN' end as advantage,
  case when home_cents + away_cents > 0 then {h} end as home_percentage,
  case when home_cents + away_cents > 0 then {a} end as away_percentage,
  (home_cents - away_cents) / 100.0::double as value_difference
""".format(
    h=rnd("100 * home_cents", "home_cents + away_cents", 2), a=rnd("100 * away_cents", "home_cents + away_cents", 2)
)


@query(
    "staging_stats",
    sql(
        f"""select s.match_id, 202 as tournament_id, m.season_id, s.period, group_name, statistic_key, statistic_name, statistics_type, value_type, {_STAT_VALUES},
          row_number() over (partition by s.match_id, s.period, group_name order by statistic_key) as stat_order_in_group,
          count(*) over (partition by s.match_id, s.period, group_name) as stats_count_in_group,
          c.total_statistics_count, c.periods_count, c.groups_count, count(*) over (partition by s.match_id, s.period) as statistics_in_period
        from stats s join staged m on m.match_id = s.match_id
        join (select match_id, count(*) as total_statistics_count, count(distinct period) as periods_count, count(distinct group_name) as groups_count
              from stats group by match_id) c on c.match_id = s.match_id"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return i.staged_stats.drop("home_value_text", "away_value_text")


@query(
    "dim_date",
    sql(
        """select d::date as date_day, year(d)::int as year, month(d)::int as month, day(d)::int as day, quarter(d)::int as quarter,
        dayofweek(d)::int as day_of_week, dayname(d) as day_name, monthname(d) as month_name, week(d)::int as week_of_year,
        dayofweek(d) in (0, 6) as is_weekend
        from (select unnest(generate_series(min(start_timestamp::date)::timestamp, (max(start_timestamp::date) + interval 1 year)::timestamp, interval 1 day)) as d from staged)"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return silver.dim_date(i.staged)


@query(
    "dim_date_padded",
    sql(
        """select d::date as date_day, rpad(dayname(d), 9, ' ') as day_name, rpad(monthname(d), 9, ' ') as month_name
        from (select unnest(generate_series(min(start_timestamp::date)::timestamp, (max(start_timestamp::date) + interval 1 year)::timestamp, interval 1 day)) as d from staged)"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return silver.dim_date(i.staged, padded=True).select("date_day", "day_name", "month_name")


@query(
    "dim_period",
    sql(
        """select distinct period as period_code, case period when 'ALL' then 'Full match' when '1ST' then 'First half'
        when '2ND' then 'Second half' end as period_name from stats where match_id in (select match_id from staged)"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return silver.dim_period(i.staged_stats)


@query("dim_seasons", sql("select season_id, season_name, season_year from staged group by all"))
def _(i: Inputs) -> DataFrame:
    return silver.dim_seasons(i.staged)


@query("dim_tournaments", sql("select tournament_id, tournament_name, country_name from staged group by all"))
def _(i: Inputs) -> DataFrame:
    return silver.dim_tournaments(i.staged)


@query(
    "dim_stat_types",
    sql(
        """select statistic_key, statistic_name, group_name, statistics_type, value_type
        from stats where match_id in (select match_id from staged) group by all"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return silver.dim_stat_types(i.staged_stats)


@query(
    "dim_teams",
    sql(
        """select home_team_id as team_id, home_team_name as team_name from staged
        union select away_team_id, away_team_name from staged"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return silver.dim_teams(i.staged)


@query("fact_match", sql("select * from fact"))
def _(i: Inputs) -> DataFrame:
    return i.fact


@query("fact_match_stats_present", sql("select match_id, match_id in (select match_id from stats) as stats_present from fact"))
def _(i: Inputs) -> DataFrame:
    return silver.with_stats_present(i.fact, i.stats).select("match_id", "stats_present")


@query(
    "fact_team_match",
    sql(
        f"""select md5(match_id || '-' || team_id || '-' || period) as match_team_period_key, match_id, team_id, team_name, period,
        {", ".join(f"({stat(m)} / 100.0)::double as {stat(m)}" for m in FIXED)} from team_match"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return i.team_match()


@query(
    "fact_season_team",
    sql(
        """select md5(season_id || '-' || team_id) as season_team_key, md5(season_id || '-' || tournament_id || '-' || team_id) as season_team_stage_key,
        season_id, season_name, season_year, tournament_id, team_id, team_name, count(*) as matches_played,
        sum(gf)::bigint as goals_for, sum(ga)::bigint as goals_against,
        sum(case when gf > ga then 3 when gf = ga then 1 else 0 end)::bigint as points
        from (
          select s.season_id, season_name, season_year, tournament_id, t.team_id, t.team_name,
            case when t.team_id = home_team_id then home_score_current else away_score_current end as gf,
            case when t.team_id = home_team_id then away_score_current else home_score_current end as ga
          from team_match t join staged s on s.match_id = t.match_id where period = 'ALL'
        ) group by all"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return silver.fact_season_team(i.side_values, i.staged)


# --- team marts --------------------------------------------------------------

_ID = "team_id, max(team_name) as team_name, season_id, max(season_name) as season_name, max(season_year) as season_year"
_BY = "group by team_id, season_id"
_PLAYED = "count(*) as matches_played"
_POINTS = "case winner_code when won then 3 when 3 then 1 when lost then 0 end"


def _sum(c: str) -> str:
    return f"sum({c})::bigint"


def _count(predicate: str) -> str:
    return f"count(*) filter ({predicate})"


def _units(raw: str, name: str, digits: int = 2) -> str:
    """Total and per-game columns of one statistic (stored in hundredths)."""
    return f"(sum(ifnull({stat(raw)}, 0)) / 100.0)::double as total_{name}, {mean0(stat(raw), digits)} as {name}_per_game"


def _avg_pct(raw: str, name: str) -> str:
    return f"{mean(f'nullif({stat(raw)}, 0)', 1, unit=100)} as {name}"


OVERVIEW = ", ".join(
    [
        f"{_count('winner_code = won')} as wins",
        f"{_count('winner_code = 3')} as draws",
        f"{_count('winner_code = lost')} as losses",
        f"{_sum(_POINTS)} as total_points",
        f"{rnd(f'sum({_POINTS})', 'count(*)', 2)} as points_per_game",
        f"{_sum('gf')} as goals_for",
        f"{_sum('ga')} as goals_against",
        "(sum(gf) - sum(ga))::bigint as goal_difference",
        f"{rnd('sum(gf)', 'count(*)', 2)} as goals_per_game",
        f"{rnd('sum(ga)', 'count(*)', 2)} as goals_conceded_per_game",
        f"{_count('ga = 0')} as clean_sheets",
        f"{share('ga = 0')} as clean_sheet_percentage",
    ]
)
_SHOTS = " + ".join(f"ifnull({stat(m)}, 0)" for m in ("shotsOnGoal", "shotsOffGoal", "blockedScoringAttempt"))
_XG = f"sum(ifnull({stat('expectedGoals')}, 0))"
ATTACK = ", ".join(
    [
        f"{_sum('gf')} as total_goals",
        f"{mean('gf', 2)} as goals_per_game",
        f"({_XG} / 100.0)::double as total_xg",
        f"{mean0(stat('expectedGoals'), 2)} as xg_per_game",
        f"{rnd(f'100 * sum(gf) - {_XG}', '100', 2)} as xg_difference",
        f"{rnd(f'100 * sum(gf) - {_XG}', '100 * count(*)', 2)} as xg_diff_per_game",
        _units("bigChanceCreated", "big_chances_created"),
        _units("bigChanceMissed", "big_chances_missed"),
        _units("bigChanceScored", "big_chances_scored"),
        _units("shotsOnGoal", "shots_on_target"),
        _units("shotsOffGoal", "shots_off_target"),
        _units("blockedScoringAttempt", "blocked_shots"),
        f"(sum({_SHOTS}) / 100.0)::double as total_shots",
        f"{rnd(f'sum({_SHOTS})', '100 * count(*)', 2)} as shots_per_game",
        _units("totalShotsInsideBox", "shots_inside_box"),
        _units("totalShotsOutsideBox", "shots_outside_box"),
        f"(sum(ifnull({stat('hitWoodwork')}, 0)) / 100.0)::double as total_hit_woodwork",
        _units("cornerKicks", "corners"),
        _avg_pct("dribblesPercentage", "avg_dribbles_success_pct"),
        _units("touchesInOppBox", "touches_in_box"),
    ]
)
_XGA = "sum(ifnull(xg_against, 0))"
DEFENSE = ", ".join(
    [
        f"{_sum('ga')} as total_goals_conceded",
        f"{mean('ga', 2)} as goals_conceded_per_game",
        f"({_XGA} / 100.0)::double as total_xga",
        f"{mean0('xg_against', 2)} as xga_per_game",
        f"{rnd(f'100 * sum(ga) - {_XGA}', '100', 2)} as xga_difference",
        f"{rnd(f'100 * sum(ga) - {_XGA}', '100 * count(*)', 2)} as xga_difference_per_game",
        f"{_count('ga = 0')} as clean_sheets",
        f"{share('ga = 0')} as clean_sheet_pct",
        _units("goalkeeperSaves", "saves"),
        _units("totalTackle", "tackles"),
        _avg_pct("wonTacklePercent", "avg_tackles_won_pct"),
        _units("interceptionWon", "interceptions"),
        _units("totalClearance", "clearances"),
        _units("blockedScoringAttempt", "blocked_shots"),
        _units("ballRecovery", "ball_recoveries"),
        _avg_pct("aerialDuelsPercentage", "avg_aerial_duels_pct"),
        _avg_pct("groundDuelsPercentage", "avg_ground_duels_pct"),
        _avg_pct("duelWonPercent", "avg_duels_won_pct"),
        f"(sum(ifnull({stat('errorsLeadToGoal')}, 0)) / 100.0)::double as total_errors_lead_to_goal",
        f"(sum(ifnull({stat('errorsLeadToShot')}, 0)) / 100.0)::double as total_errors_lead_to_shot",
    ]
)
_PASS = f"sum(ifnull({stat('accuratePasses')}, 0))"
_ALLPASS = f"sum(ifnull({stat('passes')}, 0))"
POSSESSION = ", ".join(
    [
        _avg_pct("ballPossession", "avg_possession_pct"),
        _units("accuratePasses", "accurate_passes", 1),
        f"({_ALLPASS} / 100.0)::double as total_passes",
        f"{mean0(stat('passes'), 1)} as total_passes_per_game",
        f"{rnd(f'100 * {_PASS}', _ALLPASS, 1)} as pass_accuracy_pct",
        _units("accurateLongBalls", "accurate_long_balls"),
        _units("accurateCross", "accurate_crosses"),
        _units("finalThirdEntries", "final_third_entries"),
        _units("touchesInOppBox", "touches_in_box"),
        _units("dispossessed", "dispossessed"),
        _units("throwIns", "throw_ins"),
        _units("goalKicks", "goal_kicks"),
    ]
)
DISCIPLINE = ", ".join(
    [
        _units("yellowCards", "yellow_cards"),
        f"(sum(ifnull({stat('redCards')}, 0)) / 100.0)::double as total_red_cards",
        _units("fouls", "fouls"),
        _units("offsides", "offsides"),
        _units("freeKicks", "free_kicks"),
    ]
)
TEAM_MARTS = {
    "team_overview": f"select {_ID}, {_PLAYED}, {OVERVIEW} from sides {_BY}",
    "team_attack": f"select {_ID}, {_PLAYED}, {ATTACK} from appearances {_BY}",
    "team_defense": f"select {_ID}, {_PLAYED}, {DEFENSE} from appearances {_BY}",
    "team_possession": f"select {_ID}, {_PLAYED}, {POSSESSION} from appearances {_BY}",
    "team_discipline": f"select {_ID}, {_PLAYED}, {DISCIPLINE} from appearances {_BY}",
}


@query("mart_team_overview", sql(TEAM_MARTS["team_overview"]))
def _(i: Inputs) -> DataFrame:
    return gold.mart_team_overview(A.team_sides(i.fact))


@query("mart_team_attack", sql(TEAM_MARTS["team_attack"]))
def _(i: Inputs) -> DataFrame:
    return gold.mart_team_attack(i.fact, i.totals(A.ATTACK_METRICS))


@query("mart_team_defense", sql(TEAM_MARTS["team_defense"]))
def _(i: Inputs) -> DataFrame:
    return gold.mart_team_defense(i.fact, i.totals(A.DEFENSE_METRICS))


@query("mart_team_defense_from_facts", sql(TEAM_MARTS["team_defense"]))
def _(i: Inputs) -> DataFrame:
    team_match = i.team_match(A.DEFENSE_METRICS)
    return gold.mart_team_defense(i.fact, A.season_totals_from_facts(i.fact, team_match, A.DEFENSE_METRICS))


@query("mart_team_possession", sql(TEAM_MARTS["team_possession"]))
def _(i: Inputs) -> DataFrame:
    return gold.mart_team_possession(i.fact, i.totals(A.POSSESSION_METRICS))


@query("mart_team_discipline", sql(TEAM_MARTS["team_discipline"]))
def _(i: Inputs) -> DataFrame:
    return gold.mart_team_discipline(i.fact, i.totals(A.DISCIPLINE_METRICS))


# --- form --------------------------------------------------------------------


def form_sql(home: int, away: int, draw: int) -> str:
    points = (
        f"case when winner_code = case location when 'HOME' then {home} else {away} end then 3 "
        f"when winner_code = {draw} then 1 else 0 end"
    )
    ranked = f"""
    select *, case winner_code when won then 'W' when lost then 'L' when 3 then 'D' end as letter, {points} as points,
      row_number() over (partition by team_id, season_id order by start_timestamp desc, match_id desc) as r,
      row_number() over (partition by team_id, season_id, location order by start_timestamp desc, match_id desc) as v
    from sides"""
    cols = []
    for n in gold.FORM_WINDOWS:
        cols += [
            f"string_agg(letter, '' order by r) filter (r <= {n}) as last_{n}_results",
            f"(sum(points) filter (r <= {n}))::bigint as points_last_{n}",
            f"count(*) filter (r <= {n} and letter = 'W') as wins_last_{n}",
            f"count(*) filter (r <= {n} and letter = 'D') as draws_last_{n}",
            f"count(*) filter (r <= {n} and letter = 'L') as losses_last_{n}",
            f"(sum(gf) filter (r <= {n}))::bigint as goals_for_last_{n}",
            f"(sum(ga) filter (r <= {n}))::bigint as goals_against_last_{n}",
        ]
    for place in ("home", "away"):
        where = f"location = '{place.upper()}' and v <= 5"
        cols.append(f"ifnull(string_agg(letter, '' order by v) filter ({where}), '') as last_5_results_{place}")
        cols.append(f"ifnull(sum(points) filter ({where}), 0)::bigint as points_last_5_{place}")
    led, conceded = "h1f > h1a", "ga > 0"
    cols.append(f"nullif(count(*) filter ({led}), 0) as halftime_leading_count")
    for word, letter in (("wins", "W"), ("draws", "D"), ("losses", "L")):
        cols.append(
            f"case when count(*) filter ({led}) > 0 then count(*) filter ({led} and letter = '{letter}') end as halftime_leading_{word}"
        )
    won_led = f"100 * count(*) filter ({led} and letter = 'W')"
    cols.append(f"{rnd(won_led, f'count(*) filter ({led})', 1)} as halftime_leading_win_pct")
    cols.append(f"nullif(count(*) filter ({conceded}), 0) as conceded_first_count")
    cols.append(f"(sum(points) filter ({conceded}))::bigint as points_after_conceding_first")
    after = f"100 * sum(points) filter ({conceded})"
    cols.append(f"{rnd(after, f'3 * count(*) filter ({conceded})', 1)} as points_pct_after_conceding_first")
    return f"select {_ID}, {', '.join(cols)} from ({ranked}) {_BY}"


FORM_STANDARD = form_sql(1, 2, 3)
FORM_ALTERNATE = form_sql(1, 3, 2)


@query("mart_team_form", sql(FORM_STANDARD))
def _(i: Inputs) -> DataFrame:
    return i.form()


@query("mart_team_form_alternate_codes", sql(FORM_ALTERNATE))
def _(i: Inputs) -> DataFrame:
    return i.form(gold.ALTERNATE_CODES)


# --- pairs, goals, summary, league -------------------------------------------

_PAIRS = """
select *, least(home_team_id, away_team_id) as t1, greatest(home_team_id, away_team_id) as t2,
  case when home_team_id < away_team_id then home_score else away_score end as g1,
  case when home_team_id < away_team_id then away_score else home_score end as g2,
  case when home_team_id < away_team_id then home_team_name else away_team_name end as n1,
  case when home_team_id < away_team_id then away_team_name else home_team_name end as n2,
  case when winner_code = 3 then 'X' when (winner_code = 1) = (home_team_id < away_team_id) then '1' else '2' end as letter,
  row_number() over (partition by least(home_team_id, away_team_id), greatest(home_team_id, away_team_id)
    order by match_date desc, match_id desc) as r
from fact
"""


@query(
    "mart_head_to_head",
    sql(
        f"""select t1 as team_id_1, t2 as team_id_2, max(n1) as team_1_name, max(n2) as team_2_name, count(*) as total_matches,
        {_count("letter = '1'")} as team_1_wins, {_count("letter = 'X'")} as draws, {_count("letter = '2'")} as team_2_wins,
        {_sum("g1")} as team_1_goals, {_sum("g2")} as team_2_goals, {mean("g1", 2)} as team_1_avg_goals, {mean("g2", 2)} as team_2_avg_goals,
        {share("g1 + g2 >= 2")} as over_15_pct, {share("g1 + g2 >= 3")} as over_25_pct, {share("g1 + g2 >= 4")} as over_35_pct,
        {share("least(g1, g2) > 0")} as btts_pct, max(match_date) as last_meeting_date,
        string_agg(letter || ' (' || g1 || '-' || g2 || ')', ' | ' order by r) filter (r <= 5) as last_5_results
        from ({_PAIRS}) group by t1, t2"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return gold.mart_head_to_head(i.fact)


def _btts_sql() -> str:
    xg, xga = f"ifnull({stat('expectedGoals')}, 0)", "ifnull(xg_against, 0)"
    cols = []
    for prefix, where in (("overall", "true"), ("home", "location = 'HOME'"), ("away", "location = 'AWAY'")):
        cols += [
            f"{share('winner_code = won', where)} as {prefix}_win_pct",
            f"{mean('gf + ga', 2, where)} as {prefix}_avg_goals_per_match",
            f"{mean('gf', 2, where)} as {prefix}_avg_scored",
            f"{mean('ga', 2, where)} as {prefix}_avg_conceded",
            f"{share('least(gf, ga) > 0', where)} as {prefix}_btts_pct",
            f"{share('ga = 0', where)} as {prefix}_clean_sheet_pct",
            f"{mean(xg, 2, where, 100)} as {prefix}_avg_xg",
            f"{mean(xga, 2, where, 100)} as {prefix}_avg_xga",
        ]
        for n in (1, 2, 3, 4):
            cols.append(f"ifnull({share(f'ga >= {n}', where)}, 0) as {prefix}_conceded_over_{n - 1}5_pct")
        if prefix == "overall":
            continue
        cols.append(f"nullif(count(*) filter ({where}), 0) as {prefix}_matches_played")
        for n in (1, 2, 3, 4):
            cols.append(f"ifnull({share(f'gf >= {n}', where)}, 0) as {prefix}_scored_over_{n - 1}5_pct")
        cols.append(f"ifnull({share('gf = 0', where)}, 0) as {prefix}_failed_to_score_pct")
    return f"select {_ID}, {_PLAYED}, {', '.join(cols)} from appearances {_BY}"


@query("mart_team_btts_analysis", sql(_btts_sql()))
def _(i: Inputs) -> DataFrame:
    return gold.mart_team_btts_analysis(i.sides(A.XG_METRICS))


def _halves_sql() -> str:
    cols = []
    for place in ("home", "away"):
        where = f"location = '{place.upper()}'"
        for word, test in (("wins", "winner_code = won"), ("draws", "winner_code = 3"), ("losses", "winner_code = lost")):
            cols.append(f"count(*) filter ({test} and {where}) as {place}_{word}")
        for half, own, other in (("1h", "h1f", "h1a"), ("2h", "gf - h1f", "ga - h1a")):
            cols += [
                f"ifnull({share(f'{own} > 0', where)}, 0) as {place}_scored_{half}_pct",
                f"ifnull({mean(f'({own})', 2, where)}, 0) as {place}_avg_goals_{half}",
                f"ifnull({share(f'{other} = 0', where)}, 0) as {place}_clean_sheet_{half}_pct",
                f"ifnull({mean(f'({other})', 2, where)}, 0) as {place}_avg_conceded_{half}",
            ]
        cols.append(f"ifnull({share('h1f > 0 and gf - h1f > 0', where)}, 0) as {place}_scored_both_halves_pct")
    return f"select team_id, season_id, {', '.join(cols)} from sides {_BY}"


def _summary_sql() -> str:
    touches = ["total_touches_in_box_possession", "touches_in_box_per_game_possession"]
    blocks = {
        "o": [c for c in gold.SUMMARY_OVERVIEW if not c.startswith(("home_", "away_"))],
        "h": [c for c in gold.SUMMARY_OVERVIEW if c.startswith(("home_", "away_"))] + gold.SUMMARY_HALVES,
        "a": gold.SUMMARY_ATTACK,
        "d": gold.SUMMARY_DEFENSE,
        "p": [c for c in gold.SUMMARY_POSSESSION if c not in touches],
        "c": gold.SUMMARY_DISCIPLINE,
        "f": gold.SUMMARY_FORM,
    }
    cols = ", ".join(f"{alias}.{c}" for alias, names in blocks.items() for c in names)
    renamed = ", ".join(f"p.{c.removesuffix('_possession')} as {c}" for c in touches)
    body = "select o.season_id, o.season_name, o.season_year, o.team_id, o.team_name, " + cols + ", " + renamed + " from team_overview o"
    for alias, name in (("h", "halves"), ("a", "team_attack"), ("d", "team_defense"), ("p", "team_possession"), ("c", "team_discipline"), ("f", "team_form")):
        body += f" left join {name} {alias} on {alias}.team_id = o.team_id and {alias}.season_id = o.season_id"
    return sql(body, **TEAM_MARTS, halves=_halves_sql(), team_form=FORM_STANDARD)


@query("mart_team_season_summary", _summary_sql())
def _(i: Inputs) -> DataFrame:
    return gold.mart_team_season_summary(i.fact, i.totals(), i.form())


# Which theme a league column reads.
TEAM_MART_COLUMNS = {
    name: re.findall(r" as (\w+)", columns)
    for name, columns in (
        ("team_attack", ATTACK), ("team_defense", DEFENSE), ("team_possession", POSSESSION), ("team_discipline", DISCIPLINE)
    )
}


def _league_sql() -> str:
    """Second-level averages over the team marts; one-digit and two-digit inputs become whole hundredths."""
    source_of = {}
    for mart in ("team_discipline", "team_possession", "team_defense", "team_attack"):
        for name in TEAM_MART_COLUMNS[mart]:
            source_of[name] = mart
    cols = []
    for name, source, digits in gold.LEAGUE_MEANS:
        cents = f"round(ifnull({source_of[source]}.{source}, 0) * 100)::bigint"
        cols.append(f"ifnull({rnd(f'sum({cents})', '100 * count(*)', digits)}, 0) as {name}")
    for name, source in gold.LEAGUE_TOTALS:
        cols.append(f"(sum(round(ifnull({source_of[source]}.{source}, 0) * 100)) / 100)::double as {name}")
    xg = "sum(round(team_attack.total_xg * 100)::bigint)"
    cols.append(f"{rnd(xg, '100 * sum(team_attack.matches_played)', 2)} as avg_xg_per_game")
    joins = " ".join(
        f"join {m} on {m}.team_id = team_attack.team_id and {m}.season_id = team_attack.season_id"
        for m in ("team_defense", "team_possession", "team_discipline")
    )
    blocks = f"select team_attack.season_id, count(*) as teams_count, {', '.join(cols)} from team_attack {joins} group by team_attack.season_id"
    both = f"""select f.season_id, max(f.season_name) as season_name, max(f.season_year) as season_year,
      min(tournament_id) as tournament_id, min(tournament_name) as tournament_name, count(*) as total_matches,
      {mean("home_score + away_score", 2)} as avg_goals_per_match, {mean("home_score", 2)} as avg_home_goals,
      {mean("away_score", 2)} as avg_away_goals, {_sum("home_score + away_score")} as total_goals_in_season,
      {share("winner_code = 1")} as home_win_pct, {share("winner_code = 2")} as away_win_pct, {share("winner_code = 3")} as draw_pct,
      {share("home_score > 0 and away_score > 0")} as btts_pct, {share("home_score = 0 or away_score = 0")} as clean_sheet_pct
      from fact f group by f.season_id"""
    return sql("select l.*, b.* exclude (season_id) from league l left join blocks b using (season_id)", **TEAM_MARTS, blocks=blocks, league=both)



@query("mart_league_averages", _league_sql())
def _(i: Inputs) -> DataFrame:
    return gold.mart_league_averages(i.fact, i.totals())


# --- marts over a state that takes changes -----------------------------------


def kept_totals(i: Inputs, metrics: list[str]) -> DataFrame:
    """Season totals after three loads: all but the last season with faults in some matches, the last season, and the corrections."""
    root = scratch_path(i.spark, "totals")
    # Fixed expression: the matches that were wrong at first.
    wrong = F.col("match_id") % 9 == 4
    values, last = i.side_values, i.fact.agg(F.max("season_id")).scalar()
    faulty = values.where(wrong).withColumn("home_value", (F.col("home_value") + 3).cast(values.schema["home_value"].dataType))
    old = i.fact.where(F.col("season_id") < last)

    def sums(fact: DataFrame, of: DataFrame) -> DataFrame:
        return A.summed(A.season_entries(fact, of, metrics))

    measures = ["total", "nonzero", "n"]
    changes = [
        sums(old, values.where(~wrong).unionByName(faulty)),
        sums(i.fact.where(F.col("season_id") == last), values),
        upkeep.negated(sums(old, faulty), measures).unionByName(sums(old, values.where(wrong))),
    ]
    for load, change in enumerate(changes):
        upkeep.apply(root, load, change, ["team_id", "season_id", "metric"], measures, "season_id", "n")
    return A.totals_of(upkeep.read(i.spark, root, changes[0].schema, "season_id"))


@query("mart_team_attack_kept_up", sql(TEAM_MARTS["team_attack"]))
def _(i: Inputs) -> DataFrame:
    """Equal to the full computation after a new season and a correction."""
    return gold.mart_team_attack(i.fact, kept_totals(i, A.ATTACK_METRICS))


@query("mart_league_averages_kept_up", _league_sql())
def _(i: Inputs) -> DataFrame:
    return gold.mart_league_averages(i.fact, kept_totals(i, A.ALL_METRICS))


# --- fixtures and scorer -----------------------------------------------------


@query("mart_upcoming_fixtures", sql("select * from fixtures"))
def _(i: Inputs) -> DataFrame:
    from sidewise.operators.documents import unnest_upcoming

    return gold.mart_upcoming_fixtures(unnest_upcoming(i.upcoming_documents))


def _venue_sql(home: int, away: int, draw: int) -> str:
    cols = []
    for place, win in (("home", home), ("away", away)):
        where = f"location = '{place.upper()}'"
        for name, value, unit in (
            ("goals_scored", "gf", 1), ("goals_conceded", "ga", 1), ("xg", f"ifnull({stat('expectedGoals')}, 0)", 100),
            ("shots", f"ifnull({stat('shotsOnGoal')}, 0)", 100), ("possession", f"ifnull({stat('ballPossession')}, 0)", 100),
            ("win_rate", f"(winner_code = {win})::int", 1), ("draw_rate", f"(winner_code = {draw})::int", 1),
        ):
            cols.append(
                f"((sum({value}) filter ({where})) / {unit}.0)::double / nullif(count(*) filter ({where}), 0)::double as {place}_{name}"
            )
    return f"select team_id, season_id, {', '.join(cols)} from appearances {_BY}"


_STEP = "case when {p} >= 12 then 1.2::double when {p} >= 9 then 1.1::double when {p} >= 6 then 1.0::double when {p} >= 3 then 0.9::double else 0.8::double end"


def _snap(x: str, digits: int) -> str:
    return f"round(({x})::decimal(38,10), {digits})::double"


def _score_sql(targets: str, integer_share: bool = True) -> str:
    """Probabilities p_home, p_draw, p_away and the features of every target."""
    feats = []
    for side, alias in (("home", "hv"), ("away", "av")):
        form = "hf" if side == "home" else "af"
        for name, source in (
            ("avg_goals_scored", "goals_scored"), ("avg_goals_conceded", "goals_conceded"), ("avg_xg", "xg"),
            ("avg_shots_on_target", "shots"), ("avg_possession", "possession"), ("win_rate", "win_rate"),
        ):
            feats.append(f"ifnull({alias}.{side}_{source}, 0.0::double) as {side}_{name}_{side}")
        feats.append(f"ifnull({alias}.{side}_win_rate, 0.33::double) as {side}_raw_win")
        feats.append(f"ifnull({alias}.{side}_draw_rate, 0.33::double) as {side}_raw_draw")
        for name in ("points", "wins", "goals_for", "goals_against"):
            feats.append(f"ifnull({form}.{name}_last_5, 0) as {side}_{name}_last_5")
        feats.append(_STEP.format(p=f"ifnull({form}.points_last_5, 0)") + f" as {side}_form")
    joins = " ".join(
        f"left join {rel} {alias} on {alias}.team_id = t.{side}_team_id and {alias}.season_id = t.season_id"
        for rel, alias, side in (("venue", "hv", "home"), ("venue", "av", "away"), ("team_form", "hf", "home"), ("team_form", "af", "away"))
    )
    base = f"select t.*, {', '.join(feats)} from ({targets}) t {joins}"
    recent = "(home_goals_for_last_5 + away_goals_for_last_5)"
    strengths = []
    for side in ("home", "away"):
        own = f"{side}_goals_for_last_5"
        part = f"({own} // nullif({recent}, 0))::double" if integer_share else f"{own}::double / nullif({recent}, 0)::double"
        strengths.append(
            f"({side}_raw_win * 0.35::double + {side}_avg_xg_{side} / nullif(home_avg_xg_home + away_avg_xg_away, 0.0::double) * 0.3::double"
            f" + {side}_avg_shots_on_target_{side} / nullif(home_avg_shots_on_target_home + away_avg_shots_on_target_away, 0.0::double) * 0.15::double"
            f" + {side}_avg_possession_{side} / 100.0::double * 0.1::double + {part} * 0.1::double) * {side}_form as s_{side}"
        )
    draw = (
        "(home_raw_draw + away_raw_draw) / 2.0::double * 0.5::double"
        " + (1.0::double - abs(home_avg_xg_home - away_avg_xg_away) / nullif(greatest(home_avg_xg_home, away_avg_xg_away), 0.0::double)) * 0.25::double"
        " + (1.0::double - abs(home_form - away_form) / 0.4::double) * 0.25::double as s_draw"
    )
    strength = f"select *, {', '.join(strengths)}, {draw} from ({base})"
    return f"select *, {', '.join(f's_{o} / nullif(s_home + s_away + s_draw, 0.0::double) as p_{o}' for o in ('home', 'draw', 'away'))} from ({strength})"


def _prediction_columns() -> str:
    cols = [
        _snap("(home_avg_goals_scored_home * 0.5::double + home_avg_xg_home * 0.5::double + away_avg_goals_conceded_away) / 2.0::double", 2) + " as predicted_home_goals",
        _snap("(away_avg_goals_scored_away * 0.5::double + away_avg_xg_away * 0.5::double + home_avg_goals_conceded_home) / 2.0::double", 2) + " as predicted_away_goals",
        _snap("(home_avg_xg_home + away_avg_xg_away) / 2.0::double", 2) + " as predicted_total_xg",
        "case when p_home - p_away > 0.15 then 'HOME_FAVORITE' when p_away - p_home > 0.15 then 'AWAY_FAVORITE' else 'BALANCED' end as match_outlook",
    ]
    for o, name in (("home", "home_win"), ("draw", "draw"), ("away", "away_win")):
        cols.append(f"{_snap(f'ifnull(p_{o}, 0.33::double) * 100', 1)} as {name}_probability")
        cols.append(f"case when p_{o} > 0.01 then {_snap(f'1 / p_{o}', 2)} else 99.99::double end as {name}_fair_odds")
    return ", ".join(cols)


_MATCH_ID = (
    "match_id, match_date, season_id, season_name, season_year, home_team_id, home_team_name, away_team_id, away_team_name, tournament_name"
)


def predictions_sql(venue: str, form: str, integer_share: bool = True) -> str:
    features = ", ".join(
        [f"{s}_{n}_{s}" for s in ("home", "away") for n in ("avg_goals_scored", "avg_goals_conceded", "avg_xg", "avg_shots_on_target", "avg_possession", "win_rate")]
        + [f"{s}_{n}_last_5" for s in ("home", "away") for n in ("points", "wins", "goals_for", "goals_against")]
    )
    targets = f"select * from fact where match_date >= date '{AS_OF}' - 90"
    body = f"""select {_MATCH_ID}, {features}, {_prediction_columns()}, home_score as actual_home_score, away_score as actual_away_score,
      case sign(home_score - away_score) when 1 then 'HOME_WIN' when -1 then 'AWAY_WIN' when 0 then 'DRAW' else 'UNKNOWN' end as actual_result,
      case when p_home > p_draw and p_home > p_away then home_score > away_score
           when p_draw > p_home and p_draw > p_away then home_score = away_score
           when p_away > p_home and p_away > p_draw then home_score < away_score else false end as prediction_correct
      from scored"""
    with_errors = f"""select *, abs(predicted_home_goals::decimal(18,2) - actual_home_score)::double as home_goals_error,
      abs(predicted_away_goals::decimal(18,2) - actual_away_score)::double as away_goals_error from predicted"""
    return sql(with_errors, predicted=body, scored=_score_sql(targets, integer_share), venue=venue, team_form=form)


def _match_predictions(i: Inputs, codes: dict[str, int] = gold.STANDARD_CODES, **options) -> DataFrame:
    recent = scorer.recent_matches(i.fact, AS_OF)
    return scorer.mart_match_predictions(i.fact, i.venue(codes, recent), i.form(codes, recent), AS_OF, **options)


@query("mart_match_predictions", predictions_sql(_venue_sql(1, 2, 3), FORM_STANDARD))
def _(i: Inputs) -> DataFrame:
    return _match_predictions(i)


@query("mart_match_predictions_alternate_codes", predictions_sql(_venue_sql(1, 3, 2), FORM_ALTERNATE))
def _(i: Inputs) -> DataFrame:
    return _match_predictions(i, gold.ALTERNATE_CODES)


@query("mart_match_predictions_true_share", predictions_sql(_venue_sql(1, 2, 3), FORM_STANDARD, False))
def _(i: Inputs) -> DataFrame:
    return _match_predictions(i, integer_share=False)


@query(
    "mart_upcoming_predictions",
    sql(
        f"select {_MATCH_ID}, {_prediction_columns()} from scored",
        scored=_score_sql("select *, start_timestamp as match_date from fixtures where status_type = 'notstarted'"),
        venue=_venue_sql(1, 2, 3),
        team_form=FORM_STANDARD,
    ),
)
def _(i: Inputs) -> DataFrame:
    from sidewise.operators.documents import unnest_upcoming

    fixtures = gold.mart_upcoming_fixtures(unnest_upcoming(i.upcoming_documents))
    return scorer.mart_upcoming_predictions(fixtures, i.venue(targets=fixtures), i.form(targets=fixtures))


# --- bronze ------------------------------------------------------------------

MATCH_DOCUMENT_COLUMNS = """
  match_id, match_slug, custom_id, start_timestamp, status_code, status_type, status_description, winner_code,
  home_score_current, away_score_current, home_score_period1, home_score_period2, away_score_period1, away_score_period2,
  home_team_id, home_team_name, lower(home_team_name) as home_team_slug, substr(home_team_name, 1, 6) as home_team_short_name,
  right(home_team_name, 3) as home_team_name_code,
  away_team_id, away_team_name, lower(away_team_name) as away_team_slug, substr(away_team_name, 1, 6) as away_team_short_name,
  right(away_team_name, 3) as away_team_name_code,
  tournament_id, tournament_name, lower(tournament_name) as tournament_slug, tournament_id + 200 as unique_tournament_id,
  season_id, season_name, season_year, country_name, substr(country_name, 1, 2) as country_alpha2, substr(country_name, 1, 3) as country_alpha3,
  round_number, injury_time_2, case when injury_time_2 is not null then start_timestamp + interval 1 hour end as current_period_start_timestamp,
  match_id % 2 = 0 as is_editor, false as feed_locked, true as final_result_only, match_id % 4 = 0 as has_global_highlights,
  'feed' as source, 'b' || season_id as batch_id, start_timestamp + interval 1 day as ingestion_timestamp
"""


@query("full_matches_data", sql(f"select {MATCH_DOCUMENT_COLUMNS} from matches"))
def _(i: Inputs) -> DataFrame:
    return bronze.full_matches_data(i.match_variants)


# Loaded so far: everything before 1999, and the finished matches of that year.
_LOADED = "(season_id < 1999 or (status_type = 'finished' and season_id < 2000))"


@query(
    "full_matches_data_incremental",
    sql(f"select {MATCH_DOCUMENT_COLUMNS} from matches where start_timestamp > (select max(start_timestamp) from matches where {_LOADED})"),
)
def _(i: Inputs) -> DataFrame:
    loaded = i.matches.where(_LOADED)
    return bronze.full_matches_data(i.match_variants, loaded.withColumn("start_timestamp", F.col("start_timestamp").cast("timestamp")))


@query(
    "full_matches_data_by_key",
    sql(f"select {MATCH_DOCUMENT_COLUMNS} from matches where not {_LOADED}"),
)
def _(i: Inputs) -> DataFrame:
    return bronze.full_matches_data(i.match_variants, i.matches.where(_LOADED), mode="anti")


FULL_STATS = f"""
  select s.match_id, 202 as tournament_id, m.season_id, s.period, group_name, statistic_key, statistic_name, statistics_type, value_type, 1 as render_type,
  case when home_cents > away_cents then 1 else 2 end as compare_code, {_STAT_VALUES},
  (home_cents / 100.0::double)::varchar as home_value_text, (away_cents / 100.0::double)::varchar as away_value_text,
  home_cents is not null and away_cents is not null as has_numeric_values, true as is_complete_statistic,
  row_number() over (partition by s.match_id, s.period, group_name order by statistic_key) as stat_order_in_group,
  count(*) over (partition by s.match_id, s.period, group_name) as stats_count_in_group,
  c.total_statistics_count, c.periods_count, c.groups_count,
  count(*) over (partition by s.match_id, s.period) as statistics_in_period
  from stats s left join matches m on m.match_id = s.match_id
  join (select match_id, count(*) as total_statistics_count, count(distinct period) as periods_count, count(distinct group_name) as groups_count
        from stats group by match_id) c on c.match_id = s.match_id
"""


@query("full_stats_data", sql(FULL_STATS))
def _(i: Inputs) -> DataFrame:
    return bronze.full_stats_data(i.stats_documents, i.matches)


@query("full_stats_data_by_key", sql(f"select * from ({FULL_STATS}) where ifnull(season_id, 9999) >= 1999"))
def _(i: Inputs) -> DataFrame:
    loaded = i.matches.where("season_id < 1999").select("match_id")
    return bronze.full_stats_data(i.stats_documents, i.matches, loaded)


@query(
    "full_upcoming_fixtures",
    sql(
        """select match_id, match_slug, custom_id, start_timestamp, status_code, status_type, status_description, home_team_id, home_team_name,
        null::varchar as home_team_slug, null::varchar as home_team_short_name, away_team_id, away_team_name, null::varchar as away_team_slug,
        null::varchar as away_team_short_name, tournament_name, null::varchar as tournament_slug, season_name, season_year, round_number,
        tournament_id as tournament_id_from_match, season_id as season_id_from_match, null::varchar as round_name,
        tournament_id as tournament_id_metadata, season_id as season_id_metadata, extraction_date, extracted_at from upcoming"""
    ),
)
def _(i: Inputs) -> DataFrame:
    from sidewise.operators.documents import unnest_upcoming

    return unnest_upcoming(i.upcoming_documents)
