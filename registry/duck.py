"""Building blocks of the oracle SQL: the same inputs, written for DuckDB."""

from __future__ import annotations

import re

from sidewise.plans.appearances import ALL_METRICS

from .inputs import AS_OF, GROUPS, METRIC_OFFSETS, METRICS

_SHIFTS = ",".join(f"({o})" for o in METRIC_OFFSETS)

MATCHES = """
select m.*, h.n_name as home_team_name, a.n_name as away_team_name, h.n_regionkey as tournament_id,
  r.r_name as tournament_name, r.r_name as country_name,
  case when home_score_current > away_score_current then 1 when home_score_current < away_score_current then 2 else 3 end as winner_code,
  case when match_id % 19 <> 0 then home_score_current // 2 end as home_score_period1,
  case when match_id % 3 <> 0 then home_score_current - home_score_current // 2 end as home_score_period2,
  case when match_id % 19 <> 0 then away_score_current // 2 end as away_score_period1,
  case when match_id % 3 <> 0 then away_score_current - away_score_current // 2 end as away_score_period2
from (
  select o_orderkey as match_id, 'match-' || o_orderkey as match_slug,
    case when o_orderkey % 7 <> 0 then 'C' || o_orderkey end as custom_id,
    o_orderdate as start_timestamp,
    case o_orderstatus when 'F' then 100 when 'O' then 0 else 60 end as status_code,
    case o_orderstatus when 'F' then 'finished' when 'O' then 'notstarted' else 'postponed' end as status_type,
    case when o_orderkey % 41 = 0 then 'Removed' when o_orderkey % 43 = 0 then 'Abandoned'
         when o_orderkey % 47 = 0 then 'Canceled' when o_orderkey % 53 <> 0 then 'Ended' end as status_description,
    c_nationkey as home_team_id, ((o_custkey * 7 + o_orderkey) % 25)::int as away_team_id,
    (floor(o_totalprice)::bigint % 5)::int as home_score_current,
    (floor(o_totalprice / 7)::bigint % 4)::int as away_score_current,
    year(o_orderdate)::int as season_id, 'Season ' || year(o_orderdate) as season_name,
    substr(year(o_orderdate)::varchar, 3, 2) || '/' || substr((year(o_orderdate) + 1)::varchar, 3, 2) as season_year,
    case when o_orderkey % 11 <> 0 then dayofyear(o_orderdate)::int end as round_number,
    case when o_orderkey % 13 = 0 then (o_orderkey % 9)::int end as injury_time_2,
    o_custkey as cust_id
  from orders join customer on o_custkey = c_custkey
) m
join nation h on h.n_nationkey = m.home_team_id
join nation a on a.n_nationkey = m.away_team_id
join region r on r.r_regionkey = h.n_regionkey
where home_team_id <> away_team_id
"""

# Values are whole hundredths here, so that sums stay exact.
STATS = f"""
select match_id, period, metric_index, h, a,
  split_part('{",".join(METRICS)}', ',', metric_index + 1) as statistic_key,
  split_part('{",".join(GROUPS)}', ',', metric_index % {len(GROUPS)} + 1) as group_name,
  case when metric_index % 2 = 0 then 'positive' else 'negative' end as statistics_type,
  'Name of ' || split_part('{",".join(METRICS)}', ',', metric_index + 1) as statistic_name,
  case when split_part('{",".join(METRICS)}', ',', metric_index + 1) ilike '%percent%'
    or metric_index = {METRICS.index("ballPossession")} then 'percentage' else 'event' end as value_type,
  case when h <> 0 or match_id % 5 <> 0 then h * unit end as home_cents, a * unit as away_cents
from (
  select match_id, period, metric_index, sum(h)::bigint as h, sum(a)::bigint as a,
    case when metric_index = {METRICS.index("expectedGoals")} then 5 else 100 end as unit
  from (
    select l_orderkey as match_id, ((l_partkey + shift) % {len(METRICS)})::int as metric_index, p.period,
      case when l_linenumber % 2 = 1 then l_quantity::bigint else 0 end as h,
      case when l_linenumber % 2 = 1 then 0 else l_quantity::bigint end as a
    from lineitem, (values {_SHIFTS}) s(shift),
      lateral (select unnest(['ALL', case l_linestatus when 'F' then '1ST' else '2ND' end]) as period) p
  ) group by match_id, period, metric_index
)
"""

STAGED = """
select * from matches where status_type not in ('postponed', 'cancelled', 'retired')
and (status_description <> 'Removed' or match_id in (select match_id from stats))
"""

# The same rows as STAGED by joins alone, for queries that go through all statistics beside it.
KEPT = {
    "with_stats": "select distinct match_id as known from stats",
    "kept": """select * exclude (known) from matches left join with_stats on known = match_id
        where status_type not in ('postponed', 'cancelled', 'retired') and (status_description <> 'Removed' or known is not null)""",
}

PLAYED = "status_type = 'finished' and status_description not in ('Canceled', 'Cancelled', 'Postponed', 'Abandoned')"

FACT = f"""
select match_id, match_slug, start_timestamp::date as match_date, start_timestamp, status_type, status_description,
  winner_code, home_score_current as home_score, away_score_current as away_score,
  home_score_period1, ifnull(home_score_period2, home_score_current - home_score_period1) as home_score_period2,
  away_score_period1, ifnull(away_score_period2, away_score_current - away_score_period1) as away_score_period2,
  home_team_id, home_team_name, away_team_id, away_team_name, tournament_id, tournament_name,
  season_id, season_name, season_year, country_name, 1 as has_statistics
from staged where {PLAYED}
"""

# One row per (match, side, metric, period); values in hundredths, shares rounded half up.
TEAM_STATS = """
select s.match_id, s.period, s.statistic_key, t.team_id, t.team_name,
  case when value_type = 'percentage' and own + other > 0
    then (own * 20000 + own + other) // (2 * (own + other)) else own end as cents
from (
  select match_id, period, statistic_key, value_type, 'HOME' as location, home_cents as own, away_cents as other from stats
  union all
  select match_id, period, statistic_key, value_type, 'AWAY', away_cents, home_cents from stats
) s join (
  select match_id, 'HOME' as location, home_team_id as team_id, home_team_name as team_name from staged
  union all
  select match_id, 'AWAY', away_team_id, away_team_name from staged
) t on s.match_id = t.match_id and s.location = t.location
"""


def stat(raw: str) -> str:
    return "stat_" + raw.lower()


def _pivot(metrics: list[str]) -> str:
    return ",\n  ".join(f"max(cents) filter (statistic_key = '{m}') as {stat(m)}" for m in metrics)


TEAM_MATCH = f"""
select match_id, team_id, team_name, period,
  {_pivot(ALL_METRICS)}
from team_stats group by match_id, team_id, team_name, period
"""

SIDES = """
select 'HOME' as location, match_id, match_date, start_timestamp, season_id, season_name, season_year, winner_code,
  home_team_id as team_id, home_team_name as team_name, away_team_id as opponent_id, home_score as gf, away_score as ga,
  home_score_period1 as h1f, away_score_period1 as h1a, 1 as won, 2 as lost from fact
union all
select 'AWAY', match_id, match_date, start_timestamp, season_id, season_name, season_year, winner_code,
  away_team_id, away_team_name, home_team_id, away_score, home_score, away_score_period1, home_score_period1, 2, 1 from fact
"""

# Sides with their statistics in hundredths, missing ones as NULL.
APPEARANCES = f"""
select s.*, {", ".join("t." + stat(m) for m in ALL_METRICS)}, o.stat_expectedgoals as xg_against
from sides s
left join (select * from team_match where period = 'ALL') t on t.match_id = s.match_id and t.team_id = s.team_id
left join (select * from team_match where period = 'ALL') o on o.match_id = s.match_id and o.team_id = s.opponent_id
"""

UPCOMING = """
select m.match_id, cust_id, match_slug, custom_id, start_timestamp, status_code, status_type, status_description,
  home_team_id, case when m.match_id % 23 <> 0 then home_team_name end as home_team_name,
  away_team_id, away_team_name, tournament_id, tournament_name, season_id, season_name,
  case when m.match_id % 17 <> 0 then season_year end as season_year,
  round_number + take as round_number, ('2024-03-0' || take)::date as extraction_date,
  ('2024-03-0' || take || ' 08:00:00')::timestamp as extracted_at, take
from matches m, (values (1), (2)) t(take)
where status_type = 'notstarted' and (take = 1 or m.match_id % 2 = 0)
"""

FIXTURES = """
select match_id, match_slug, ifnull(custom_id, 'N/A') as custom_id, start_timestamp, status_type, home_team_id, home_team_name,
  away_team_id, away_team_name, tournament_id, tournament_name, season_id, season_name,
  ifnull(season_year, year(start_timestamp)::varchar) as season_year, ifnull(round_number, 0) as round_number,
  extraction_date, extracted_at
from (select *, max(take) over (partition by match_id) as newest from upcoming)
where take = newest and home_team_name is not null
"""

RELATIONS = {
    "matches": MATCHES,
    "stats": STATS,
    "staged": STAGED,
    "fact": FACT,
    "team_stats": TEAM_STATS,
    "team_match": TEAM_MATCH,
    "sides": SIDES,
    "appearances": APPEARANCES,
    "upcoming": UPCOMING,
    "fixtures": FIXTURES,
}


def sql(body: str, **extra: str) -> str:
    """``body`` with the CTEs it needs, in dependency order."""
    relations = RELATIONS | extra
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, definition in relations.items():
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", text):
                visit(definition)
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{name} as materialized ({relations[name]})" for name in needed)
    return f"with {ctes}\n{body}"


def rnd(numerator: str, denominator: str, digits: int) -> str:
    """Quotient of whole numbers, rounded half away from zero without binary noise."""
    n, d, p = f"({numerator})::hugeint", f"({denominator})::hugeint", 10**digits
    return (
        f"(case when {d} = 0 then null else sign({n}) * ((2 * abs({n}) * {p} + {d}) // (2 * nullif({d}, 0)))::double / {p} end)::double"
    )


def mean(c: str, digits: int, where: str = "true", unit: int = 1) -> str:
    """Rounded average of the non-NULL values of ``c`` among rows with ``where``."""
    chosen = f"case when {where} then {c} end"
    return rnd(f"sum({chosen})", f"count({chosen}) * {unit}", digits)


def mean0(c: str, digits: int, unit: int = 100) -> str:
    return rnd(f"sum(ifnull({c}, 0))", f"count(*) * {unit}", digits)


def share(predicate: str, where: str = "true", digits: int = 1) -> str:
    """Percent of the rows with ``where`` that also satisfy ``predicate``."""
    return rnd(f"100 * count(*) filter (({predicate}) and ({where}))", f"count(*) filter ({where})", digits)


__all__ = ["AS_OF", "KEPT", "PLAYED", "RELATIONS", "mean", "mean0", "rnd", "share", "sql", "stat"]
