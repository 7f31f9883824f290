"""Quality checks; inputs with planted faults show that each one reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sidewise.operators import quality as Q
from sidewise.plans import appearances as A
from sidewise.plans import gold
from sidewise.session import scratch_path

from . import ORACLES, QUERIES, marts, query  # noqa: F401 - the models are registered before their checks
from .duck import AS_OF, KEPT, rnd, sql, stat
from .inputs import Inputs


@query(
    "dq_unique",
    "select l_orderkey, l_linenumber, count(*) as n_records from lineitem group by 1, 2 having count(*) > 1",
)
def _(i: Inputs) -> DataFrame:
    return Q.unique(i.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_not_null", sql("select match_id from matches where custom_id is null"))
def _(i: Inputs) -> DataFrame:
    return Q.not_null(i.matches, "custom_id").select("match_id")


@query("dq_relationships", "select l_orderkey as from_field from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P')")
def _(i: Inputs) -> DataFrame:
    return Q.relationships(i.table("lineitem"), "l_orderkey", i.table("orders").where("o_orderstatus <> 'P'"), "o_orderkey")


@query("dq_accepted_values", "select o_orderstatus as value_field, count(*) as n_records from orders where o_orderstatus not in ('F', 'O') group by 1")
def _(i: Inputs) -> DataFrame:
    return Q.accepted_values(i.table("orders"), "o_orderstatus", ["F", "O"])


#: The tests of the models: per model and column whether it is a key, must be filled, has a parent or a list of values.
MODEL_RULES: dict[str, list[Q.Rule]] = {
    "fact_match": [
        Q.Rule("match_id", unique=True, filled=True), Q.Rule("match_date", filled=True),
        Q.Rule("home_team_id", filled=True, parent=("dim_teams", "team_id")), Q.Rule("away_team_id", filled=True, parent=("dim_teams", "team_id")),
        Q.Rule("season_id", filled=True, parent=("dim_seasons", "season_id")), Q.Rule("tournament_id", filled=True, parent=("dim_tournaments", "tournament_id")),
        Q.Rule("status_type", values=("finished",)), Q.Rule("winner_code", values=(1, 2, 3)), Q.Rule("has_statistics", values=(0, 1)),
    ],
    "fact_team_match": [
        Q.Rule("match_id", filled=True, parent=("fact_match", "match_id")), Q.Rule("team_id", filled=True, parent=("dim_teams", "team_id")),
        Q.Rule("period", filled=True, values=("ALL", "1ST", "2ND")),
    ],
    "fact_season_team": [
        Q.Rule("season_id", filled=True, parent=("dim_seasons", "season_id")), Q.Rule("team_id", filled=True, parent=("dim_teams", "team_id")),
        Q.Rule("matches_played", filled=True),
    ],
    "dim_teams": [Q.Rule("team_id", unique=True, filled=True), Q.Rule("team_name", filled=True)],
    "dim_seasons": [Q.Rule("season_id", unique=True, filled=True), Q.Rule("season_year", filled=True)],
    "dim_tournaments": [Q.Rule("tournament_id", unique=True, filled=True)],
    "dim_period": [Q.Rule("period_code", unique=True, filled=True, values=("ALL", "1ST", "2ND"))],
    "dim_date": [Q.Rule("date_day", unique=True, filled=True)],
    "mart_team_overview": [
        Q.Rule("team_id", filled=True, parent=("dim_teams", "team_id")), Q.Rule("season_id", filled=True), Q.Rule("matches_played", filled=True),
        Q.Rule("total_points", filled=True),
    ],
    "mart_team_attack": [Q.Rule("team_id", filled=True), Q.Rule("season_id", filled=True), Q.Rule("total_goals", filled=True)],
    "mart_team_defense": [Q.Rule("team_id", filled=True), Q.Rule("season_id", filled=True)],
    "mart_team_form": [Q.Rule("team_id", filled=True), Q.Rule("last_5_results", filled=True)],
}

#: Faults planted into the models, as (column, rows it concerns, value there), and the rows that appear twice; both engines read them.
FAULTS = {
    "fact_match": [("home_team_id", "match_id % 17 = 3", "null"), ("away_team_id", "match_id % 19 = 4", "away_team_id + 500"),
                   ("season_id", "match_id % 23 = 5", "season_id - 1000"), ("winner_code", "match_id % 29 = 6", "7"), ("status_type", "match_id % 31 = 2", "'open'")],
    "fact_team_match": [("team_id", "match_id % 13 = 1", "null"), ("period", "match_id % 37 = 8", "'OT'"), ("match_id", "match_id % 41 = 9", "-match_id")],
    "fact_season_team": [("team_id", "team_id = 4", "904"), ("matches_played", "team_id = 5", "null")],
    "dim_teams": [("team_name", "team_id % 6 = 2", "null")],
    "dim_seasons": [("season_year", "season_id = 1999", "null")],
    "dim_period": [("period_code", "period_code = '2ND'", "'HT'")],
    "mart_team_overview": [("total_points", "team_id = 6", "null"), ("season_id", "team_id = 7", "null")],
    "mart_team_attack": [("total_goals", "team_id % 5 = 1", "null")],
    "mart_team_form": [("last_5_results", "team_id = 8", "null"), ("team_id", "team_id = 9", "null")],
}
TWICE = {"fact_match": "match_id % 11 = 7", "dim_teams": "team_id % 7 = 3", "dim_tournaments": "tournament_id = 1", "dim_date": "year = 1998 and month = 3"}


def _model_sql(model: str) -> str:
    base = f"select * from ({ORACLES[model]})"
    if model in TWICE:
        base = f"select m.* from ({base}) m, (values (0), (1)) v(again) where again = 0 or {TWICE[model]}"
    cases = [f"case when {where} then {value} else {column} end as {column}" for column, where, value in FAULTS.get(model, [])]
    return f"select * replace ({', '.join(cases)}) from ({base})" if cases else base


def _rule_sql(model: str, rule: Q.Rule) -> list[str]:
    c, said = rule.column, lambda test, n: f"select '{model}' as model, '{rule.column}' as column_name, '{test}' as test, {n} as violations"
    out = []
    if rule.unique:
        out.append(f"{said('unique', 'count(*)')} from (select {c} from {model}_x where {c} is not null group by {c} having count(*) > 1)")
    if rule.filled:
        out.append(f"{said('not_null', 'count(*)')} from {model}_x where {c} is null")
    if rule.parent:
        parent, field = rule.parent
        out.append(f"{said('relationships', 'count(*)')} from {model}_x where {c} is not null and {c} not in (select {field} from {parent}_x where {field} is not null)")
    if rule.values:
        out.append(f"{said('accepted_values', 'count(distinct ' + c + ')')} from {model}_x where {c} not in ({', '.join(map(repr, rule.values))})")
    return out


def _model_checks_sql() -> str:
    models = ",\n".join(f"{m}_x as materialized ({_model_sql(m)})" for m in MODEL_RULES)
    return f"with {models}\n" + "\nunion all ".join(part for m, rules in MODEL_RULES.items() for r in rules for part in _rule_sql(m, r))


def _planted_model(i: Inputs, model: str) -> DataFrame:
    df = QUERIES[model](i.spark, i.sf_dir)
    if model in TWICE:
        df = df.unionByName(df.where(TWICE[model]))
    # All conditions see the values before any fault.
    return df.withColumns({c: F.expr(f"case when {where} then {value} else {c} end") for c, where, value in FAULTS.get(model, [])})


@query("dq_model_columns", _model_checks_sql())
def _(i: Inputs) -> DataFrame:
    """All tests of the twelve models over stored tables with planted faults."""
    stored = {}
    for model, rules in MODEL_RULES.items():
        # Columns that rules or relations name; the other ones are not written.
        path = scratch_path(i.spark, f"checked-{model}")
        _planted_model(i, model).select(*[r.column for r in rules]).write.parquet(path)
        stored[model] = i.spark.read.parquet(path)
    return Q.model_checks(stored, MODEL_RULES)


# A gold table in which teams 3 and 7 are off by one.
def _planted(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column) + F.when(F.col("team_id").isin(3, 7), 1).otherwise(0))


@query(
    "dq_goal_aggregation",
    sql(
        """select season_id, team_id, max(team_name) as team_name, (sum(gf) + 1)::bigint as goals_in_gold, sum(gf)::bigint as total_goals_silver, 1::bigint as difference
        from sides where team_id in (3, 7) group by season_id, team_id"""
    ),
)
def _(i: Inputs) -> DataFrame:
    attack = gold.mart_team_attack(i.fact, i.totals(A.ATTACK_METRICS))
    return Q.goal_aggregation(_planted(attack, "total_goals"), i.fact)


@query("dq_goal_aggregation_clean", sql("select count(*) as teams, 0::bigint as violations from (select distinct season_id, team_id from sides)"))
def _(i: Inputs) -> DataFrame:
    attack = gold.mart_team_attack(i.fact, i.totals(A.ATTACK_METRICS))
    wrong = Q.goal_aggregation(attack, i.fact).agg(F.count(F.lit(1)).alias("violations"))
    return attack.agg(F.count(F.lit(1)).alias("teams")).withColumn("violations", wrong.scalar())


_PTS = "sum(case winner_code when won then 3 when 3 then 1 else 0 end)"


@query(
    "dq_points",
    sql(
        f"""select season_id, team_id, max(team_name) as team_name, ({_PTS} + 1)::bigint as points_in_mart, {_PTS}::bigint as calc_points, 1::bigint as difference
        from sides where team_id in (3, 7) group by season_id, team_id"""
    ),
)
def _(i: Inputs) -> DataFrame:
    overview = gold.mart_team_overview(A.team_sides(i.fact))
    return Q.point_calculation(_planted(overview, "total_points"), i.fact)


@query(
    "dq_has_statistics",
    sql(
        """select match_id, season_name, home_team_name, away_team_name, match_date, 0::bigint as teams_with_stats
        from fact where match_id not in (select match_id from team_match where period = 'ALL')"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return Q.without_statistics(i.fact, i.team_match(A.XG_METRICS))


@query("dq_match_id_orphan", sql("select match_id from team_match where match_id not in (select match_id from fact)"))
def _(i: Inputs) -> DataFrame:
    return Q.orphans(i.team_match(A.XG_METRICS), i.fact, "match_id", ["match_id"])


@query("dq_orphan_stats", sql("select match_id, period from stats anti join kept using (match_id)", **KEPT))
def _(i: Inputs) -> DataFrame:
    return Q.orphans(i.stats, i.staged, "match_id", ["match_id", "period"])


# Rows of team 3 appear twice.
_TWICE = "(select * from team_match union all select * from team_match where team_id = 3)"


def _twice(i: Inputs) -> DataFrame:
    copies = F.when(F.col("team_id") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return i.team_match(A.XG_METRICS).withColumn("copy", F.explode(copies))


@query("dq_period_coherence", sql(f"select match_id, period, count(*) as rows_cnt from {_TWICE} group by 1, 2 having count(*) > 2"))
def _(i: Inputs) -> DataFrame:
    return Q.period_coherence(_twice(i))


@query("dq_duplicate_team_match", sql(f"select match_id, team_id, period, count(*) as duplicate_count from {_TWICE} group by 1, 2, 3 having count(*) > 1"))
def _(i: Inputs) -> DataFrame:
    return Q.duplicate_team_match(_twice(i))


@query("dq_excluded_status", sql("select match_id, status_type, status_description from matches where status_type = 'postponed'"))
def _(i: Inputs) -> DataFrame:
    return Q.excluded_status(i.matches)


_HALVES = """select match_id, home_team_id as team_id, home_score_period1 as goals_1st, home_score_period2 as goals_2nd, home_score as goals_all from fact
  union all select match_id, away_team_id, away_score_period1, away_score_period2, away_score from fact"""


@query(
    "dq_score_consistency",
    sql(
        f"""select h.* from ({_HALVES}) h join (select match_id, team_id from team_match where period = 'ALL') t on t.match_id = h.match_id and t.team_id = h.team_id
        where ifnull(goals_1st, 0) + ifnull(goals_2nd, 0) <> goals_all"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return Q.score_consistency(i.team_match(A.XG_METRICS), i.fact)


_POSS, _ACC, _ALL, _XG = (stat(m) for m in ("ballPossession", "accuratePasses", "passes", "expectedGoals"))


@query(
    "dq_stat_range",
    sql(
        f"""select match_id, team_id, period, 'ballpossession' as stat_name, {_POSS} / 100.0::double as stat_value from team_match where {_POSS} not between 0 and 10000
        union all select match_id, team_id, period, 'accuratepasses_pct', ({_ACC} * 100.0::double) / {_ALL} from team_match where {_ALL} > 0 and {_ACC} > {_ALL}
        union all select match_id, team_id, period, 'expectedgoals', {_XG} / 100.0::double from team_match where {_XG} < 0"""
    ).replace(f"({_ACC} * 100.0::double) / {_ALL}", rnd(f"100 * {_ACC}", _ALL, 6)),
)
def _(i: Inputs) -> DataFrame:
    found = Q.stat_range(i.team_match(["ballPossession", "accuratePasses", "passes", "expectedGoals"]))
    return found.withColumn("stat_value", F.round(F.col("stat_value").cast("decimal(28,10)"), 6))


@query("dq_two_teams", sql("select t.match_id, 1::bigint as team_count from team_match t join staged s on s.match_id = t.match_id where period = 'ALL' and team_id = home_team_id and away_team_id = 3"))
def _(i: Inputs) -> DataFrame:
    """Team 3 loses its away rows."""
    rows = i.team_match(A.XG_METRICS).join(i.staged.select("match_id", "home_team_id"), "match_id")
    return Q.two_teams(rows.where((F.col("team_id") != 3) | (F.col("team_id") == F.col("home_team_id"))))


@query(
    "dq_match_dates",
    sql("select match_id, match_date, season_year, start_timestamp from fact where year(match_date) < 2000 or match_date > date '2001-01-01' + 7"),
)
def _(i: Inputs) -> DataFrame:
    return Q.match_dates(i.fact, "2001-01-01")


@query("dq_match_dates_as_of_end", sql("select match_id from fact where year(match_date) < 2000"))
def _(i: Inputs) -> DataFrame:
    return Q.match_dates(i.fact, AS_OF).select("match_id")


@query(
    "gate_staging",
    sql(
        """select 'NULL in key columns' as check_name, 0::bigint as violations union all
        select 'Excluded statuses', count(*) from matches where status_type = 'postponed' union all
        select 'Orphan statistics', count(distinct match_id) from stats where match_id not in (select match_id from matches) union all
        select 'Duplicate match_ids', 0"""
    ),
)
def _(i: Inputs) -> DataFrame:
    """Unstaged matches and all statistics, so that two rules report."""
    return Q.staging_violations(i.matches, i.stats)


@query(
    "gate_staging_clean",
    """select unnest(['NULL in key columns', 'Excluded statuses', 'Orphan statistics', 'Duplicate match_ids']) as check_name, 0::bigint as violations""",
)
def _(i: Inputs) -> DataFrame:
    return Q.staging_violations(i.staged, i.staged_stats)


@query(
    "gate_bronze_present",
    sql(
        """select 'stored' as relations, case when (select count(*) from matches) > 0 and (select count(*) from stats) > 0 then 'passed' else 'empty' end as outcome
        union all select 'emptied', 'table bronze_none is empty' from (select count(*) as n from matches where match_id < 0) where n = 0
        union all select 'absent', 'table bronze_absent does not exist'"""
    ),
)
def _(i: Inputs) -> DataFrame:
    """The stored relations, one without rows, and one that does not exist."""
    spark = i.spark
    i.matches.createOrReplaceTempView("bronze_matches")
    i.stats.createOrReplaceTempView("bronze_stats")
    i.matches.where("match_id < 0").createOrReplaceTempView("bronze_none")
    outcomes = []
    for case, last in (("stored", "bronze_stats"), ("emptied", "bronze_none"), ("absent", "bronze_absent")):
        try:
            Q.gate_present(spark, ["bronze_matches", last])
            outcomes.append((case, "passed"))
        except Q.QualityError as error:
            outcomes.append((case, str(error)))
    return spark.createDataFrame(outcomes, "relations string, outcome string")
