"""Aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sidewise.functions import measures as M
from sidewise.operators.pivot import agg_pivot, name_columns
from sidewise.plans import appearances as A
from sidewise.plans import silver

from . import query
from .duck import mean, mean0, rnd, share, sql, stat
from .inputs import Inputs


@query(
    "agg_basic",
    f"""select l_returnflag, l_linestatus, sum(l_quantity::bigint)::bigint as total, {mean("l_quantity::bigint", 2)} as average, count(*) as n,
      min(l_shipdate) as first_ship, max(l_shipdate) as last_ship from lineitem group by all""",
)
def _(i: Inputs) -> DataFrame:
    quantity = F.col("l_quantity").cast("bigint")
    return i.table("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(quantity).alias("total"), M.mean(quantity, 2).alias("average"), F.count(F.lit(1)).alias("n"),
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
    )


@query(
    "agg_conditional_rate",
    sql(f"select season_id, {share('winner_code = 1')} as home_win_pct, {share('home_score > 0 and away_score > 0')} as btts_pct from fact group by season_id"),
)
def _(i: Inputs) -> DataFrame:
    both = (F.col("home_score") > 0) & (F.col("away_score") > 0)
    return i.fact.groupBy("season_id").agg(M.rate(F.col("winner_code") == 1).alias("home_win_pct"), M.rate(both).alias("btts_pct"))


@query(
    "agg_threshold_rates",
    sql("select season_id, " + ", ".join(f"{share(f'home_score + away_score >= {n}')} as total_over_{n - 1}5_pct" for n in (1, 2, 3, 4)) + " from fact group by season_id"),
)
def _(i: Inputs) -> DataFrame:
    rates = M.over_rates(F.col("home_score") + F.col("away_score"), "total")
    return i.fact.groupBy("season_id").agg(*[c.alias(n) for n, c in rates.items()])


@query("agg_count_distinct", "select l_returnflag, count(distinct l_orderkey) as orders, count(distinct l_partkey) as parts from lineitem group by 1")
def _(i: Inputs) -> DataFrame:
    return i.table("lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey").alias("parts")
    )


_ACC, _ALL = f"sum(ifnull({stat('accuratePasses')}, 0))", f"sum(ifnull({stat('passes')}, 0))"


@query("agg_ratio_of_sums", sql(f"select team_id, {rnd(f'100 * {_ACC}', _ALL, 1)} as pass_accuracy_pct from appearances group by team_id"))
def _(i: Inputs) -> DataFrame:
    pct = M.ratio_of_sums("stat_accuratepasses", "stat_passes")
    return i.sides(["accuratePasses", "passes"]).groupBy("team_id").agg(pct.alias("pass_accuracy_pct"))


@query(
    "agg_avg_nullif_zero",
    sql(f"select team_id, {mean(f'nullif({stat('ballPossession')}, 0)', 1, unit=100)} as avg_possession_pct from appearances group by team_id"),
)
def _(i: Inputs) -> DataFrame:
    return i.sides(["ballPossession"]).groupBy("team_id").agg(M.mean_nonzero("stat_ballpossession").alias("avg_possession_pct"))


_DIFF = f"100 * sum(gf) - sum(ifnull({stat('expectedGoals')}, 0))"


@query(
    "agg_diff_of_sums",
    sql(f"select team_id, {rnd(_DIFF, '100', 2)} as xg_difference, {rnd(_DIFF, '100 * count(distinct match_id)', 2)} as xg_diff_per_game from appearances group by team_id"),
)
def _(i: Inputs) -> DataFrame:
    gap = F.sum("goals_for").cast(M.SUM_TYPE) - F.sum(M.zero(A.XG))
    return i.sides(A.XG_METRICS).groupBy("team_id").agg(
        F.round(gap, 2).alias("xg_difference"), F.round(M.quotient(gap, F.count_distinct("match_id")), 2).alias("xg_diff_per_game")
    )


@query(
    "agg_avg_of_avgs",
    sql(
        f"""select season_id, {rnd("sum(round(rate * 100)::bigint)", "100 * count(*)", 2)} as avg_goals_per_game_per_team
        from (select season_id, team_id, {mean("gf", 2)} as rate from sides group by season_id, team_id) group by season_id"""
    ),
)
def _(i: Inputs) -> DataFrame:
    teams = A.team_sides(i.fact).groupBy("season_id", "team_id").agg(M.mean("goals_for", 2).alias("goals_per_game"))
    return teams.groupBy("season_id").agg(M.mean_filled("goals_per_game", 2).alias("avg_goals_per_game_per_team"))


@query(
    "agg_pivot",
    sql(
        "select match_id, period, "
        + ", ".join(f"max(home_cents) filter (statistic_key = '{m}') / 100.0::double as {stat(m)}" for m in A.DISCIPLINE_METRICS)
        + " from stats where statistic_key in (" + ", ".join(f"'{m}'" for m in A.DISCIPLINE_METRICS) + ") group by match_id, period"
    ),
)
def _(i: Inputs) -> DataFrame:
    columns = name_columns(A.DISCIPLINE_METRICS)
    rows = i.stats.where(F.col("statistic_key").isin(A.DISCIPLINE_METRICS))
    return agg_pivot(rows, ["match_id", "period"], "statistic_key", {"": "home_value_numeric"}, columns)


@query(
    "agg_string_ordered",
    """select o_custkey, string_agg(status, ',' order by r) as latest from (
      select o_custkey, nullif(o_orderstatus, 'P') as status, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as r from orders)
    where r <= 5 group by o_custkey""",
)
def _(i: Inputs) -> DataFrame:
    """Ordered concatenation of the five newest values; NULL values are skipped."""
    from sidewise.operators.ranking import last_n

    orders = i.table("orders").withColumn("status", F.nullif(F.col("o_orderstatus"), F.lit("P")))
    newest = last_n(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 5)
    newest.createOrReplaceTempView("sidewise_newest_orders")
    return i.spark.sql(
        "select o_custkey, listagg(status, ',') within group (order by rank) as latest from sidewise_newest_orders group by o_custkey"
    )


@query("agg_representative", sql("select team_id, max(team_name) as team_name, min(season_name) as first_season from sides group by team_id"))
def _(i: Inputs) -> DataFrame:
    return A.team_sides(i.fact).groupBy("team_id").agg(F.max("team_name").alias("team_name"), F.min("season_name").alias("first_season"))


@query("agg_having", "select o_custkey, count(*) as n from orders group by o_custkey having count(*) > 10")
def _(i: Inputs) -> DataFrame:
    return i.table("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 10)


@query(
    "agg_multi_level",
    sql(
        """select match_id, period, count(*) as in_period, (sum(count(*)) over (partition by match_id))::bigint as in_match from stats group by match_id, period"""
    ),
)
def _(i: Inputs) -> DataFrame:
    per_period = i.stats.groupBy("match_id", "period").agg(F.count(F.lit(1)).alias("in_period"))
    per_match = per_period.groupBy("match_id").agg(F.sum("in_period").alias("in_match"))
    return per_period.join(per_match, "match_id")


@query(
    "agg_global",
    """select count(*) as total, count(distinct user_id) as users, min(ts) as first_ts, max(ts) as last_ts, count(distinct event_type) as kinds from events""",
)
def _(i: Inputs) -> DataFrame:
    return i.events.agg(
        F.count(F.lit(1)).alias("total"), F.count_distinct("user_id").alias("users"), F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"), F.count_distinct("event_type").alias("kinds"),
    )


@query(
    "agg_zero_filled_mean",
    sql(f"select team_id, {mean0(stat('cornerKicks'), 2)} as corners_per_game from appearances group by team_id"),
)
def _(i: Inputs) -> DataFrame:
    return i.sides(["cornerKicks"]).groupBy("team_id").agg(M.mean_filled("stat_cornerkicks", 2).alias("corners_per_game"))


@query("match_stats_pivot", sql("select match_id, max(case when statistic_key = 'fouls' then home_cents end) / 100.0::double as home_stat_fouls, max(case when statistic_key = 'fouls' then away_cents end) / 100.0::double as away_stat_fouls from stats where period = '1ST' and statistic_key = 'fouls' group by match_id"))
def _(i: Inputs) -> DataFrame:
    return silver.match_stats(i.side_values, name_columns(["fouls"]), period="1ST", listed_only=True)
