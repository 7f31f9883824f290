"""Joins, windows, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sidewise.operators import joins as J
from sidewise.operators import ranking as R
from sidewise.operators.sides import side_union, unordered_pair
from sidewise.plans import appearances as A
from sidewise.plans import bronze, gold

from . import query
from .duck import KEPT, PLAYED, rnd, sql, stat
from .inputs import Inputs

# --- joins -------------------------------------------------------------------


@query(
    "join_inner_using",
    sql("select match_id, period, statistic_key, season_id from stats join kept using (match_id)", **KEPT),
)
def _(i: Inputs) -> DataFrame:
    return i.stats.join(i.staged.drop("tournament_id"), "match_id").select("match_id", "period", "statistic_key", "season_id")


@query("join_left_lookup", sql("select s.match_id, period, statistic_key, season_id from stats s left join matches m on m.match_id = s.match_id"))
def _(i: Inputs) -> DataFrame:
    lookup = bronze.season_of_match(i.matches)
    return i.stats.join(lookup, "match_id", "left").select("match_id", "period", "statistic_key", "season_id")


@query(
    "join_left_aggregates",
    sql(
        """select match_id, period, statistic_key, count(*) over (partition by match_id) as in_match,
        count(*) over (partition by match_id, period) as in_period from stats"""
    ),
)
def _(i: Inputs) -> DataFrame:
    """Counts at both levels come from one pre-aggregation, then join back."""
    per_period = i.stats.groupBy("match_id", "period").agg(F.count(F.lit(1)).alias("in_period"))
    per_match = per_period.groupBy("match_id").agg(F.sum("in_period").alias("in_match"))
    rows = i.stats.select("match_id", "period", "statistic_key")
    return rows.join(per_period, ["match_id", "period"], "left").join(per_match, "match_id", "left")


_XG = stat("expectedGoals")


@query(
    "join_left_const_pred",
    sql(
        f"""select f.match_id, ifnull(h.{_XG}, 0) / 100.0::double as home_xg, ifnull(a.{_XG}, 0) / 100.0::double as away_xg from fact f
        left join team_match h on h.match_id = f.match_id and h.team_id = f.home_team_id and h.period = 'ALL'
        left join team_match a on a.match_id = f.match_id and a.team_id = f.away_team_id and a.period = 'ALL'"""
    ),
)
def _(i: Inputs) -> DataFrame:
    whole = i.team_match(A.XG_METRICS).where(F.col("period") == "ALL")
    out = i.fact.select("match_id", "home_team_id", "away_team_id")
    for side in ("home", "away"):
        xg = whole.select("match_id", F.col("team_id").alias(f"{side}_team_id"), F.col(A.XG).alias(f"{side}_xg"))
        out = out.join(xg, ["match_id", f"{side}_team_id"], "left")
    return out.select("match_id", *[F.coalesce(f"{s}_xg", F.lit(0)).alias(f"{s}_xg") for s in ("home", "away")])


@query(
    "join_opponent",
    sql(
        f"""select t.match_id, t.team_id, t.{_XG} / 100.0::double as xg, o.{_XG} / 100.0::double as xg_against from team_match t
        left join team_match o on o.match_id = t.match_id and o.team_id <> t.team_id and o.period = 'ALL' where t.period = 'ALL'"""
    ),
)
def _(i: Inputs) -> DataFrame:
    whole = i.team_match(A.XG_METRICS).where(F.col("period") == "ALL").select("match_id", "team_id", F.col(A.XG).alias("xg"))
    return J.opponent_join(whole, "match_id", "team_id", "xg", "xg_against")


@query(
    "join_zero_fill",
    sql(
        f"""select s.match_id, s.team_id, s.season_id, s.gf as goals_for,
        ifnull(t.{stat("fouls")}, 0) / 100.0::double as fouls, ifnull(t.{stat("offsides")}, 0) / 100.0::double as offsides
        from sides s left join team_match t on t.match_id = s.match_id and t.team_id = s.team_id and t.period = 'ALL'"""
    ),
)
def _(i: Inputs) -> DataFrame:
    whole = i.team_match(["fouls", "offsides"]).where(F.col("period") == "ALL")
    stats = whole.select("match_id", "team_id", F.col("stat_fouls").alias("fouls"), F.col("stat_offsides").alias("offsides"))
    base = A.team_sides(i.fact).select("match_id", "team_id", "season_id", "goals_for")
    return J.zero_fill_join(base, stats, ["match_id", "team_id"])


@query(
    "join_star_summary",
    sql(
        f"""select o.team_id, o.season_id, count(*) as matches_played, sum(gf)::bigint as goals_for,
        (sum(ifnull({stat("fouls")}, 0)) / 100.0)::double as total_fouls, (sum(ifnull({stat("passes")}, 0)) / 100.0)::double as total_passes
        from appearances o group by o.team_id, o.season_id"""
    ),
)
def _(i: Inputs) -> DataFrame:
    """The marts joined on (team, season), as separate relations."""
    keys = gold.TEAM_SEASON
    overview = gold.mart_team_overview(A.team_sides(i.fact)).select(*keys, "matches_played", "goals_for")
    discipline = gold.mart_team_discipline(i.fact, i.totals(A.DISCIPLINE_METRICS)).select(*keys, "total_fouls")
    possession = gold.mart_team_possession(i.fact, i.totals(A.POSSESSION_METRICS)).select(*keys, "total_passes")
    return overview.join(discipline, keys, "left").join(possession, keys, "left")


@query(
    "join_form_windows",
    sql(
        """select team_id, season_id, sum(case when r <= 5 then gf end)::bigint as goals_last_5, sum(case when r <= 10 then gf end)::bigint as goals_last_10,
        sum(case when r <= 15 then gf end)::bigint as goals_last_15, sum(gf)::bigint as goals_last_20
        from (select *, row_number() over (partition by team_id, season_id order by start_timestamp desc, match_id desc) as r from sides)
        where r <= 20 group by team_id, season_id"""
    ),
)
def _(i: Inputs) -> DataFrame:
    """One ranked relation and one conditional aggregation in place of a join per window."""
    newest = [F.desc("start_timestamp"), F.desc("match_id")]
    recent = R.last_n(A.team_sides(i.fact), gold.TEAM_SEASON, newest, 20)
    sums = [F.sum(F.when(F.col("rank") <= n, F.col("goals_for"))).alias(f"goals_last_{n}") for n in gold.FORM_WINDOWS]
    return recent.groupBy(*gold.TEAM_SEASON).agg(*sums)


@query(
    "join_league_blocks",
    sql(
        """select season_id, count(*) as total_matches, sum(home_score + away_score)::bigint as goals, t.teams
        from fact join (select season_id, count(distinct team_id) as teams from sides group by season_id) t using (season_id) group by season_id, t.teams"""
    ),
)
def _(i: Inputs) -> DataFrame:
    outcomes = gold.league_outcomes(i.fact).select("season_id", "total_matches", F.col("total_goals_in_season").alias("goals"))
    teams = A.team_sides(i.fact).groupBy("season_id").agg(F.count_distinct("team_id").alias("teams"))
    return outcomes.join(teams, "season_id", "left")


@query(
    "join_dual_alias",
    """select o_orderkey, h.n_name as home_name, a.n_name as away_name from orders join customer on c_custkey = o_custkey
    left join nation h on h.n_nationkey = c_nationkey left join nation a on a.n_nationkey = (o_custkey * 7 + o_orderkey) % 25""",
)
def _(i: Inputs) -> DataFrame:
    ids = i.table("orders").join(i.table("customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.col("c_nationkey").alias("home"), ((F.col("o_custkey") * 7 + F.col("o_orderkey")) % 25).cast("int").alias("away")
    )
    nation = i.table("nation")
    for side in ("home", "away"):
        names = nation.select(F.col("n_nationkey").alias(side), F.col("n_name").alias(f"{side}_name"))
        ids = ids.join(names, side, "left")
    return ids.select("o_orderkey", "home_name", "away_name")


_NO_LINES = "select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem)"


def _order_keys(i: Inputs) -> DataFrame:
    return i.table("orders").select("o_orderkey")


def _line_keys(i: Inputs) -> DataFrame:
    return i.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))


@query("anti_not_in", _NO_LINES)
def _(i: Inputs) -> DataFrame:
    return J.missing_from(_order_keys(i), _line_keys(i), ["o_orderkey"])


@query("anti_not_exists", sql("select match_id, status_type from matches m where not exists (select 1 from stats s where s.match_id = m.match_id)"))
def _(i: Inputs) -> DataFrame:
    return J.missing_from(i.matches, i.stats, ["match_id"]).select("match_id", "status_type")


@query("anti_left_null", "select l.doc_id from documents l left join labels r on l.doc_id = r.doc_id where r.doc_id is null")
def _(i: Inputs) -> DataFrame:
    return J.missing_from(i.table("documents").select("doc_id"), i.table("labels"), ["doc_id"])


@query("anti_list", sql("select match_id, start_timestamp from matches where status_type = 'finished' and match_id not in (select match_id from stats)"))
def _(i: Inputs) -> DataFrame:
    finished = i.matches.where(F.col("status_type") == "finished").select("match_id", "start_timestamp")
    return J.missing_from(finished, i.stats, ["match_id"]).orderBy(F.desc("start_timestamp"))


@query("semi_exists", "select o_orderkey from orders where exists (select 1 from lineitem where l_orderkey = o_orderkey)")
def _(i: Inputs) -> DataFrame:
    return J.found_in(_order_keys(i), _line_keys(i), ["o_orderkey"])


@query("semi_in", sql(f"select match_id, period, statistic_key from stats semi join (select match_id from kept where {PLAYED}) f using (match_id)", **KEPT))
def _(i: Inputs) -> DataFrame:
    # Both lie in buckets of match_id; the ids are hashed there and not sent to the driver.
    return J.found_in(i.stats, i.fact.hint("shuffle_hash"), ["match_id"]).select("match_id", "period", "statistic_key")


@query("scalar_subquery_first", "select o_custkey, o_orderkey, (select min(o_orderdate) from orders x where x.o_custkey = o.o_custkey) as first_date from orders o")
def _(i: Inputs) -> DataFrame:
    orders = i.table("orders")
    first = J.first_per_key(orders.select("o_custkey", F.col("o_orderdate").alias("first_date")), "o_custkey", "first_date")
    return orders.select("o_custkey", "o_orderkey").join(first, "o_custkey", "left")


@query(
    "scalar_subquery_global",
    "select o_orderkey, o_orderdate from orders where o_orderdate > (select max(o_orderdate) - interval 30 day from orders)",
)
def _(i: Inputs) -> DataFrame:
    orders = i.table("orders").select("o_orderkey", "o_orderdate")
    limit = orders.agg((F.max("o_orderdate") - F.expr("interval 30 days")).alias("d"))
    return orders.where(F.col("o_orderdate") > limit.scalar())


@query("lateral_unnest", "select vec_id, pos - 1 as pos, v::double as v from (select vec_id, unnest(embedding) as v, generate_subscripts(embedding, 1)::int as pos from embeddings)")
def _(i: Inputs) -> DataFrame:
    return i.table("embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "v")).withColumn("v", F.col("v").cast("double"))


@query(
    "set_compare",
    f"""with a as (select o_orderpriority, o_orderkey as k from orders), b as (select distinct o_orderpriority, l_orderkey as k
      from lineitem join orders on l_orderkey = o_orderkey)
    select o_orderpriority, count(*) filter (in_a) as expected, count(*) filter (in_b) as found, count(*) filter (in_a and not in_b) as missing,
      count(*) filter (in_b and not in_a) as extra, ifnull({rnd("100 * count(*) filter (in_b)", "count(*) filter (in_a)", 1)}, 0) as coverage_pct
    from (select coalesce(a.o_orderpriority, b.o_orderpriority) as o_orderpriority, a.k is not null as in_a, b.k is not null as in_b
      from a full join b on a.o_orderpriority = b.o_orderpriority and a.k = b.k) group by o_orderpriority""",
)
def _(i: Inputs) -> DataFrame:
    orders = i.table("orders").select("o_orderpriority", "o_orderkey")
    found = orders.join(_line_keys(i), "o_orderkey", "left_semi")
    return J.set_compare(orders, found, "o_orderkey", ["o_orderpriority"])


@query(
    "keys_union_compare",
    """select coalesce(d.doc_id, l.doc_id) as doc_id, d.doc_id is not null as in_api, l.doc_id is not null as in_bronze
    from (select distinct doc_id from documents) d full join (select distinct doc_id from labels) l on d.doc_id = l.doc_id""",
)
def _(i: Inputs) -> DataFrame:
    known = i.table("documents")
    return J.key_presence(known, i.table("labels"), ["doc_id"], "in_api", "in_bronze")


# --- windows -----------------------------------------------------------------


def _ranked(partition: str, n: int) -> str:
    return f"""select match_id, team_id, season_id, location, r as rank from (
      select *, (row_number() over (partition by {partition} order by start_timestamp desc, match_id desc))::int as r from sides) where r <= {n}"""


def _last(i: Inputs, keys: list[str], n: int) -> DataFrame:
    newest = [F.desc("start_timestamp"), F.desc("match_id")]
    return R.last_n(A.team_sides(i.fact), keys, newest, n).select("match_id", "team_id", "season_id", "location", "rank")


@query("win_last_n", sql(_ranked("team_id, season_id", 10)))
def _(i: Inputs) -> DataFrame:
    return _last(i, ["team_id", "season_id"], 10)


@query("win_last_n_by_location", sql(_ranked("team_id, season_id, location", 5)))
def _(i: Inputs) -> DataFrame:
    return _last(i, ["team_id", "season_id", "location"], 5)


@query(
    "win_pair_last_n",
    sql(
        """select match_id, t1 as team_id_1, t2 as team_id_2, r as rank from (
        select match_id, least(home_team_id, away_team_id) as t1, greatest(home_team_id, away_team_id) as t2,
          (row_number() over (partition by least(home_team_id, away_team_id), greatest(home_team_id, away_team_id) order by match_date desc, match_id desc))::int as r
        from fact) where r <= 5"""
    ),
)
def _(i: Inputs) -> DataFrame:
    pairs = unordered_pair(i.fact, "home_team_id", "away_team_id", "team_id_1", "team_id_2")
    ranked = R.last_n(pairs, ["team_id_1", "team_id_2"], [F.desc("match_date"), F.desc("match_id")], 5)
    return ranked.select("match_id", "team_id_1", "team_id_2", "rank")


@query("win_dedupe_latest", "select user_id, max(event_id) as event_id from (select *, max(ts) over (partition by user_id) as newest from events) where ts = newest group by user_id")
def _(i: Inputs) -> DataFrame:
    return R.dedupe_latest(i.events, ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id")


@query(
    "win_order_in_group",
    "select event_id, user_id, row_number() over (partition by user_id order by ts, event_id) as position from events",
)
def _(i: Inputs) -> DataFrame:
    day = F.date_trunc("day", "ts")
    return R.numbered(i.events.select("event_id", "user_id", "ts"), ["user_id"], "ts", day, ["event_id"]).select(
        "event_id", "user_id", F.col("position").cast("bigint").alias("position")
    )


@query("win_count_in_group", "select event_id, user_id, count(*) over (partition by user_id) as in_group from events")
def _(i: Inputs) -> DataFrame:
    """A pre-aggregated count joined back, so no group is gathered in one task."""
    counts = i.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("in_group"))
    return i.events.select("event_id", "user_id").join(counts, "user_id")


# --- sort and limit ----------------------------------------------------------


@query("sort_multi_key", sql("select season_year, team_id, total_points from (select season_year, team_id, sum(case winner_code when won then 3 when 3 then 1 else 0 end)::bigint as total_points from sides group by all)"))
def _(i: Inputs) -> DataFrame:
    overview = gold.mart_team_overview(A.team_sides(i.fact))
    return overview.select("season_year", "team_id", "total_points").orderBy(
        F.desc_nulls_first("season_year"), F.desc_nulls_first("total_points"), "team_id"
    )


@query("latest_one", "select event_id, ts from events order by ts desc, event_id desc limit 1")
def _(i: Inputs) -> DataFrame:
    return i.events.select("event_id", "ts").orderBy(F.desc("ts"), F.desc("event_id")).limit(1)


@query(
    "latest_group_one",
    "select left(o_orderdate::varchar, 10) as last_date, year(o_orderdate)::int as season_id, count(*) as total from orders group by 1, 2 order by 1 desc, 2 desc limit 1",
)
def _(i: Inputs) -> DataFrame:
    day = F.left(F.col("o_orderdate").cast("string"), F.lit(10)).alias("last_date")
    days = i.table("orders").groupBy(day, F.year("o_orderdate").alias("season_id")).agg(F.count(F.lit(1)).alias("total"))
    return days.orderBy(F.desc("last_date"), F.desc("season_id")).limit(1)


@query("top_n", "select l_orderkey as match_id, count(*) as stats_count from lineitem group by 1 order by 1 desc limit 10")
def _(i: Inputs) -> DataFrame:
    counts = i.table("lineitem").groupBy(F.col("l_orderkey").alias("match_id")).agg(F.count(F.lit(1)).alias("stats_count"))
    return counts.orderBy(F.desc("match_id")).limit(10)


# --- set operations ----------------------------------------------------------


@query("side_union", sql("select location, match_id, team_id, gf, ga from sides"))
def _(i: Inputs) -> DataFrame:
    return side_union(
        i.fact, ["match_id"],
        {"team_id": "home_team_id", "gf": "home_score", "ga": "away_score"},
        {"team_id": "away_team_id", "gf": "away_score", "ga": "home_score"},
    )


@query("union_distinct", "select c_nationkey as nation_key from customer union select s_nationkey from supplier")
def _(i: Inputs) -> DataFrame:
    customers = i.table("customer").select(F.col("c_nationkey").alias("nation_key"))
    return customers.union(i.table("supplier").select("s_nationkey")).distinct()


@query("select_distinct", "select distinct p_brand, p_type from part")
def _(i: Inputs) -> DataFrame:
    return i.table("part").select("p_brand", "p_type").distinct()


@query(
    "report_union",
    """select 'orders' as source, count(*) as n, min(o_orderdate)::date as first_day, max(o_orderdate)::date as last_day from orders
    union all select 'lineitem', count(*), min(l_shipdate)::date, max(l_shipdate)::date from lineitem""",
)
def _(i: Inputs) -> DataFrame:
    def summary(name: str, day: str) -> DataFrame:
        d = F.to_date(day)
        return i.table(name).agg(F.count(F.lit(1)).alias("n"), F.min(d).alias("first_day"), F.max(d).alias("last_day"))

    return J.tagged_union({"orders": summary("orders", "o_orderdate"), "lineitem": summary("lineitem", "l_shipdate")}, "source")


@query(
    "check_union",
    """select 'large' as rule, o_orderkey from orders where o_totalprice > 490000 union all select 'small', o_orderkey from orders where o_totalprice < 2000""",
)
def _(i: Inputs) -> DataFrame:
    orders, price = i.table("orders"), F.col("o_totalprice")
    return J.tagged_union(
        {"large": orders.where(price > 490000).select("o_orderkey"), "small": orders.where(price < 2000).select("o_orderkey")}, "rule"
    )


@query("key_difference", "select doc_id from documents except select doc_id from labels")
def _(i: Inputs) -> DataFrame:
    return i.table("documents").select("doc_id").subtract(i.table("labels").select("doc_id"))


@query("key_union", "select o_custkey as k from orders union select c_custkey from customer")
def _(i: Inputs) -> DataFrame:
    return i.table("orders").select(F.col("o_custkey").alias("k")).union(i.table("customer").select("c_custkey")).distinct()


