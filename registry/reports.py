"""Reports and diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sidewise.operators import reports as R
from sidewise.session import scratch_path
from sidewise.sources import files as S

from . import query
from .duck import rnd, sql
from .inputs import Inputs

MARK = "2000-06-01"


@query(
    "report_incremental",
    sql(
        f"""select 'All Data' as data_range, count(*) as total_matches, min(start_timestamp)::date as earliest_match, max(start_timestamp)::date as latest_match from staged
        union all select 'Newly Added', count(*), min(start_timestamp)::date, max(start_timestamp)::date from staged where start_timestamp > '{MARK}'"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return R.incremental_report(i.staged, MARK)


@query(
    "report_staging_summary",
    sql(
        """select 'Staging Matches' as table_name, count(*) as total_records, count(distinct match_id) as unique_matches, min(start_timestamp)::date as earliest_match,
        max(start_timestamp)::date as latest_match, count(distinct season_name) as seasons, count(distinct tournament_id) as tournaments from staged
        union all select 'Staging Stats', count(*), count(distinct match_id), null, null, count(distinct group_name), count(distinct statistic_key)
        from stats where match_id in (select match_id from staged)"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return R.staging_summary(i.staged, i.staged_stats)


_BY = "count(*) as total_records, count(distinct match_id) as matches, count(distinct statistic_key) as unique_stats from stats where match_id in (select match_id from staged)"


@query("report_stats_by_group", sql(f"select group_name, {_BY} group by group_name"))
def _(i: Inputs) -> DataFrame:
    return R.stats_by(i.staged_stats, "group_name")


@query("report_stats_by_period", sql(f"select period, {_BY} group by period"))
def _(i: Inputs) -> DataFrame:
    return R.stats_by(i.staged_stats, "period")


@query("report_stats_by_period_group", sql(f"select period, group_name, {_BY} group by period, group_name"))
def _(i: Inputs) -> DataFrame:
    return R.stats_by(i.staged_stats, "period", "group_name")


@query(
    "report_by_season",
    sql(
        """select season_name, count(*) as matches, count(distinct home_team_id) + count(distinct away_team_id) as unique_teams,
        min(start_timestamp)::date as first_match, max(start_timestamp)::date as last_match from staged group by season_name"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return R.by_season(i.staged)


@query(
    "report_missing_stats",
    sql(
        """select match_id, start_timestamp, status_type, status_description, home_team_name, away_team_name, home_score_current, away_score_current,
        status_type = 'finished' as should_have from matches where match_id not in (select match_id from stats)"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return R.missing_stats(i.matches, i.stats)


@query(
    "report_coverage",
    sql(
        """select count(*) as total_finished_matches, count(*) filter (has) as matches_with_stats, count(*) filter (not has) as missing_stats
        from (select match_id in (select match_id from stats) as has from matches where status_type = 'finished')"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return R.coverage(i.matches, i.stats)


_COVERED = "(select *, match_id in (select match_id from stats) as has from matches)"
_PCT = f"""count(*) as total_matches, count(*) filter (has) as matches_with_stats, {rnd("100 * count(*) filter (has)", "count(*)", 2)} as coverage_pct,
  min(season_name) as first_season, max(season_name) as last_season"""


@query("report_coverage_pct", sql(f"select {_PCT} from {_COVERED}"))
def _(i: Inputs) -> DataFrame:
    return R.coverage_pct(i.matches, i.stats)


@query("report_coverage_pct_by_tournament", sql(f"select tournament_name, country_name, {_PCT} from {_COVERED} group by 1, 2"))
def _(i: Inputs) -> DataFrame:
    return R.coverage_pct(i.matches, i.stats, "tournament_name", "country_name")


@query(
    "report_load_counts",
    """with r as (select event_id, user_id, event_type, event_id % 11 = 0 as bad from events),
      u as (select user_id, count(*) as n from r where not bad and event_type <> 'error' group by user_id),
      k as (select distinct user_id from events where ts < '2024-01-01 06:00:00')
    select 'loaded' as outcome, count(*) as records from u where user_id not in (select user_id from k)
    union all select 'duplicate', (sum(n) - count(*) filter (user_id not in (select user_id from k)))::bigint from u
    union all select 'out_of_scope', count(*) from r where not bad and event_type = 'error'
    union all select 'malformed', count(*) from r where bad""",
)
def _(i: Inputs) -> DataFrame:
    """Every eleventh line of the scanned files is cut off."""
    path = scratch_path(i.spark, "load-lines")
    text = F.to_json(F.struct("user_id", "event_type", "seconds"))
    broken = F.concat(F.lit('{"broken":'), F.col("event_id").cast("string"))
    i.events.select(F.when(F.col("event_id") % 11 == 0, broken).otherwise(text).alias("value")).write.text(path)
    records = S.scan_ndjson(i.spark, path, "user_id bigint, event_type string, seconds bigint")
    known = i.events.where("ts < timestamp_ntz'2024-01-01 06:00:00'")
    return R.load_counts(records, known, "user_id", F.col("event_type") != "error", [F.asc("seconds")])


# --- completeness ------------------------------------------------------------

# Months stand for seasons: small enough that some of them are incomplete.
_SEASON = "(year(o_orderdate) * 100 + month(o_orderdate))::int"
_YEAR_LABEL = "substr(season_id::varchar, 3, 2) || '/' || lpad(((season_id // 100 + 1) % 100)::varchar, 2, '0')"
_MANIFESTS = f"""(select {_SEASON} as season_id, strftime(o_orderdate, '%Y-%m-%d') as date, count(*) filter (o_orderstatus = 'F') as record_count
  from orders group by 1, 2)"""
_KNOWN = f"(select season_id, 'Season ' || season_id as season_name, {_YEAR_LABEL} as season_year from (select distinct {_SEASON} as season_id from orders) where season_id % 100 <> 12)"
_COMPLETENESS = f"""select coalesce(k.season_id, m.season_id) as season_id, ifnull(season_name, 'Unknown') as season_name, ifnull(season_year, 'Unknown') as season_year,
  case when ifnull(found, 0) = 0 then 'MISSING' when found * 100 >= 95 * 306 then 'COMPLETE' when found * 100 >= 75 * 306 then 'SUBSTANTIAL'
    when found * 100 >= 25 * 306 then 'PARTIAL' else 'MINIMAL' end as status,
  m.season_id is not null as in_bronze, k.season_id is not null as in_api, ifnull(found, 0)::bigint as matches_found, 306 as expected_matches,
  {rnd("100 * ifnull(found, 0)", "306", 1)} as completion_percentage, ifnull(dates, 0) as unique_dates, ifnull(batches, 0) as total_batches, earliest, latest,
  ifnull(empties, 0) as quality_issues
  from {_KNOWN} k full join (select season_id, sum(record_count) as found, count(*) as batches, count(distinct date) as dates, min(date) as earliest,
    max(date) as latest, count(*) filter (record_count = 0) as empties from {_MANIFESTS} group by season_id) m on k.season_id = m.season_id"""


def _completeness(i: Inputs) -> DataFrame:
    day = F.col("o_orderdate")
    orders = i.table("orders").withColumns(
        {"season_id": (F.year(day) * 100 + F.month(day)).cast("int"), "date": F.date_format(day, "yyyy-MM-dd")}
    )
    manifests = orders.groupBy("season_id", "date").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("record_count")
    )
    text = F.col("season_id").cast("string")
    following = F.lpad(((F.floor(F.col("season_id") / 100) + 1) % 100).cast("string"), 2, "0")
    known = orders.select("season_id").distinct().where(F.col("season_id") % 100 != 12).select(
        "season_id", F.concat(F.lit("Season "), text).alias("season_name"),
        F.concat(F.substring(text, 3, 2), F.lit("/"), following).alias("season_year"),
    )
    return R.season_completeness(manifests, known, expected=306)


@query("season_completeness", _COMPLETENESS)
def _(i: Inputs) -> DataFrame:
    return _completeness(i)


def _priority_sql(recent: str) -> str:
    return f"""select season_id, season_year, status, case status when 'MISSING' then 'missing' else 'incomplete' end as kind, recent as is_recent,
      case when not recent then 'none' when status = 'MISSING' then 'high' else 'medium' end as priority
      from (select *, {recent} as recent from ({_COMPLETENESS})) where status <> 'COMPLETE'"""


@query("backfill_priority_text", _priority_sql("season_year >= '2020'"))
def _(i: Inputs) -> DataFrame:
    return R.backfill_priority(_completeness(i), as_text=True)


@query("backfill_priority", _priority_sql("ifnull(try_cast(left(season_year, 2) as int) <= 70 and try_cast(left(season_year, 2) as int) >= 20, false)"))
def _(i: Inputs) -> DataFrame:
    return R.backfill_priority(_completeness(i))


@query(
    "backfill_next_steps",
    f"""select season_id, kind, step from (select season_id, kind, (row_number() over (partition by kind order by season_id))::int as step
      from ({_priority_sql("false")})) where step <= case kind when 'missing' then 5 else 3 end""",
)
def _(i: Inputs) -> DataFrame:
    return R.next_steps(R.backfill_priority(_completeness(i))).select("season_id", "kind", "step")




@query(
    "fetch_outcomes",
    """select count(*) filter (event_id % 6 = 0) as successful, count(*) filter (event_id % 6 >= 3) as failed,
      count(*) filter (event_id % 6 in (1, 2)) as skipped, count(*) as total from events""",
)
def _(i: Inputs) -> DataFrame:
    names = ["success", "skipped", "not_found", "save_failed", "fetch_failed", "error"]
    status = F.get(F.array(*[F.lit(n) for n in names]), (F.col("event_id") % 6).cast("int"))
    return R.fetch_outcomes(i.events.select(status.alias("status")))


@query(
    "file_coverage",
    f"""with f as (select distinct year(o_orderdate)::int as season, l_orderkey as k from lineitem join orders on o_orderkey = l_orderkey)
    select season, count(*) filter (o) as expected, count(*) filter (f) as found, count(*) filter (o and not f) as missing, count(*) filter (f and not o) as extra,
      ifnull({rnd("100 * count(*) filter (f)", "count(*) filter (o)", 1)}, 0) as coverage_pct
    from (select year(o_orderdate)::int as season, true as o, o_orderkey in (select k from f) as f from orders) group by season""",
)
def _(i: Inputs) -> DataFrame:
    from sidewise.operators.joins import set_compare

    orders = i.table("orders").select(F.year("o_orderdate").alias("season"), F.col("o_orderkey").alias("k"))
    files = orders.join(i.table("lineitem").select(F.col("l_orderkey").alias("k")), "k", "left_semi")
    return set_compare(orders, files, "k", ["season"])


@query(
    "day_listing",
    sql(
        """select match_id, '00:00' as time, home_team_name as home, away_team_name as away, status_type as status,
        '(' || home_score_current || '-' || away_score_current || ')' as score, ifnull(round_number::varchar, 'N/A') as round, 'N/A' as venue
        from matches where start_timestamp::date = '1998-03-14'"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return R.day_listing(i.match_records, "1998-03-14")


@query("list_dates", "select distinct strftime(ts, '%Y-%m-%d') as date from events")
def _(i: Inputs) -> DataFrame:
    return R.list_dates(i.events)


@query(
    "league_catalog",
    """select s_nationkey as country, s_name as league, place, place || case place when 1 then 'st Division' else 'nd Division' end as division
    from (select *, (row_number() over (partition by s_nationkey order by s_suppkey))::int as place from supplier) where place <= 2""",
)
def _(i: Inputs) -> DataFrame:
    leagues = i.table("supplier").select(F.col("s_nationkey").alias("country"), F.col("s_name").alias("league"), "s_suppkey")
    return R.league_catalog(leagues, "country", "s_suppkey").drop("s_suppkey")


@query(
    "leagues_by_country",
    """select s_nationkey as country, string_agg(s_name, ' | ' order by place) as leagues
    from (select *, row_number() over (partition by s_nationkey order by s_suppkey) as place from supplier) where place <= 2 group by s_nationkey""",
)
def _(i: Inputs) -> DataFrame:
    leagues = i.table("supplier").select(F.col("s_nationkey").alias("country"), F.col("s_name").alias("league"), "s_suppkey")
    lists = R.leagues_by_country(R.league_catalog(leagues, "country", "s_suppkey"), "country", "league")
    return lists.select("country", F.array_join("leagues", " | ").alias("leagues"))


@query(
    "report_group_count_histogram",
    sql(
        f"""select groups_count, count(*) as matches_count, {rnd("100 * count(*)", "sum(count(*)) over ()", 2)} as percentage
        from (select match_id, count(distinct group_name) as groups_count from stats group by match_id) group by groups_count"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return R.group_count_histogram(i.stats)


@query(
    "report_period_coverage_type",
    sql(
        f"""select coverage_type, count(*) as matches_count, {rnd("100 * count(*)", "sum(count(*)) over ()", 2)} as percentage
        from (select case when count(distinct period) = 3 then 'Complete (ALL + 1ST + 2ND)' when max(period) = 'ALL' and min(period) = 'ALL' then 'Only ALL period' else 'Partial' end as coverage_type
          from stats group by match_id) group by coverage_type"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return R.period_coverage_type(i.stats)


@query(
    "report_stat_popularity",
    sql(
        f"""select statistic_name, group_name, statistics_type, value_type, count(distinct match_id) as matches_count,
        {rnd("100 * count(distinct match_id)", "(select count(distinct match_id) from stats)", 2)} as percentage from stats group by 1, 2, 3, 4"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return R.stat_popularity(i.stats)


@query(
    "report_season_depth",
    sql(
        f"""select season_name, count(*) as complete_matches, min(n) as min_stats, max(n) as max_stats, {rnd("sum(n)", "count(*)", 0)}::bigint as avg_stats
        from matches join (select match_id, count(*) as n from stats where period = 'ALL' group by match_id) using (match_id) group by season_name"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return R.season_depth(i.matches, i.stats)


@query(
    "report_id_overlap",
    """select 'nation_key' as id_column, count(*) filter (a and not b) as only_first, count(*) filter (b and not a) as only_second, count(*) filter (a and b) as common
      from (select n_nationkey in (select c_nationkey from customer) as a, n_nationkey in (select s_nationkey from supplier) as b from nation)
    union all select 'id', count(*) filter (a and not b), count(*) filter (b and not a), count(*) filter (a and b)
      from (select coalesce(c_custkey, s_suppkey) as id, c_custkey is not null as a, s_suppkey is not null as b
        from (select c_custkey from customer) full join supplier on c_custkey = s_suppkey)""",
)
def _(i: Inputs) -> DataFrame:
    customers = i.table("customer").select(F.col("c_nationkey").alias("nation_key"), F.col("c_custkey").alias("id"))
    suppliers = i.table("supplier").select(F.col("s_nationkey").alias("nation_key"), F.col("s_suppkey").alias("id"))
    return R.id_overlap(customers, suppliers, ["nation_key", "id"])


@query(
    "table_columns",
    """with named(ordinal_position, column_name, data_type) as (values (1, 'event_id', 'bigint'), (2, 'ts', 'timestamp_ntz'), (3, 'user_id', 'bigint'),
        (4, 'event_type', 'string'), (5, 'value', 'double'), (6, 'props', 'string')),
    counts as (
        select count(event_id) as event_id, count(ts) as ts, count(user_id) as user_id, count(event_type) as event_type, count(value) as value, count(props) as props
        from events
    )
    select ordinal_position, column_name, data_type, true as is_nullable, non_null
    from named join (unpivot counts on columns(*) into name column_name value non_null) using (column_name)""",
)
def _(i: Inputs) -> DataFrame:
    """Schema of the events table joined with how many values each column holds."""
    events = i.table("events")
    filled = events.agg(*[F.count(c).alias(c) for c in events.columns])
    counts = filled.unpivot([], list(events.columns), "column_name", "non_null")
    return R.table_columns(events).join(counts, "column_name")


@query(
    "fixture_summary",
    sql(
        """select count(*) as total_matches, count(distinct match_id) as unique_matches, min(start_timestamp) as earliest_match, max(start_timestamp) as latest_match,
        count(distinct tournament_id) as tournaments, count(distinct season_id) as seasons from upcoming"""
    ),
)
def _(i: Inputs) -> DataFrame:
    from sidewise.operators.documents import unnest_upcoming

    return R.fixture_summary(unnest_upcoming(i.upcoming_documents))
