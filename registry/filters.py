"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sidewise.operators import filters as P
from sidewise.plans.silver import UPCOMING_REQUIRED

from . import query
from .duck import AS_OF, sql
from .inputs import Inputs
from .scalars import _SECONDS, undated

_DATED = f"(select *, case when s > 0 then make_timestamp(s * 1000000)::date end as day from (select *, {_SECONDS} as s from events))"


@query("filter_date_range", f"select event_id from {_DATED} where day between '2024-01-05' and '2024-01-20'")
def _(i: Inputs) -> DataFrame:
    return P.filter_date_range(undated(i), "start_seconds", "2024-01-05", "2024-01-20").select("event_id")


@query("filter_date_range_open", f"select event_id from {_DATED} where day >= '2024-01-05'")
def _(i: Inputs) -> DataFrame:
    return P.filter_date_range(undated(i), "start_seconds", start="2024-01-05").select("event_id")


@query("filter_date_range_none", "select event_id from events")
def _(i: Inputs) -> DataFrame:
    return P.filter_date_range(undated(i), "start_seconds").select("event_id")


@query("filter_newer_than", f"select event_id from {_DATED} where day > '2024-01-15'")
def _(i: Inputs) -> DataFrame:
    return P.filter_newer_than(undated(i), "start_seconds", "2024-01-15").select("event_id")


@query("scan_after_partition", "select event_id, strftime(ts, '%Y-%m-%d') as date from events where ts::date > '2024-01-20' and event_id % 9 <> 0")
def _(i: Inputs) -> DataFrame:
    day = F.when(F.col("event_id") % 9 == 0, "unknown").otherwise(F.col("date"))
    return P.after_partition(i.events.withColumn("date", day), "date", "2024-01-20").select("event_id", "date")


@query(
    "scan_latest_extraction_date",
    sql("select cust_id, take, max(extraction_date) as extraction_date from upcoming group by cust_id, take"),
)
def _(i: Inputs) -> DataFrame:
    from sidewise.sources.files import path_partition

    day = path_partition(F.col("file_path"), "date").try_cast("date")
    return i.upcoming_documents.select("cust_id", "take", day.alias("extraction_date")).groupBy("cust_id", "take").agg(
        F.max("extraction_date").alias("extraction_date")
    )


@query("filter_scope", sql("select match_id from matches where tournament_id = 2 and season_id = 1998"))
def _(i: Inputs) -> DataFrame:
    records = i.match_records
    unique = F.col("tournament.uniqueTournament.id").cast("int")
    scoped = P.filter_scope(records, unique, F.col("season.id").cast("int"), "id", 202, 1998)
    return scoped.select(F.col("id").cast("bigint").alias("match_id"))


# Pages of one month each, newest first; a row of the month before belongs to the next page.
_PAGES = """(select o_orderkey, epoch(o_orderdate)::bigint as s, o_orderdate::date as day,
  ((2001 - year(o_orderdate)) * 12 + 12 - month(o_orderdate) - 4)::int as page from orders)"""


def paged(i: Inputs) -> DataFrame:
    day = F.col("o_orderdate")
    page = (2001 - F.year(day)) * 12 + 12 - F.month(day) - 4
    return i.table("orders").select("o_orderkey", F.unix_timestamp(day).alias("seconds"), page.alias("page"))


@query(
    "scan_cutoff_page",
    f"""with pages as (select page, count(*) as n, count(*) filter (day <= '2000-03-10') as old from {_PAGES} where page >= 0 group by page),
    stop as (select min(page) as last from pages where old * 10 > n * 8),
    gap as (select min(p) as first from (select 0 as p union all select page + 1 from pages) where p not in (select page from pages))
    select o_orderkey, page from {_PAGES}, stop, gap where day > '2000-03-10' and page >= 0 and page < first and page <= ifnull(last, page)""",
)
def _(i: Inputs) -> DataFrame:
    return P.scan_cutoff_page(paged(i), "page", "seconds", "2000-03-10").select("o_orderkey", "page")


@query(
    "scan_cutoff_page_stops",
    f"""select page, count(*) as page_rows, count(*) filter (day <= '2000-03-10') as old_rows, count(*) filter (day <= '2000-03-10') * 10 > count(*) * 8 as stops
    from {_PAGES} group by page""",
)
def _(i: Inputs) -> DataFrame:
    return P.page_stops(paged(i), "page", "seconds", "2000-03-10")


@query("stage_filter", sql("select match_id from staged"))
def _(i: Inputs) -> DataFrame:
    return P.stage_filter(i.matches, i.stats).select("match_id")


@query(
    "finished_filter",
    sql(
        """select match_id from matches where status_type = 'finished' and ifnull(status_description, 'Postponed')
        not in ('Canceled', 'Cancelled', 'Postponed', 'Abandoned')"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return P.finished_filter(i.matches).select("match_id")


@query("require_non_null", sql("select match_id, extraction_date from upcoming where home_team_name is not null"))
def _(i: Inputs) -> DataFrame:
    from sidewise.operators.documents import unnest_upcoming

    rows = unnest_upcoming(i.upcoming_documents).withColumnsRenamed(
        {"tournament_id_metadata": "tournament_id", "season_id_metadata": "season_id"}
    )
    return P.require_non_null(rows, UPCOMING_REQUIRED).select("match_id", "extraction_date")


@query("recent_window", sql(f"select match_id, match_date from fact where match_date >= date '{AS_OF}' - 90"))
def _(i: Inputs) -> DataFrame:
    return P.recent_window(i.fact, "match_date", AS_OF).select("match_id", "match_date")


@query("ingested_today", "select event_id from events where ts::date = '2024-01-12'")
def _(i: Inputs) -> DataFrame:
    return P.ingested_on(i.events, "ts", "2024-01-12").select("event_id")


@query("recent_created", "select event_id, event_type as batch_id from events where event_type = 'click'")
def _(i: Inputs) -> DataFrame:
    """The current batch, by its id instead of a five-minute window."""
    batches = i.events.select("event_id", F.col("event_type").alias("batch_id"))
    return batches.where(F.col("batch_id") == "click")


@query(
    "predicates",
    """select p_partkey, p_type ilike 'econ%' as is_economy, p_brand in ('Brand#1', 'Brand#2') as chosen, p_size between 5 and 15 as mid_size,
      p_name <> 'small ring' as other_name from part where p_retailprice is not null""",
)
def _(i: Inputs) -> DataFrame:
    return i.table("part").where(F.col("p_retailprice").isNotNull()).select(
        "p_partkey", F.col("p_type").ilike("econ%").alias("is_economy"), F.col("p_brand").isin("Brand#1", "Brand#2").alias("chosen"),
        F.col("p_size").between(5, 15).alias("mid_size"), (F.col("p_name") != "small ring").alias("other_name"),
    )


@query(
    "validate_params",
    """select event_id, case when user_id % 5 <= 0 then 'tournament_id must be positive, got ' || (user_id % 5)
              when event_id % 3 - 1 <= 0 then 'max_pages must be positive, got ' || (event_id % 3 - 1) end as problem from events""",
)
def _(i: Inputs) -> DataFrame:
    """Every event as a request; some ask for tournament 0 or for no pages."""
    pages = F.col("event_id") % 3 - 1
    return i.events.select("event_id", P.param_problem("tournament_id", "season_id", pages).alias("problem"))
