"""Semi-structured extraction and validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sidewise import schemas
from sidewise.operators import documents as D
from sidewise.operators.pivot import metric_columns

from . import query
from .duck import sql
from .inputs import Inputs
from .marts import MATCH_DOCUMENT_COLUMNS


@query("flatten_match_json", sql(f"select {MATCH_DOCUMENT_COLUMNS} from matches"))
def _(i: Inputs) -> DataFrame:
    return D.flatten_match_json(i.match_documents, strict=False)


_ITEMS = """select match_id, period, group_name, statistic_name, statistic_key, (home_cents / 100)::double as home_value_numeric,
  (away_cents / 100)::double as away_value_numeric, case when home_cents > away_cents then 1 else 2 end as compare_code,
  statistics_type, value_type, 1 as render_type from stats"""


@query("explode_stats_3level", sql(_ITEMS))
def _(i: Inputs) -> DataFrame:
    return D.explode_stats(i.stats_documents).drop("home_value_text", "away_value_text")


@query(
    "coalesce_envelope",
    sql("select match_id, match_id % 2 = 0 as wrapped, count(distinct period) as periods from stats group by match_id"),
)
def _(i: Inputs) -> DataFrame:
    wrapped = F.from_json("data", schemas.STATS_WRAPPED)["statistics"]["statistics"].isNotNull()
    periods = F.size(D.stat_periods(F.col("data"))).cast("bigint")
    return i.stats_documents.select("match_id", wrapped.alias("wrapped"), periods.alias("periods"))


@query(
    "unnest_events",
    sql("select match_id, round_number, home_team_name, season_year, extraction_date, extracted_at, season_id as season_id_metadata from upcoming"),
)
def _(i: Inputs) -> DataFrame:
    return D.unnest_upcoming(i.upcoming_documents).select(
        "match_id", "round_number", "home_team_name", "season_year", "extraction_date", "extracted_at", "season_id_metadata"
    )


@query(
    "combine_pages",
    sql(
        """select cust_id, take as page, match_id, max(take) over (partition by cust_id) as pages_last,
        max(take) over (partition by cust_id) = 1 as has_next_page from upcoming"""
    ),
)
def _(i: Inputs) -> DataFrame:
    pages = i.upcoming_documents.select(
        "cust_id", F.col("take").alias("page"), F.from_json("data", schemas.UPCOMING).alias("doc")
    ).select("cust_id", "page", F.col("doc.data.events").alias("events"), F.col("doc.data.hasNextPage").cast("boolean").alias("more"))
    # A customer has one list per season and extraction; the last extraction decides.
    per_page = D.combine_pages(pages, "cust_id", "page", "events", "more")
    last = pages.groupBy("cust_id").agg(F.max("page").alias("pages_last"))
    return per_page.join(last, "cust_id").select(
        "cust_id", "page", F.col("event.id").cast("bigint").alias("match_id"), "pages_last", "has_next_page"
    )


@query("extract_path_nested_list", sql("select match_id, 'ALL' as kind, statistic_key from stats where period = 'ALL'"))
def _(i: Inputs) -> DataFrame:
    """``groups[*].statisticsItems`` of the full-match period."""
    periods = i.stats_documents.select("match_id", F.explode(D.stat_periods(F.col("data"))).alias("doc"))
    whole = periods.where(F.col("doc.period") == "ALL")
    items = D.extract_path(whole, "doc", "groups[*].statisticsItems", ["match_id"])
    return items.select("match_id", F.lit("ALL").alias("kind"), F.col("item.key").alias("statistic_key"))


@query("extract_path_nested_object", sql("select match_id, tournament_id + 200 as unique_id from matches"))
def _(i: Inputs) -> DataFrame:
    docs = i.match_documents.select("match_id", F.from_json("data", schemas.MATCH).alias("doc"))
    items = D.extract_path(docs, "doc", "tournament.uniqueTournament", ["match_id"])
    return items.select("match_id", F.col("item.id").cast("int").alias("unique_id"))


@query("extract_path_list", sql("select match_id, period from stats group by all"))
def _(i: Inputs) -> DataFrame:
    docs = i.stats_documents.select("match_id", F.struct(D.stat_periods(F.col("data")).alias("statistics")).alias("doc"))
    return D.extract_path(docs, "doc", "statistics", ["match_id"]).select("match_id", "item.period")


def broken_documents(i: Inputs) -> DataFrame:
    """Match documents of which some lack or spoil a required field."""
    key = F.col("match_id") % 20
    data = (
        F.when(key == 0, F.regexp_replace("data", '"homeTeam"', '"home"'))
        .when(key == 1, F.regexp_replace("data", '^\\{"id":\\d+', '{"id":"abc"'))
        .when(key == 2, F.regexp_replace("data", '"status":\\{', '"status":3,"s":{'))
        .when(key == 3, F.regexp_replace("data", '"startTimestamp":\\d+,', ""))
        .otherwise(F.col("data"))
    )
    return i.match_documents.select("match_id", data.alias("data"))


@query(
    "validate_records",
    sql(
        """select match_id, case match_id % 20 when 0 then 'homeTeam: missing' when 1 then 'id: not a bigint' when 2 then 'status: not an object' end as errors
        from matches where match_id % 20 in (0, 1, 2)"""
    ),
)
def _(i: Inputs) -> DataFrame:
    _, rejected = D.validate_records(broken_documents(i), "data", D.MATCH_REQUIRED, D.MATCH_OPTIONAL)
    return rejected.select("match_id", F.array_join("errors", "; ").alias("errors"))


@query(
    "validate_records_summary",
    sql(
        """select count(*) filter (match_id % 20 not in (0, 1, 2)) as total_count, count(*) filter (match_id % 20 in (0, 1, 2)) as skipped_count,
        'success' as validation_status from matches"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return D.validation_summary(broken_documents(i), "data", D.MATCH_REQUIRED, D.MATCH_OPTIONAL)


@query("validate_tournaments", "select r_regionkey from region where r_regionkey % 2 = 0")
def _(i: Inputs) -> DataFrame:
    name = F.when(F.col("r_regionkey") % 2 == 0, F.col("r_name"))
    doc = F.struct(F.col("r_regionkey").alias("id"), name.alias("name"), F.lower("r_name").alias("slug"), F.struct("r_name").alias("category"))
    docs = i.table("region").select("r_regionkey", F.to_json(doc).alias("data"))
    valid, _ = D.validate_records(docs, "data", D.TOURNAMENT_REQUIRED)
    return valid.select("r_regionkey")


@query(
    "json_shape_profile",
    """select '$.k' as path, 'BIGINT' as type, count(*) as rows, null::int as max_size from events""",
)
def _(i: Inputs) -> DataFrame:
    return D.json_shape_profile(i.table("events"), "props", depth=1)


@query("json_shape_profile_matches")
def _(i: Inputs) -> DataFrame:
    return D.json_shape_profile(i.match_documents, "data")


@query(
    "metric_columns",
    sql(
        """select statistic_key as raw_key, 'stat_' || lower(statistic_key) as column_name from stats group by statistic_key"""
    ),
)
def _(i: Inputs) -> DataFrame:
    columns = metric_columns(i.stats, "statistic_key", "statistic_name")
    found = i.stats.select(F.col("statistic_key").alias("raw_key")).distinct()
    named = F.create_map(*[F.lit(x) for pair in columns for x in pair])
    return found.select("raw_key", F.element_at(named, F.col("raw_key")).alias("column_name"))
