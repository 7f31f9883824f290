"""Scalar rules and key builders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sidewise.functions import cleaning, keys
from sidewise.operators.documents import compare_sides

from . import query
from .duck import rnd, sql
from .inputs import Inputs


@query(
    "normalize_period",
    """with spelled as (
      select event_id, case event_id % 9 when 0 then 'Full Time' when 1 then '1H' when 2 then 'second half' when 3 then 'period1'
        when 4 then 'FT' when 5 then '2' when 6 then null when 7 then 'overall' else event_type end as period from events)
    select event_id, period, case
      when list_contains(['1st', 'first half', '1h', 'period1', '1'], lower(period)) then '1ST'
      when list_contains(['2nd', 'second half', '2h', 'period2', '2'], lower(period)) then '2ND' else 'ALL' end as normal from spelled""",
)
def _(i: Inputs) -> DataFrame:
    names = ["Full Time", "1H", "second half", "period1", "FT", "2", None, "overall"]
    kind = F.col("event_id") % 9
    spelled = F.when(kind < 8, F.get(F.array(*[F.lit(n) for n in names]), kind.cast("int"))).otherwise(F.col("event_type"))
    return i.events.select("event_id", spelled.alias("period")).withColumn("normal", cleaning.normalize_period("period"))


@query(
    "metric_key",
    """select event_id, case when event_id % 3 = 0 then event_type when event_id % 3 = 1 or event_type is null then event_type || '-name'
      else event_type || '-name' end as metric from events""",
)
def _(i: Inputs) -> DataFrame:
    remainder = F.col("event_id") % 3
    key = F.when(remainder == 0, F.col("event_type")).when(remainder == 1, "")
    return i.events.select("event_id", cleaning.metric_key(key, F.concat("event_type", F.lit("-name"))).alias("metric"))


@query(
    "clean_metric_key",
    """select o_orderkey, case when o_orderkey % 10 = 0 then 'unknown'
      else lower(regexp_replace(o_orderpriority || ' / ' || o_orderstatus, '[^[:alnum:]]+', '_', 'g')) end as clean_key from orders""",
)
def _(i: Inputs) -> DataFrame:
    raw = F.when(F.col("o_orderkey") % 20 == 0, "").when(
        F.col("o_orderkey") % 10 != 0, F.concat("o_orderpriority", F.lit(" / "), "o_orderstatus")
    )
    return i.table("orders").select("o_orderkey", cleaning.clean_metric_key(raw).alias("clean_key"))


@query(
    "surrogate_key",
    """select o_orderkey, md5(o_orderkey || '-' || ifnull(case when o_orderkey % 4 <> 0 then o_orderstatus end, '_dbt_utils_surrogate_key_null_')
      || '-' || o_custkey) as row_key from orders""",
)
def _(i: Inputs) -> DataFrame:
    status = F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderstatus"))
    return i.table("orders").select("o_orderkey", keys.surrogate_key("o_orderkey", status, "o_custkey").alias("row_key"))


_SECONDS = "case when event_id % 10 = 0 then 0 when event_id % 10 = 1 then null else floor(epoch(ts))::bigint end"


def undated(i: Inputs) -> DataFrame:
    """Events in which some epoch seconds are 0 or missing."""
    last = F.col("event_id") % 10
    seconds = F.when(last == 0, 0).when(last != 1, F.col("seconds"))
    return i.events.withColumn("start_seconds", seconds)


@query(
    "date_bucket",
    f"""select event_id, case when s is null or s = 0 then 'unknown' else strftime(make_timestamp(s * 1000000), '%Y-%m-%d') end as day
    from (select event_id, {_SECONDS} as s from events)""",
)
def _(i: Inputs) -> DataFrame:
    return undated(i).select("event_id", cleaning.date_bucket("start_seconds").alias("day"))


@query(
    "date_bucket_counts",
    f"""select case when s is null or s = 0 then 'unknown' else strftime(make_timestamp(s * 1000000), '%Y-%m-%d') end as day, count(*) as n
    from (select {_SECONDS} as s from events) group by 1""",
)
def _(i: Inputs) -> DataFrame:
    return undated(i).groupBy(cleaning.date_bucket("start_seconds").alias("day")).count().withColumnRenamed("count", "n")


@query(
    "parse_extracted_at",
    """select event_id, case when event_id % 5 <> 0 then date_trunc('second', ts) end as extracted_at from events""",
)
def _(i: Inputs) -> DataFrame:
    shape = F.when(F.col("event_id") % 2 == 0, "yyyy-MM-dd'T'HH:mm:ss'Z'").otherwise("yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    even, odd = "yyyy-MM-dd'T'HH:mm:ss'.000000Z'", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
    text = (
        F.when(F.col("event_id") % 5 == 0, "no timestamp")
        .when(F.col("event_id") % 2 == 0, F.date_format("ts", even))
        .otherwise(F.date_format("ts", odd))
    )
    return i.events.select("event_id", cleaning.parse_extracted_at(text).alias("extracted_at"))


@query(
    "fill_second_half",
    sql(
        """select match_id, ifnull(home_score_period2, home_score_current - home_score_period1) as home_second,
        ifnull(away_score_period2, away_score_current - away_score_period1) as away_second from matches"""
    ),
)
def _(i: Inputs) -> DataFrame:
    def second(s: str):
        return cleaning.fill_second_half(f"{s}_score_current", f"{s}_score_period1", f"{s}_score_period2")

    return i.matches.select("match_id", second("home").alias("home_second"), second("away").alias("away_second"))


@query(
    "default_fill",
    sql(
        """select match_id, ifnull(custom_id, 'N/A') as custom_id, ifnull(status_description, 'notstarted') as status,
        ifnull(round_number, 0) as round_number, ifnull(case when match_id % 17 <> 0 then season_year end, year(start_timestamp)::varchar) as season_year
        from matches"""
    ),
)
def _(i: Inputs) -> DataFrame:
    year = F.when(F.col("match_id") % 17 != 0, F.col("season_year"))
    return i.matches.select(
        "match_id",
        F.coalesce("custom_id", F.lit("N/A")).alias("custom_id"),
        F.coalesce("status_description", F.lit("notstarted")).alias("status"),
        F.coalesce("round_number", F.lit(0)).alias("round_number"),
        F.coalesce(year, F.year("start_timestamp").cast("string")).alias("season_year"),
    )


@query(
    "advantage_share_diff",
    sql(
        f"""select match_id, period, statistic_key,
        case when home_cents is null or away_cents is null then 'UNKNOWN' else ['AWAY', 'EQUAL', 'HOME'][sign(home_cents - away_cents)::int + 2] end as advantage,
        case when home_cents + away_cents > 0 then {rnd("100 * home_cents", "home_cents + away_cents", 2)} end as home_percentage,
        case when home_cents + away_cents > 0 then {rnd("100 * away_cents", "home_cents + away_cents", 2)} end as away_percentage,
        ((home_cents - away_cents) / 100)::double as value_difference,
        home_cents is not null and away_cents is not null as has_numeric_values, statistic_key is not null as is_complete_statistic from stats"""
    ),
)
def _(i: Inputs) -> DataFrame:
    plain = i.stats.select("match_id", "period", "statistic_key", "statistic_name", "home_value_numeric", "away_value_numeric")
    return compare_sides(plain).drop("statistic_name", "home_value_numeric", "away_value_numeric")


_PARAMS = """'{"page": ' || (event_id % 4) || ', "season": 2024, "tournament": ' || (user_id % 5) || '}'"""


def request_params() -> object:
    return keys.params_json(tournament="tournament_id", season="season_id", page=F.col("event_id") % 4)


@query(
    "batch_metadata",
    f"""select event_id, left(sha256('/events/' || event_type || ':' || {_PARAMS}), 16) as batch_id, 'feed' as source,
      '/events/' || event_type as endpoint, {_PARAMS} as request_params, '2.0.0' as client_version from events""",
)
def _(i: Inputs) -> DataFrame:
    endpoint = F.concat(F.lit("/events/"), "event_type")
    return i.events.select(
        "event_id",
        keys.batch_id(endpoint, request_params()).alias("batch_id"),
        F.lit("feed").alias("source"),
        endpoint.alias("endpoint"),
        request_params().alias("request_params"),
        F.lit(keys.CLIENT_VERSION).alias("client_version"),
    )


@query(
    "incremental_metadata",
    """select event_id, 'incremental' as extraction_type, '2024-01-15' as cutoff_date,
      'incremental_' || (user_id % 5) || '_2024_' || strftime(ts, '%Y-%m-%d') as batch_id from events""",
)
def _(i: Inputs) -> DataFrame:
    return i.events.select(
        "event_id", F.lit("incremental").alias("extraction_type"), F.lit("2024-01-15").alias("cutoff_date"),
        keys.incremental_batch_id("tournament_id", "season_id", "date").alias("batch_id"),
    )


_PATH = "'tournament_id=' || (user_id % 5) || '/season_id=2024/date=' || strftime(ts, '%Y-%m-%d')"


@query("partition_key", f"select event_id, {_PATH} as partition_key, {_PATH} || '/match_id=' || event_id as event_partition_key from events")
def _(i: Inputs) -> DataFrame:
    parts = ("tournament_id", "season_id", "date")
    return i.events.select(
        "event_id", keys.partition_key(*parts).alias("partition_key"),
        keys.event_partition_key(*parts, "event_id").alias("event_partition_key"),
    )


@query(
    "object_key",
    f"""select event_id, 'matches/' || {_PATH} || '/batch_' || event_type || '.ndjson' as object_key,
      'bronze/matches/' || {_PATH} || '/batch_' || event_type || '.ndjson' as bronze_path from events""",
)
def _(i: Inputs) -> DataFrame:
    part = keys.partition_key("tournament_id", "season_id", "date")
    return i.events.select(
        "event_id", keys.object_key("matches", part, "event_type").alias("object_key"),
        keys.bronze_path("matches", part, "event_type").alias("bronze_path"),
    )


# --- function families -------------------------------------------------------


@query(
    "scalar_conditional",
    sql(
        """select match_id, if(home_score_period1 is null, 'unknown', if(home_score_period1 > 0, 'scored', 'blank')) as first_half,
        ifnull(home_score_period2, -1) as filled, nullif(home_score_current, 0) as nonzero from matches"""
    ),
)
def _(i: Inputs) -> DataFrame:
    first = F.col("home_score_period1")
    return i.matches.select(
        "match_id",
        F.when(first > 0, "scored").when(first.isNotNull(), "blank").otherwise("unknown").alias("first_half"),
        F.coalesce("home_score_period2", F.lit(-1)).alias("filled"),
        F.nullif(F.col("home_score_current"), F.lit(0)).alias("nonzero"),
    )


@query(
    "scalar_compare",
    sql(
        """select match_id, least(home_team_id, away_team_id) as low, greatest(home_team_id, away_team_id) as high,
        greatest(home_score_period1, away_score_period2) as skips_null from matches"""
    ),
)
def _(i: Inputs) -> DataFrame:
    return i.matches.select(
        "match_id", F.least("home_team_id", "away_team_id").alias("low"), F.greatest("home_team_id", "away_team_id").alias("high"),
        F.greatest("home_score_period1", "away_score_period2").alias("skips_null"),
    )


@query(
    "scalar_math",
    """select o_orderkey, round(o_totalprice::decimal(18,4), 1)::double as rounded, abs(o_custkey - o_orderkey) as gap,
      o_orderkey * 2 + 1 as odd, o_orderkey // 7 as whole_sevenths, (o_orderkey * 1.0 / 8)::double as eighths from orders""",
)
def _(i: Inputs) -> DataFrame:
    key = F.col("o_orderkey")
    return i.table("orders").select(
        "o_orderkey",
        F.round(F.col("o_totalprice").cast("decimal(18,4)"), 1).alias("rounded"),
        F.abs(F.col("o_custkey") - key).alias("gap"),
        (key * 2 + 1).alias("odd"),
        F.expr("o_orderkey div 7").alias("whole_sevenths"),
        (key / 8).alias("eighths"),
    )


@query(
    "scalar_cast",
    """select event_id, event_id::varchar as as_text, try_cast(props->>'k' as integer) as as_int, ts::date as as_date,
      try_cast(event_type as integer) as not_a_number, (props->>'k')::decimal(18,6)::double as as_number,
      case when event_id % 2 = 0 then true else false end as as_flag from events""",
)
def _(i: Inputs) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    flag = F.when(F.col("event_id") % 2 == 0, "true").otherwise("false")
    return i.events.select(
        "event_id",
        F.col("event_id").cast("string").alias("as_text"),
        k.cast("int").alias("as_int"),
        F.col("ts").cast("date").alias("as_date"),
        F.col("event_type").try_cast("int").alias("not_a_number"),
        k.cast("decimal(18,6)").alias("as_number"),
        flag.cast("boolean").alias("as_flag"),
    )


@query(
    "scalar_string",
    """select p_partkey, p_name || ' (' || p_brand || ')' as label, lower(p_type) as lowered,
      regexp_replace(p_name, '[aeiou]+', '_', 'g') as masked, p_name ilike '%RED%' as has_red,
      left(p_name, 3) as head, replace(p_brand, '#', '-') as brand from part""",
)
def _(i: Inputs) -> DataFrame:
    name = F.col("p_name")
    return i.table("part").select(
        "p_partkey",
        F.concat(name, F.lit(" ("), "p_brand", F.lit(")")).alias("label"),
        F.lower("p_type").alias("lowered"),
        F.regexp_replace(name, "[aeiou]+", "_").alias("masked"),
        name.ilike("%RED%").alias("has_red"),
        F.left(name, F.lit(3)).alias("head"),
        F.replace(F.col("p_brand"), F.lit("#"), F.lit("-")).alias("brand"),
    )


@query(
    "scalar_date",
    """select o_orderkey, year(o_orderdate)::int as y, month(o_orderdate)::int as m, day(o_orderdate)::int as d, quarter(o_orderdate)::int as q,
      dayofweek(o_orderdate)::int as dow, week(o_orderdate)::int as iso_week, dayname(o_orderdate) as day_name, monthname(o_orderdate) as month_name,
      (o_orderdate - interval 90 day)::date as earlier, make_timestamp(o_orderkey * 1000000) as from_epoch from orders""",
)
def _(i: Inputs) -> DataFrame:
    day = F.col("o_orderdate")
    return i.table("orders").select(
        "o_orderkey", F.year(day).alias("y"), F.month(day).alias("m"), F.dayofmonth(day).alias("d"), F.quarter(day).alias("q"),
        (F.dayofweek(day) - 1).alias("dow"), F.weekofyear(day).alias("iso_week"),
        F.date_format(day, "EEEE").alias("day_name"), F.date_format(day, "MMMM").alias("month_name"),
        F.date_sub(day.cast("date"), 90).alias("earlier"), F.timestamp_seconds("o_orderkey").alias("from_epoch"),
    )


@query(
    "scalar_generate_series",
    """select n_nationkey, unnest(generate_series(date '2024-01-01', date '2024-01-01' + n_nationkey::int, interval 1 day))::date as day from nation""",
)
def _(i: Inputs) -> DataFrame:
    first = F.lit("2024-01-01").cast("date")
    return i.table("nation").select(
        "n_nationkey", F.explode(F.sequence(first, F.date_add(first, F.col("n_nationkey")))).alias("day")
    )


@query(
    "scalar_json",
    """select event_id, (props->>'k')::bigint as k, json_type(props) = 'OBJECT' as is_object, props->>'missing' as missing,
      (props->>'k')::int > 50 as large from events""",
)
def _(i: Inputs) -> DataFrame:
    doc = F.parse_json("props")
    return i.events.select(
        "event_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.schema_of_variant(doc).startswith("OBJECT").alias("is_object"),
        F.get_json_object("props", "$.missing").alias("missing"),
        (F.variant_get(doc, "$.k", "int") > 50).alias("large"),
    )


@query("scalar_hash", "select event_id, left(sha256(event_type || ':' || event_id), 16) as short_sha, md5(event_type) as type_md5 from events")
def _(i: Inputs) -> DataFrame:
    text = F.concat("event_type", F.lit(":"), F.col("event_id").cast("string"))
    return i.events.select("event_id", F.left(F.sha2(text, 256), F.lit(16)).alias("short_sha"), F.md5("event_type").alias("type_md5"))
