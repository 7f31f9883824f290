"""Incremental loads and table replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sidewise.operators import keyfilter
from sidewise.operators import loads as L
from sidewise.session import scratch_path
from sidewise.sources import keyed

from . import query
from .duck import sql
from .inputs import Inputs
from .marts import STAGED_COLUMNS

_COLUMNS = ["event_id", "user_id", "event_type", "ts", "date"]
_SELECT = "event_id, user_id, event_type, ts, strftime(ts, '%Y-%m-%d') as date"
_OLD = "ts < '2024-01-06'"


def _loaded(i: Inputs) -> DataFrame:
    """The first five days, one row per user."""
    old = i.events.where("ts < timestamp_ntz'2024-01-06'").select(*_COLUMNS)
    return L.dedupe_latest(old, ["user_id"], [F.desc("ts"), F.desc("event_id")])


_LOADED = f"select {_SELECT} from events where {_OLD} qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"


def _first(*cols: str) -> list:
    return [F.asc(c) for c in cols]


@query(
    "insert_if_absent",
    f"""with t as ({_LOADED}), s as (select {_SELECT} from events where not {_OLD} qualify row_number() over (partition by user_id order by ts, event_id) = 1)
    select * from t union all select * from s where user_id not in (select user_id from t)""",
)
def _(i: Inputs) -> DataFrame:
    fresh = i.events.where("ts >= timestamp_ntz'2024-01-06'").select(*_COLUMNS)
    return L.insert_if_absent(_loaded(i), fresh, ["user_id"], _first("ts", "event_id"))


@query(
    "insert_on_conflict_nothing",
    f"""with t as ({_LOADED}) select {_SELECT} from events where event_id not in (select event_id from t) union all select * from t""",
)
def _(i: Inputs) -> DataFrame:
    return L.insert_if_absent(_loaded(i), i.events.select(*_COLUMNS), ["event_id"], _first("ts"))


@query(
    "merge_upsert",
    f"""with t as ({_LOADED}), s as (select {_SELECT} from events where event_type = 'click' qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1)
    select * from s union all select * from t where user_id not in (select user_id from s)""",
)
def _(i: Inputs) -> DataFrame:
    source = i.events.where(F.col("event_type") == "click").select(*_COLUMNS)
    return L.merge_upsert(_loaded(i), source, ["user_id"], [F.desc("ts"), F.desc("event_id")])


@query(
    "merge_upsert_partitions",
    """with u as (select distinct user_id from events where ts >= '2024-01-30')
    select (user_id % 20)::int as bucket, user_id, case when event_type = 'click' then 'new' else 'old' end as state from events where ts < '2024-01-06'
      and user_id not in (from u) qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1
    union all select (user_id % 20)::int, user_id, 'upserted' from u""",
)
def _(i: Inputs) -> DataFrame:
    """Written as a partitioned table, then upserted in the touched partitions only."""
    path = scratch_path(i.spark, "upsert")
    bucket = (F.col("user_id") % 20).cast("int").alias("bucket")
    state = F.when(F.col("event_type") == "click", "new").otherwise("old").alias("state")
    base = _loaded(i).select("user_id", state, bucket)
    base.write.partitionBy("bucket").parquet(path)
    batch = i.events.where("ts >= timestamp_ntz'2024-01-30'").select("user_id", F.lit("upserted").alias("state"), bucket)
    L.upsert_partitions(i.spark, path, batch, ["user_id"], ["bucket"], [F.asc("state")])
    return i.spark.read.schema(base.schema).parquet(path).select("bucket", "user_id", "state")


@query(
    "delete_insert",
    f"""with t as ({_LOADED}) select * from t where event_type <> 'error' union all select {_SELECT} from events where event_type = 'error' and ts >= '2024-01-20'""",
)
def _(i: Inputs) -> DataFrame:
    fresh = i.events.where("event_type = 'error' and ts >= timestamp_ntz'2024-01-20'").select(*_COLUMNS)
    return L.delete_insert(_loaded(i), fresh, "event_type", "error")


@query("full_refresh", "select n_name, count(*) as customers from customer join nation on c_nationkey = n_nationkey group by n_name")
def _(i: Inputs) -> DataFrame:
    """Written twice as a whole; the second content replaces the first."""
    path = scratch_path(i.spark, "refresh")
    nation, customer = i.table("nation"), i.table("customer")
    counted = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count(F.lit(1)).alias("customers"))
    for content in (counted.where(F.col("n_name") < "NATION_2"), counted):
        content.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return i.spark.read.schema(counted.schema).parquet(path)


@query("as_view", "select c_mktsegment, count(*) as n from customer group by 1")
def _(i: Inputs) -> DataFrame:
    i.table("customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")).createOrReplaceTempView("sidewise_segments")
    return i.spark.table("sidewise_segments")


@query("skip_existing", "select doc_id from documents where doc_id not in (select doc_id from labels)")
def _(i: Inputs) -> DataFrame:
    return L.skip_existing(i.table("documents").select("doc_id"), i.table("labels"), ["doc_id"])


_KEYED = "event_id bigint, user_id bigint, event_type string, ts timestamp_ntz, date string"


@query(
    "insert_if_absent_keyed",
    f"""with t as (select event_id, user_id from events where {_OLD} qualify row_number() over (partition by user_id order by ts, event_id) = 1)
    select event_id, user_id, 0::bigint as load from t union all
    select event_id, user_id, 1 from events where user_id not in (select user_id from t) qualify row_number() over (partition by user_id order by ts, event_id) = 1""",
)
def _(i: Inputs) -> DataFrame:
    """Two loads into a bucketed table: the second meets the keys of the first and adds the others."""
    root = scratch_path(i.spark, "keyed")
    events = i.events.select(*_COLUMNS)
    for part in (events.where("ts < timestamp_ntz'2024-01-06'"), events):
        keyed.insert(part, root, ["user_id"], _first("ts", "event_id"), buckets=16)
    return keyed.scan(i.spark, root, _KEYED).select("event_id", "user_id", "load")


@query("skip_existing_prefiltered", "select doc_id from documents where doc_id not in (select doc_id from labels)")
def _(i: Inputs) -> DataFrame:
    """Only documents whose key the filter of the labels knows take part in the anti join."""
    labels, segments = i.table("labels"), 4
    path = scratch_path(i.spark, "keyfilter")
    keyfilter.build(labels, ["doc_id"], F.lit(0), segments).write.parquet(path)
    known = i.spark.read.schema(keyfilter.SCHEMA).parquet(path)
    return keyfilter.missing_from(i.table("documents").select("doc_id"), labels, ["doc_id"], known, segments)


@query("hwm_filter", f"select {_SELECT} from events where ts > (select max(ts) from events where {_OLD} and event_type <> 'click')")
def _(i: Inputs) -> DataFrame:
    target = i.events.where("ts < timestamp_ntz'2024-01-06' and event_type <> 'click'")
    return L.hwm_filter(i.events.select(*_COLUMNS), target, "ts")


@query("hwm_filter_empty_target", f"select {_SELECT} from events")
def _(i: Inputs) -> DataFrame:
    return L.hwm_filter(i.events.select(*_COLUMNS), i.events.where("user_id < 0"), "ts")


@query("late_data_policy", f"select {_SELECT} from events where not ({_OLD} and event_type <> 'click')")
def _(i: Inputs) -> DataFrame:
    """By key, so late clicks are still picked up."""
    target = i.events.where("ts < timestamp_ntz'2024-01-06' and event_type <> 'click'")
    return L.hwm_filter(i.events.select(*_COLUMNS), target, "ts", mode="anti", keys=["event_id"])


@query("late_data_dropped", f"select {_SELECT} from events where event_type = 'click' and ts <= (select max(ts) from events where {_OLD} and event_type <> 'click')")
def _(i: Inputs) -> DataFrame:
    target = i.events.where("ts < timestamp_ntz'2024-01-06' and event_type <> 'click'")
    return L.late_rows(i.events.select(*_COLUMNS), target, "ts", ["event_id"])


@query(
    "new_since_batch",
    "select l_orderkey, l_linenumber, l_partkey from lineitem where l_orderkey in (select o_orderkey from orders where o_orderpriority = '1-URGENT')",
)
def _(i: Inputs) -> DataFrame:
    details = i.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey")
    new = L.new_since_batch(details, i.table("orders"), "o_orderpriority", ["o_orderkey"], "1-URGENT")
    return new.withColumnRenamed("o_orderkey", "l_orderkey")


@query(
    "stage_incremental",
    sql(
        f"""select {STAGED_COLUMNS}, case when injury_time_2 is not null then start_timestamp + interval 1 hour end as current_period_start_timestamp
        from staged where season_id < 1999 or start_timestamp > (select max(start_timestamp) from staged where season_id < 1999)"""
    ),
)
def _(i: Inputs) -> DataFrame:
    from sidewise.plans import silver

    staged = i.staged.where(F.col("season_id") < 1999)
    return silver.stage_incremental(staged, i.matches, i.stats)


@query(
    "schema_guard",
    f"""with said(batch, outcome) as (values ('same', 'loaded'), ('narrow', 'schema changed: missing date'),
        ('wide', 'schema changed: unexpected page'), ('retyped', 'schema changed: ts: date instead of timestamp_ntz'))
    select batch, outcome, event_type, case when outcome = 'loaded' then count(*) else 0 end as n_loaded
    from (select {_SELECT} from events where not {_OLD}) e, said group by batch, outcome, event_type""",
)
def _(i: Inputs) -> DataFrame:
    """Batches of one shape and of changed shapes; only the first may be loaded."""
    fresh = i.events.where("ts >= timestamp_ntz'2024-01-06'").select(*_COLUMNS)
    batches = {
        "same": fresh, "narrow": fresh.drop("date"), "wide": fresh.withColumn("page", F.lit(1)),
        "retyped": fresh.withColumn("ts", F.to_date("ts")),
    }
    target, out = i.events.select(*_COLUMNS), None
    for name, batch in batches.items():
        try:
            L.schema_guard(target, batch)
            outcome, n = "loaded", F.count(F.lit(1))
        except ValueError as error:
            outcome, n = str(error), F.lit(0).cast("bigint")
        rows = batch.groupBy(F.lit(name).alias("batch"), F.lit(outcome).alias("outcome"), "event_type").agg(n.alias("n_loaded"))
        out = rows if out is None else out.unionByName(rows)
    return out
