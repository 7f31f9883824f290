"""Files: line-delimited JSON in and out, manifests, export, streaming.

Each query writes data derived from the tables below the shared folder of the
session and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sidewise.operators import documents as D
from sidewise.session import scratch_path
from sidewise.sources import files as S
from sidewise.sources import keyed, snapshots
from sidewise.streaming import ingest

from . import ORACLES, QUERIES, marts, query  # noqa: F401 - the marts are registered before their export
from .duck import sql
from .inputs import Inputs

RECORD = "event_id bigint, user_id bigint, event_type string, value double, seconds bigint, batch_id string"
LAYOUT = "tournament_id int, season_id int, date string"
BY = S.PARTITION_COLUMNS
_FIELDS = """event_id, user_id, event_type, value, floor(epoch(ts))::bigint as seconds, 'b' || (event_id % 3) as batch_id,
  (user_id % 5)::int as tournament_id, 2024 as season_id, strftime(ts, '%Y-%m-%d') as date"""


def records(i: Inputs) -> DataFrame:
    batch = F.concat(F.lit("b"), F.col("event_id") % 3)
    return i.events.select("event_id", "user_id", "event_type", "value", "seconds", batch.alias("batch_id"), *BY)


def stored(i: Inputs) -> str:
    path = scratch_path(i.spark, "records")
    S.write_partitioned(records(i), path)
    return path


@query("write_partitioned_ndjson", f"select {_FIELDS} from events")
def _(i: Inputs) -> DataFrame:
    return S.well_formed(S.scan_ndjson(i.spark, stored(i), RECORD, LAYOUT))


@query(
    "scan_ndjson",
    """select event_id, event_id % 10 = 3 as malformed from events where event_id % 10 <> 7""",
)
def _(i: Inputs) -> DataFrame:
    """Every tenth line blank, every tenth cut off."""
    path = scratch_path(i.spark, "lines")
    kind = F.col("event_id") % 10
    text = F.to_json(F.struct("event_id", "event_type", "value"))
    line = F.when(kind == 7, "").when(kind == 3, F.concat(F.lit('{"broken":'), F.col("event_id").cast("string"))).otherwise(text)
    i.events.select(line.alias("value")).write.text(path)
    lines = S.scan_ndjson(i.spark, path, "event_id bigint, event_type string, value double")
    number = F.regexp_extract(S.CORRUPT, r"(\d+)", 1)
    bad = F.col(S.CORRUPT).isNotNull()
    return lines.select(F.coalesce("event_id", F.nullif(number, F.lit("")).cast("bigint")).alias("event_id"), bad.alias("malformed"))


@query("scan_ndjson_text", "select (user_id % 5)::int as tournament_id, count(*) as lines from events group by 1")
def _(i: Inputs) -> DataFrame:
    return S.scan_ndjson_text(i.spark, stored(i), LAYOUT).groupBy("tournament_id").agg(F.count(F.lit(1)).alias("lines"))


@query("scan_json_documents", "select c_nationkey::bigint as match_id, count(*) as customers from customer group by 1")
def _(i: Inputs) -> DataFrame:
    """One folder per nation named like a document key, one document in each."""
    path = scratch_path(i.spark, "documents")
    names = i.table("customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    folder = F.concat(F.lit("match_"), F.col("c_nationkey").cast("string"), F.lit(".json"))
    names.select(F.to_json(F.struct("n")).alias("value"), folder.alias("doc")).repartition("doc").write.partitionBy("doc").text(path)
    docs = S.scan_json_documents(i.spark, path, r"match_(\d+)\.json", glob="*")
    return docs.select("match_id", F.get_json_object("data", "$.n").cast("bigint").alias("customers"))


@query("scan_after_partition_files", f"select {_FIELDS} from events where ts::date > '2024-01-20'")
def _(i: Inputs) -> DataFrame:
    from sidewise.operators.filters import after_partition

    files = S.well_formed(S.scan_ndjson(i.spark, stored(i), RECORD, LAYOUT))
    return after_partition(files, "date", "2024-01-20")


@query("to_ndjson", "select '{\"p_partkey\":' || p_partkey || ',\"p_name\":\"' || p_name || '\",\"p_size\":' || ifnull(case when p_size % 2 = 0 then p_size end::varchar, 'null') || '}' as value from part")
def _(i: Inputs) -> DataFrame:
    even = F.when(F.col("p_size") % 2 == 0, F.col("p_size"))
    return S.to_ndjson(i.table("part").select("p_partkey", "p_name", even.alias("p_size")))


_REPLACED = f"""select {_FIELDS} from events where ts::date <> '2024-01-10' or event_type = 'click'"""


def snapshot(i: Inputs) -> str:
    root = scratch_path(i.spark, "snapshots")
    snapshots.write(records(i), root, LAYOUT, BY)
    return root


def current(i: Inputs, root: str, version: int | None = None) -> DataFrame:
    return S.well_formed(snapshots.scan(i.spark, root, RECORD, LAYOUT, version)).select(*records(i).columns)


@query("replace_partition", _REPLACED)
def _(i: Inputs) -> DataFrame:
    """One day is replaced by its clicks; all other partitions stay, and a tournament without clicks loses that day."""
    root = snapshot(i)
    day = records(i).where("date = '2024-01-10'")
    snapshots.write(day.where("event_type = 'click'"), root, LAYOUT, BY, "replace", replaced=day)
    return current(i, root)


@query("read_version", f"select 1 as version, * from (select {_FIELDS} from events) union all select 2, * from (select {_FIELDS} from events where event_type = 'view')")
def _(i: Inputs) -> DataFrame:
    """The snapshot before a full rewrite stays readable beside the new one."""
    root = snapshot(i)
    snapshots.write(records(i).where("event_type = 'view'"), root, LAYOUT, BY, "full")
    of = lambda n: current(i, root, n).withColumn("version", F.lit(n))
    return of(1).unionByName(of(2))


@query("append_vs_replace", "select strftime(ts, '%Y-%m-%d') as date, count(*) * 2 as n from events where ts::date <> '2024-01-10' group by 1 union all select '2024-01-10', count(*) from events where ts::date = '2024-01-10'")
def _(i: Inputs) -> DataFrame:
    """Appended twice, then one day replaced."""
    root = snapshot(i)
    snapshots.write(records(i), root, LAYOUT, BY)
    snapshots.write(records(i).where("date = '2024-01-10'"), root, LAYOUT, BY, "replace")
    return current(i, root).groupBy("date").agg(F.count(F.lit(1)).alias("n"))


_LINE = """'{"event_id":' || event_id || ',"event_type":"' || event_type || '"}'"""
_MANIFEST = f"""select (user_id % 5)::int as tournament_id, 2024 as season_id, strftime(ts, '%Y-%m-%d') as date, 'b' || (event_id % 3) as batch_id,
  count(*) as record_count, (sum(strlen({_LINE})) + count(*) - 1)::bigint as file_size_bytes, '1.0' as schema_version from events group by 1, 2, 3, 4"""


def _manifest(i: Inputs) -> DataFrame:
    return S.batch_manifest(records(i).select("event_id", "event_type", "batch_id", *BY), BY)


@query("batch_manifest", _MANIFEST)
def _(i: Inputs) -> DataFrame:
    return _manifest(i)


@query("get_manifest", f"select * from ({_MANIFEST}) where tournament_id = 3 and date = '2024-01-09' and batch_id = 'b1'")
def _(i: Inputs) -> DataFrame:
    return S.get_manifest(_manifest(i), tournament_id=3, season_id=2024, date="2024-01-09", batch_id="b1")


@query("list_partitions", "select distinct 'tournament_id=' || (user_id % 5) || '/season_id=2024/date=' || strftime(ts, '%Y-%m-%d') as partition_key from events where user_id % 5 = 2")
def _(i: Inputs) -> DataFrame:
    return S.list_partitions(records(i), BY, tournament_id=2)


_JSON = """'{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '","seconds":' || floor(epoch(ts))::bigint || ',"batch_id":"b' || (event_id % 3) || '"}'"""


@query(
    "partition_stats",
    f"""select tournament_id, season_id, date, 1::bigint as batch_count, count(distinct batch_id) as manifest_count, count(*) as total_records,
      sum(bytes)::bigint as total_size_bytes, round(sum(bytes)::decimal(38, 6) / 1048576, 2)::double as total_size_mb
    from (select {_FIELDS}, strlen({_JSON}) + 1 as bytes from events) group by 1, 2, 3""",
)
def _(i: Inputs) -> DataFrame:
    """The size of a partition is that of its lines, however they are split; a partition that fits in one task is one file."""
    path, manifests = scratch_path(i.spark, "batch"), scratch_path(i.spark, "manifests")
    S.store_batch(records(i).drop("value"), path, manifests, BY)
    files = S.data_files(i.spark, path, LAYOUT, "*.json")
    return S.partition_stats(files, i.spark.read.parquet(manifests))


@query("partition_stats_records", f"select tournament_id, season_id, date, count(*) as manifest_count, sum(record_count)::bigint as total_records from ({_MANIFEST}) group by 1, 2, 3")
def _(i: Inputs) -> DataFrame:
    path, manifests = scratch_path(i.spark, "batch"), scratch_path(i.spark, "manifests")
    S.store_batch(records(i), path, manifests, BY)
    files = S.data_files(i.spark, path, LAYOUT)
    return S.partition_stats(files, i.spark.read.parquet(manifests)).select(*BY, "manifest_count", "total_records")


#: The stored gold relations, in the order of their names.
GOLD = sorted([
    "mart_head_to_head", "mart_league_averages", "mart_match_predictions", "mart_team_attack", "mart_team_btts_analysis", "mart_team_defense",
    "mart_team_discipline", "mart_team_form", "mart_team_overview", "mart_team_possession", "mart_team_season_summary",
    "mart_upcoming_fixtures", "mart_upcoming_predictions",
])


@query("export_csv_all", "\nunion all ".join(f"select '{name}' as table_name, count(*) as row_count from ({ORACLES[name]})" for name in GOLD))
def _(i: Inputs) -> DataFrame:
    """Every gold relation is stored as a table and exported; the rows are counted in the files."""
    tables, out = [], scratch_path(i.spark, "csv")
    for name in GOLD:
        path = scratch_path(i.spark, name)
        tables.append(path.rsplit("/", 1)[-1].replace("-", "_"))
        QUERIES[name](i.spark, i.sf_dir).write.option("path", path).saveAsTable(tables[-1])
    exported = S.export_csv_all(i.spark, tables, out)
    lines = i.spark.read.schema("line string, folder string").option("header", "true").csv(f"{out}/*")
    found = lines.groupBy(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("table_name")).agg(F.count(F.lit(1)).alias("row_count"))
    # A relation without rows has no file; a row must be in the files as often as it was written.
    both = exported.join(found.select("table_name", F.col("row_count").alias("found")), "table_name", "left")
    agreed = F.when(F.col("row_count") == F.coalesce("found", F.lit(0)), F.col("row_count"))
    return both.select(F.regexp_extract("table_name", "^(.*)_[0-9a-f]+$", 1).alias("table_name"), agreed.alias("row_count"))


@query("external_json_source", "select event_type, count(*) as n from events group by 1")
def _(i: Inputs) -> DataFrame:
    files = i.spark.read.schema(f"{RECORD}, {LAYOUT}").json(stored(i))
    return files.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "raw_load_matches",
    sql("select match_id, tournament_id + 200 as tournament_id, season_id from matches where tournament_id = 2 and season_id in (1998, 1999)"),
)
def _(i: Inputs) -> DataFrame:
    """Scan documents, keep the configured scope, insert what is absent; run twice."""
    from sidewise.operators.loads import insert_if_absent

    path = scratch_path(i.spark, "raw")
    i.match_documents.select(F.col("data").alias("value")).write.text(path)
    lines = S.scan_ndjson_text(i.spark, path)
    ids = D.parse_once(lines, "data", "struct<id:string,tournament:struct<uniqueTournament:struct<id:string>>,season:struct<id:string>>", "doc", "data", "file_path")
    rows = ids.select(
        F.col("doc.id").cast("bigint").alias("match_id"), F.col("doc.tournament.uniqueTournament.id").cast("int").alias("tournament_id"),
        F.col("doc.season.id").cast("int").alias("season_id"),
    )
    scoped = rows.where((F.col("tournament_id") == 202) & F.col("season_id").isin(1998, 1999))
    first = scoped.where(F.col("season_id") == 1998)
    return insert_if_absent(first, scoped, ["match_id"], [F.asc("season_id")])


@query("stream_ndjson_upsert", "select user_id, min(event_id) as event_id from events group by user_id")
def _(i: Inputs) -> DataFrame:
    """Records of all days as a file stream; the first record of every user stays."""
    source, target, checkpoint = (scratch_path(i.spark, n) for n in ("stream", "target", "progress"))
    # One file: micro-batches keep the order of the files, a batch keeps the least event id.
    i.events.select("event_id", "user_id", "event_type").write.json(source)
    stream = ingest.read_ndjson_stream(i.spark, source, "event_id bigint, user_id bigint, event_type string")
    ingest.stream_upsert(stream, target, checkpoint, ["user_id"], ["event_id"]).awaitTermination()
    return keyed.scan(i.spark, target, "event_id bigint, user_id bigint, event_type string").select("user_id", "event_id")


@query("stream_ndjson_upsert_batches", "select count(distinct user_id) as users, count(distinct user_id) as rows from events")
def _(i: Inputs) -> DataFrame:
    """Several micro-batches: a user seen in an earlier batch is not added again."""
    source, target, checkpoint = (scratch_path(i.spark, n) for n in ("stream", "target", "progress"))
    i.events.select("event_id", "user_id", "event_type").repartition(4, "event_id").write.json(source)
    stream = ingest.read_ndjson_stream(i.spark, source, "event_id bigint, user_id bigint, event_type string", max_files=1)
    ingest.stream_upsert(stream, target, checkpoint, ["user_id"], ["event_id"]).awaitTermination()
    loaded = keyed.scan(i.spark, target, "event_id bigint, user_id bigint, event_type string")
    return loaded.agg(F.count_distinct("user_id").alias("users"), F.count(F.lit(1)).alias("rows"))
