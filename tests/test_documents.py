import pytest
from pyspark.sql import functions as F

from sidewise.operators import documents as D
from sidewise.session import scratch_path
from sidewise.sources import files as S
from sidewise.sources import keyed
from sidewise.streaming import ingest

ITEM = '{"name":"Fouls","key":"fouls","home":"3","away":"5","homeValue":3,"awayValue":5.25}'
PERIODS = '[{"period":"ALL","groups":[{"groupName":"G","statisticsItems":[%s]},{"groupName":"E","statisticsItems":[]}]}]' % ITEM


def test_both_envelopes_give_the_same_rows(spark):
    docs = [(1, '{"statistics":%s}' % PERIODS), (2, '{"statistics":{"statistics":%s}}' % PERIODS), (3, '{"statistics":[]}'), (4, None)]
    rows = D.explode_stats(spark.createDataFrame(docs, "match_id int, data string")).collect()
    assert sorted((r.match_id, r.statistic_key, str(r.away_value_numeric)) for r in rows) == [
        (1, "fouls", "5.250000"), (2, "fouls", "5.250000")
    ]


def test_strict_cast_raises_and_lenient_gives_null(spark):
    df = spark.createDataFrame([('{"id":"x1","slug":"s"}',)], "data string")
    row = D.flatten_match_json(df, strict=False).first()
    assert row.match_id is None and row.match_slug == "s"
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        D.flatten_match_json(df).collect()


def test_flatten_has_all_columns(spark):
    assert len(D.flatten_match_json(spark.createDataFrame([("{}",)], "data string")).columns) == 44


def test_counts_in_groups_match_brute_force(spark):
    rows = [(m, p, g, f"k{n:03d}", "name") for m in (1, 2) for p in ("ALL", "1ST") for g in ("A", "B") for n in range(7 * m)]
    flat = spark.createDataFrame(rows, "match_id int, period string, group_name string, statistic_key string, statistic_name string")
    got = D.with_group_counts(flat).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.stat_order_in_group == int(r.statistic_key[1:]) + 1
        assert r.stats_count_in_group == 7 * r.match_id
        assert (r.statistics_in_period, r.total_statistics_count) == (14 * r.match_id, 28 * r.match_id)
        assert (r.periods_count, r.groups_count) == (2, 2)


def test_validation_splits_rows(spark):
    rows = [('{"id":1,"name":"a","year":"24/25"}',), ('{"id":"x","name":"a"}',), ("nonsense",)]
    df = spark.createDataFrame(rows, "data string")
    valid, rejected = D.validate_records(df, "data", D.SEASON_REQUIRED)
    assert valid.count() == 1
    errors = {tuple(r.errors) for r in rejected.collect()}
    assert errors == {("id: not a bigint", "year: missing"), ("id: missing", "name: missing", "year: missing")}


def test_path_language(spark):
    df = spark.sql("select 1 k, struct(array(struct(array(1, 2) b), struct(cast(null as array<int>) b)) a, struct(5 c) o) d")
    assert [r.item for r in D.extract_path(df, "d", "a[*].b").collect()] == [1, 2]
    assert [r.item for r in D.extract_path(df, "d", "o.c").collect()] == [5]
    assert D.extract_path(df, "d", "a", ["k"]).count() == 2


def test_ndjson_round_trip_with_bad_lines_and_replacement(spark):
    root = scratch_path(spark, "ndjson-test")
    df = spark.createDataFrame([(1, 7, "2024-01-01", "ł"), (1, 7, "2024-01-02", None), (1, 7, "unknown", "z")], "tournament_id int, season_id int, date string, name string")
    S.write_partitioned(df, root)
    S.write_partitioned(df.where("date = '2024-01-02'").withColumn("name", F.lit("new")), root, mode="replace")
    layout = "tournament_id int, season_id int, date string"
    back = S.scan_ndjson(spark, root, "name string", layout)
    assert {(r.date, r.name) for r in S.well_formed(back).collect()} == {("2024-01-01", "ł"), ("2024-01-02", "new"), ("unknown", "z")}
    keys = [r.partition_key for r in S.list_partitions(back).orderBy("partition_key").collect()]
    assert keys[0] == "tournament_id=1/season_id=7/date=2024-01-01" and len(keys) == 3


def test_corrupt_lines_do_not_depend_on_the_columns_used(spark):
    root = scratch_path(spark, "corrupt-test")
    spark.createDataFrame([('{"a":1}',), ("",), ('{"a":',)], "value string").coalesce(1).write.text(root)
    lines = S.scan_ndjson(spark, root, "a int")
    assert lines.count() == 2
    assert lines.where(F.col(S.CORRUPT).isNotNull()).count() == 1


def test_manifest_counts_joined_text(spark):
    df = spark.createDataFrame([(1, "b", "ab"), (1, "b", "ł")], "p int, batch_id string, v string")
    row = S.batch_manifest(df, ["p"]).first()
    assert (row.record_count, row.schema_version) == (2, "1.0")
    assert row.file_size_bytes == len('{"v":"ab"}\n{"v":"ł"}'.encode())


def test_stream_replay_adds_nothing(spark):
    source, target, progress = (scratch_path(spark, n) for n in ("s", "t", "p"))
    schema = "id int, v int"
    for n in range(2):
        spark.createDataFrame([(1, n), (n + 2, n)], schema).coalesce(1).write.mode("append").json(source)
        stream = ingest.read_ndjson_stream(spark, source, schema)
        ingest.stream_upsert(stream, target, progress, ["id"], ["v"]).awaitTermination()
    rows = keyed.scan(spark, target, schema).select("id", "v").collect()
    assert sorted(map(tuple, rows)) == [(1, 0), (2, 0), (3, 1)]


def test_counts_of_one_very_large_match(spark):
    rows = spark.range(120_000).selectExpr(
        "1 as match_id", "'ALL' as period", "'A' as group_name", "lpad(cast(id as string), 7, '0') as statistic_key", "'n' as statistic_name"
    )
    got = D.with_group_counts(rows).selectExpr("min(stats_count_in_group) as n", "count_if(stat_order_in_group = int(statistic_key) + 1) as ordered").first()
    assert (got.n, got.ordered) == (120_000, 120_000)


def test_shape_profile_opens_every_level(spark):
    df = spark.createDataFrame([('{"a":{"b":{"c":{"d":{"e":1}}}}}',)], "data string")
    assert {r.path for r in D.json_shape_profile(df, "data").collect()} == {"$.a", "$.a.b", "$.a.b.c", "$.a.b.c.d", "$.a.b.c.d.e"}


def test_fixture_lists_are_pages_of_bounded_size(spark, monkeypatch):
    from registry import inputs

    sf, of = "/root/testdata/sf0.01", "size(from_json(data, 'data struct<events:array<string>>').data.events)"
    whole = inputs.Inputs(spark, sf).upcoming_documents.selectExpr("cust_id", "take", f"{of} as n")
    expected = {tuple(r) for r in whole.groupBy("cust_id", "take").agg(F.sum("n")).collect()}
    monkeypatch.setattr(inputs, "_WRITTEN", {})
    monkeypatch.setattr(inputs, "PAGE_EVENTS", 1, raising=False)
    pages = inputs.Inputs(spark, sf).upcoming_documents.selectExpr("cust_id", "take", f"{of} as n").cache()
    assert {tuple(r) for r in pages.groupBy("cust_id", "take").agg(F.sum("n")).collect()} == expected
    assert pages.count() > whole.count()
