"""Stored relations by match: what reads them in buckets moves no rows."""

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from registry.inputs import _WRITTEN, Inputs
from sidewise import schemas
from sidewise.operators import documents as D
from sidewise.operators import filters, joins, reports
from sidewise.plans import bronze, silver
from sidewise.session import scratch_path, set_conf, write_bucketed


@pytest.fixture(scope="module")
def data(spark):
    return Inputs(spark, "/root/testdata/sf0.001")


def moves(df) -> int:
    return plan_of(df).count("Exchange hashpartitioning")


def test_several_frames_share_the_buckets(spark):
    first, second = (spark.range(50).select((F.col("id") % 7).alias("k"), F.lit(n).alias("part")) for n in (1, 2))
    table = spark.table(write_bucketed(first, scratch_path(spark, "kinds-test"), "k", 6, "part", more=[second]))
    counted = table.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert moves(counted) == 0 and table.count() == 100 and sum(r.n for r in counted.collect()) == 100


def test_rows_in_order_are_written_without_a_sort(spark):
    # More buckets than cores: each is written by a task of its own.
    source = spark.table(write_bucketed(spark.range(400).withColumnRenamed("id", "k"), scratch_path(spark, "order-source"), "k", 20))
    wide = source.select("k", F.explode(F.array(F.lit(2), F.lit(1))).alias("n"))
    name = write_bucketed(wide, scratch_path(spark, "in-order"), "k", 20, in_order=True)
    described = {r.col_name: r.data_type for r in spark.sql(f"describe formatted {name}").collect()}
    assert described["Sort Columns"] == "[]" and described["Num Buckets"] == "20"
    files = spark.table(name).select(F.col("_metadata.file_path").alias("file"), "k", "n").collect()
    assert len(files) == 800 and len({r.file for r in files}) == 20 and len({r.file.split("part-")[1][:5] for r in files}) == 20
    for file in {r.file for r in files}:
        keys = [r.k for r in files if r.file == file]
        assert keys == sorted(keys)
    assert moves(spark.table(name).groupBy("k").count()) == 0


def test_matches_filed_under_their_id_are_not_moved(data, spark):
    variants = data.match_variants
    own, others = bronze.full_matches_kinds(variants)
    assert moves(own.repartition(data.buckets, "match_id")) == 0 and others.isEmpty()
    # Documents under a wrong id or none keep their own.
    wrong = variants.withColumn("match_id", F.when(F.col("match_id") % 2 == 0, F.col("match_id")).when(F.col("match_id") % 3 == 0, -F.col("match_id")))
    own, others = bronze.full_matches_kinds(wrong)
    expected = bronze.full_matches_data(variants)
    assert not own.isEmpty() and not others.isEmpty() and own.schema == expected.schema
    both = own.unionByName(others)
    assert both.exceptAll(expected).isEmpty() and both.count() == expected.count()
    assert data.full_matches.exceptAll(expected).isEmpty() and data.full_matches.count() == expected.count()


def test_settings_hold_inside_the_block_only(spark):
    key, unset = "spark.sql.shuffle.partitions", "spark.sql.execution.useObjectHashAggregateExec"
    before = spark.conf.get(key)
    with set_conf(spark, spark__sql__shuffle__partitions="3", spark__sql__execution__useObjectHashAggregateExec="false"):
        assert spark.conf.get(key) == "3" and spark.conf.get(unset) == "false"
    assert spark.conf.get(key) == before and spark.conf.get(unset) == "true"


def test_buckets_follow_the_size_of_the_tables(spark, monkeypatch):
    monkeypatch.setattr("registry.inputs.BUCKET_BYTES", 10_000)
    assert Inputs(spark, "/root/testdata/sf0.001").buckets > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_relations_by_match_are_not_shuffled(data):
    per_metric = data.side_values.groupBy("match_id", "period", "metric").agg(F.max("home_value"))
    per_match = data.stats.groupBy("match_id").agg(F.count_distinct("group_name"))
    kept = silver.staging_stats(data.full_stats, data.staged)
    for df in (per_metric, per_match, kept, data.team_match(["fouls"]), bronze.full_stats_kinds(data.stats_documents, data.full_matches)[0]):
        assert moves(df) == 0


def test_statistics_count_both_halves_and_the_whole(data):
    line = data.table("lineitem").where("l_orderkey is not null")
    halves = line.select("l_orderkey", F.when(F.col("l_linestatus") == "F", "1ST").otherwise("2ND").alias("period")).distinct()
    expected = halves.unionByName(line.select("l_orderkey", F.lit("ALL").alias("period"))).distinct()
    assert data.stats.select("match_id", "period").distinct().exceptAll(expected).isEmpty()
    assert expected.count() == data.stats.select("match_id", "period").distinct().count()


def test_line_items_are_sorted_before_they_turn_into_cells(data):
    build = next(c.cell_contents for c in Inputs.stat_cells.fget.__closure__ if getattr(c.cell_contents, "__name__", "") == "stat_cells")
    plan = plan_of(build(data))
    assert "Sort [match_id" in plan[plan.index("Generate"):] and "array_compact" not in plan and "filter(" not in plan


def test_documents_with_and_without_repeats(spark):
    text = '{"statistics":[{"period":"ALL","groups":[{"groupName":"g","statisticsItems":[{"name":"n","key":"%s"}]}]}]}'
    raw = spark.createDataFrame([(1, text % "a"), (2, text % "a"), (2, text % "b"), (None, text % "a")], "match_id bigint, data string")
    single, several = D.stat_document_kinds(raw)
    assert sorted(str(r.match_id) for r in single.collect()) == ["1", "None"]
    assert [(r.match_id, len(r.periods)) for r in several.collect()] == [(2, 2)]


def test_existence_tests_join_distinct_ids(spark):
    matches = spark.createDataFrame([(1, "finished", None), (2, "finished", "Removed"), (3, "finished", "Ended")], "match_id bigint, status_type string, status_description string")
    stats = spark.createDataFrame([(1,), (1,), (None,)], "match_id bigint")
    kept, missing = filters.stage_filter(matches, stats), joins.missing_from(matches, stats, ["match_id"])
    assert plan_of(kept).count("Join") == 1 and "HashAggregate" in plan_of(missing)
    assert sorted(r.match_id for r in kept.collect()) == [1, 3]
    assert sorted(r.match_id for r in missing.collect()) == [2, 3]


def test_statistics_are_stored_without_what_follows_from_them(data, spark):
    read = {name: getattr(data, name) for name in ("stats_documents", "full_stats")}
    stored = {name: spark.table(_WRITTEN[spark.sparkContext.applicationId, data.sf_dir, name]) for name in read}
    assert stored["stats_documents"].columns == ["match_id", "statistics"]
    derived = {"advantage", "home_percentage", "away_percentage", "value_difference", "has_numeric_values", "is_complete_statistic"}
    assert not derived & set(stored["full_stats"].columns) and derived < set(read["full_stats"].columns)
    # The ids are counted without forming a text, and the rows are those of the documents.
    ids = read["stats_documents"].where("data is not null").groupBy("match_id").count()
    assert moves(ids) == 0 and "statistics" not in plan_of(ids).replace("stats_documents", "")
    expected = bronze.full_stats_data(read["stats_documents"], data.full_matches)
    assert read["full_stats"].dtypes == expected.dtypes and expected.exceptAll(read["full_stats"]).isEmpty()
    assert expected.count() == read["full_stats"].count() == data.stat_cells.count()


def test_documents_are_in_either_envelope(data):
    text = data.stats_documents.select("match_id", "data").collect()
    assert all(r.data.startswith(f'{{"match_id":{r.match_id},"statistics":{{"statistics":[' if r.match_id % 2 == 0 else '{"statistics":[{"period":') for r in text)
    assert len(text) == data.stat_cells.select("match_id").distinct().count()


def test_statistics_are_not_sent_to_the_driver_to_find_matches_without(spark):
    matches = spark.createDataFrame(
        [(1, "finished"), (2, "finished"), (3, None), (None, "open")], "match_id bigint, status_type string"
    ).select("match_id", "status_type", *[F.lit(None).cast("string").alias(c) for c in (
        "start_timestamp", "status_description", "home_team_name", "away_team_name", "home_score_current", "away_score_current")])
    stats = spark.createDataFrame([(1,)] * 50 + [(None,)], "match_id bigint")
    found = reports.missing_stats(matches, stats)
    assert "Broadcast" not in plan_of(found) and "HashAggregate" in plan_of(found)
    assert sorted((str(r.match_id), r.should_have) for r in found.collect()) == [("2", True), ("3", False), ("None", False)]


@pytest.fixture
def unstored(spark, tmp_path):
    """The same tables under another path, so that no relation of them is stored yet."""
    (tmp_path / "data").symlink_to("/root/testdata/sf0.001")
    return Inputs(spark, str(tmp_path / "data"))


def same_rows(a, b) -> bool:
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_staging_asks_for_the_statistics_of_matches_in_doubt_only(unstored):
    staged = unstored.staged
    assert not unstored.is_written("full_stats") and not unstored.is_written("stats_documents")
    wanted = filters.in_doubt(unstored.full_matches)
    few = unstored.statistics_of(wanted)
    assert not few.isEmpty() and "collect_list" in plan_of(few)
    # From the documents and from the stored statistics it is the same.
    unstored.stats_documents
    from_documents = unstored.statistics_of(wanted)
    assert same_rows(few, from_documents) and "stats_documents" in plan_of(from_documents)
    assert same_rows(few, joins.found_in(unstored.full_stats, wanted, ["match_id"]).select(*few.columns))
    assert same_rows(staged, silver.staging_matches(unstored.full_matches, unstored.full_stats))
    gone = unstored.full_matches.join(staged, "match_id", "left_anti")
    assert not gone.where("status_description = 'Removed'").isEmpty() or staged.where("status_description = 'Removed'").count() > 0


def test_long_silver_table_needs_no_stored_statistics(unstored):
    values = unstored.side_values
    assert not unstored.is_written("full_stats") and not unstored.is_written("stats_documents")
    expected = silver.side_values(unstored.full_stats)
    assert same_rows(values.select(*expected.columns), expected) and moves(values.groupBy("match_id").count()) == 0


def test_several_documents_of_a_match_reach_the_long_silver_table(spark):
    text = '{"statistics":[{"period":"ALL","groups":[{"groupName":"g","statisticsItems":[{"name":"n","key":"%s","homeValue":1,"awayValue":2}]}]}]}'
    raw = spark.createDataFrame([(1, 5, text % "a"), (2, 5, text % "a"), (2, 5, text % "b")], "match_id bigint, tournament_id int, data string")
    matches = spark.createDataFrame([(1, 1999), (2, 1999)], "match_id bigint, season_id int")
    kinds = bronze.full_stats_kinds(raw, matches)
    assert [r.match_id for r in D.several_documents(raw).collect()] == [2]
    table = spark.table(silver.write_side_values(kinds[0], scratch_path(spark, "two-kinds"), 3, kinds[1:]))
    assert sorted((r.match_id, r.metric) for r in table.collect()) == [(1, "a"), (2, "a"), (2, "b")]


def test_bare_documents_are_parsed_as_such_first(spark):
    lists = '[{"period":"ALL","groups":[{"groupName":"g","statisticsItems":[{"name":"n","key":"k","homeValue":1.50}]}]}]'
    texts = [
        f'{{"statistics":{lists}}}', f'{{"match_id":4,"statistics":{{"statistics":{lists}}}}}', f' {{ "statistics" : {lists} , "x":1}}', f'{{"x":1,"statistics":{lists}}}',
        '{"statistics":[]}', '{"statistics":null}', "{}", "", "no json", f'{{"statistics":{lists}', f'{{"statistics":{lists},"statistics":{{"statistics":[]}}}}',
        f'{{"statistics":[],"statistics":{lists}}}', '{"statistics":[7]}', '{"statistics":["x",{"period":"ALL"}]}', '{"statistics":[{"period":{"a":1},"groups":7}]}', None,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "n int, data string")
    wrapped = F.from_json("data", schemas.STATS_WRAPPED)["statistics"]["statistics"]
    bare = F.from_json("data", schemas.STATS_BARE)["statistics"]
    rows = docs.select("n", F.to_json(D.stat_periods(F.col("data"))).alias("new"), F.to_json(F.coalesce(wrapped, bare)).alias("old")).collect()
    assert [(r.n, r.new) for r in rows] == [(r.n, r.old) for r in rows] and sum(r.new is not None for r in rows) > 5
    assert schemas.UNFIT in plan_of(docs.select(D.stat_periods(F.col("data")).alias("p")))
