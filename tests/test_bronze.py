"""Statistics counted inside the document, matches from stored variants."""

import json
import random
from collections import Counter, defaultdict

from conftest import plan_of

from registry.inputs import Inputs
from sidewise.operators import documents as D
from sidewise.plans import bronze
from sidewise.session import scratch_path, write_bucketed

SF = "/root/testdata/sf0.001"
COUNTS = ["stat_order_in_group", "stats_count_in_group", "statistics_in_period", "total_statistics_count", "periods_count", "groups_count"]


def random_document(rng, wrapped):
    """Periods and groups may repeat, be empty, null or nameless; keys may be missing."""
    item = lambda: {k: v for k, v in (("key", rng.choice(["a", "b", "c", "d", None])), ("name", rng.choice("xyz")), ("homeValue", rng.randrange(9))) if v is not None}
    group = lambda: {"groupName": rng.choice(["G", "H", "I", None]), "statisticsItems": rng.choice([None, [], [item() for _ in range(rng.randrange(1, 6))]])}
    periods = [{"period": rng.choice(["ALL", "1ST", "2ND", None]), "groups": rng.choice([None, [group() for _ in range(rng.randrange(5))]])} for _ in range(rng.randrange(5))]
    return json.dumps({"statistics": {"statistics": periods} if wrapped else periods})


def expected_counts(documents):
    items = defaultdict(list)
    for number, (match, text) in enumerate(documents):
        inner = json.loads(text)["statistics"]
        for p in inner["statistics"] if isinstance(inner, dict) else inner:
            for g in p["groups"] or []:
                for i in g["statisticsItems"] or []:
                    items[match if match is not None else ("own", number)].append((p["period"], g["groupName"], i.get("key"), i["name"], i["homeValue"]))
    out = Counter()
    first = lambda v: (v is not None, v or "")
    for match, rows in items.items():
        groups = defaultdict(list)
        for row in rows:
            groups[row[:2]].append(row)
        in_period = Counter(row[0] for row in rows)
        per_match = len(rows), len({r[0] for r in rows} - {None}), len({r[1] for r in rows} - {None})
        for (period, group), members in groups.items():
            for n, (_, _, key, name, value) in enumerate(sorted(members, key=lambda r: (first(r[2]), r[3], r[4]))):
                out[(match if isinstance(match, int) else None, period, group, key, name, value, n + 1, len(members), in_period[period], *per_match)] += 1
    return out


def test_counts_of_any_document_match_brute_force(spark):
    rng = random.Random(7)
    documents = [(rng.choice([*range(25), None]), random_document(rng, rng.random() < 0.5)) for _ in range(60)]
    raw = spark.createDataFrame([(m, 9, t) for m, t in documents] + [(3, 9, None), (99, 9, "{}")], "match_id int, tournament_id int, data string")
    rows = D.explode_counted_stats(D.stat_documents(raw, carried=["tournament_id"]), ["match_id", "tournament_id"])
    assert {r.tournament_id for r in rows.select("tournament_id").distinct().collect()} == {9}
    columns = ["match_id", "period", "group_name", "statistic_key", "statistic_name", "home_value_numeric", *COUNTS]
    assert Counter(tuple(r) for r in rows.select(columns).collect()) == expected_counts(documents)


def test_documents_that_repeat_a_match_count_as_one(spark):
    one = '{"statistics":[{"period":"ALL","groups":[{"groupName":"G","statisticsItems":[{"key":"b","name":"n"}]}]}]}'
    two = '{"statistics":{"statistics":[{"period":"ALL","groups":[{"groupName":"G","statisticsItems":[{"key":"a","name":"n"}]}]}]}}'
    raw = spark.createDataFrame([(1, 5, one), (1, 4, two), (2, 6, one)], "match_id int, tournament_id int, data string")
    matches = spark.createDataFrame([(1, 24)], "match_id int, season_id int")
    got = {(r.match_id, r.tournament_id, r.season_id, r.statistic_key): tuple(r[c] for c in COUNTS) for r in bronze.full_stats_data(raw, matches).collect()}
    assert got == {(1, 4, 24, "a"): (1, 2, 2, 2, 1, 1), (1, 4, 24, "b"): (2, 2, 2, 2, 1, 1), (2, 6, None, "b"): (1, 1, 1, 1, 1, 1)}


def test_stored_documents_are_not_shuffled_by_match(spark):
    data = Inputs(spark, SF)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(bronze.full_stats_data(data.stats_documents, data.matches))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Window" not in plan
    assert "Exchange" not in plan


def test_bucketed_tables_keep_their_rows(spark):
    df = spark.range(100).selectExpr("id % 7 as k", "id as v")
    name = write_bucketed(df, scratch_path(spark, "bucket-test"), "k")
    back = spark.table(name)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert "Exchange" not in plan_of(back.groupBy("k").count())


def test_variant_and_text_give_the_same_matches(spark):
    data = Inputs(spark, SF)
    assert data.match_variants.schema["data"].dataType.typeName() == "variant"
    text, variant = D.flatten_match_json(data.match_documents), D.flatten_match_json(data.match_variants)
    assert text.schema == variant.schema
    assert text.exceptAll(variant).isEmpty() and variant.exceptAll(text).isEmpty()


def test_a_variant_scan_reads_the_paths_in_use_only(spark):
    rows = D.flatten_match_json(Inputs(spark, SF).match_variants)
    read = plan_of(rows.select("match_id", "season_year")).split("ReadSchema: ", 1)[1].split("\n")[0]
    assert read.count("string") == 2 and "1:string" in read


def test_broken_text_is_no_variant(spark):
    raw = spark.createDataFrame([(1, '{"id":1}'), (2, '{"id":'), (3, None)], "n int, data string")
    assert [r.match_id for r in D.flatten_match_json(D.as_variant(raw)).collect()] == [1]
