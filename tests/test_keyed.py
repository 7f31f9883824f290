"""Bloom filters over keys, and the bucketed table that keeps the first record of every key."""

import pytest
from pyspark.sql import functions as F

from sidewise.operators import joins, keyfilter
from sidewise.session import scratch_path
from sidewise.sources import keyed
from sidewise.streaming import ingest

SCHEMA = "k bigint, at int, v string"


@pytest.fixture
def root(spark):
    return scratch_path(spark, "keyed-test")


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def seen(spark, root):
    return sorted(map(tuple, keyed.scan(spark, root, SCHEMA).select("k", "at", "v").collect()), key=repr)


def add(df, root, **how):
    return keyed.insert(df, root, ["k"], [F.asc("at")], buckets=8, **how)


def test_a_filter_knows_its_keys_and_hardly_any_other(spark):
    keys = spark.range(6_000).withColumnRenamed("id", "k")
    known = keyfilter.build(keys, ["k"], F.lit(0), 2)
    both = spark.range(40_000).select(F.col("id").cast("int").alias("k"))
    marked = keyfilter.flagged(both, known, ["k"], F.lit(0), 2, "perhaps")
    counts = {r["inside"]: r["n"] for r in marked.where("perhaps").groupBy((F.col("k") < 6_000).alias("inside")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts[True] == 6_000 and 0 < counts[False] < 34_000 * 0.02
    halves = [keyfilter.build(keys.where(F.col("k") % 2 == n), ["k"], F.lit(0), 2) for n in (0, 1)]
    bits = lambda f: {(r["segment"], bytes(r["bits"])) for r in f.collect()}
    assert bits(keyfilter.merged(*halves)) == bits(known)


def test_prefiltered_anti_join_equals_the_anti_join_with_forced_false_hits(spark):
    present = spark.range(0, 60_000, 3).select(F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id") % 7).alias("name"))
    wanted = spark.range(5_000).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("n"), F.col("id") % 7).alias("name")).unionByName(
        spark.createDataFrame([(None, "n1"), (3, None), (3, "other")], "k int, name string")
    )
    for on in (["k"], ["k", "name"]):
        # One segment for 20,000 keys: nearly every key is "perhaps" there.
        known = keyfilter.build(present, on, F.lit(0), 1)
        hits = keyfilter.flagged(wanted, known, on, F.lit(0), 1, "perhaps").where("perhaps").count()
        assert hits > wanted.count() * 0.9
        got = keyfilter.missing_from(wanted, present, on, known, 1)
        expected = joins.missing_from(wanted, present, on)
        assert sorted(map(tuple, got.select("k", "name").collect()), key=repr) == sorted(map(tuple, expected.select("k", "name").collect()), key=repr)


def test_keys_of_unlike_types_are_refused(spark):
    number, text = spark.range(3).toDF("k"), spark.range(3).select(F.col("id").cast("string").alias("k"))
    with pytest.raises(ValueError, match="same types"):
        keyfilter.missing_from(number, text, ["k"], keyfilter.build(text, ["k"], F.lit(0), 1), 1)
    with pytest.raises(ValueError, match="no type for a key"):
        keyfilter.build(number.select(F.col("k").cast("double").alias("k")), ["k"], F.lit(0), 1)


def test_first_record_of_a_key_stays(spark, root):
    assert seen(spark, root) == []
    assert add(rows(spark, (1, 5, "b"), (1, 4, "a"), (2, 1, "c")), root)["added"] == 2
    assert add(rows(spark, (1, 0, "late"), (3, 1, "d"), (3, 2, "e")), root)["added"] == 1
    assert add(rows(spark), root)["added"] == 0
    assert seen(spark, root) == [(1, 4, "a"), (2, 1, "c"), (3, 1, "d")]
    assert keyed.committed(spark, root) == [0, 1, 2]


def test_nulls_equal_no_key(spark, root):
    add(rows(spark, (None, 1, "a"), (1, 1, "b")), root)
    assert add(rows(spark, (None, 1, "c"), (1, 1, "d")), root)["added"] == 1
    assert seen(spark, root) == sorted([(None, 1, "a"), (None, 1, "c"), (1, 1, "b")], key=repr)


def test_a_small_batch_reads_the_buckets_it_falls_in_and_new_keys_none(spark, root):
    many = spark.range(20_000).select(F.col("id").alias("k"), F.lit(1).alias("at"), F.lit("x").alias("v"))
    assert add(many, root) == {"added": 20_000, "excluded": 20_000, "buckets_read": 0}
    again = add(rows(spark, (5, 2, "y"), (5, 3, "z")), root)
    assert again == {"added": 0, "excluded": 0, "buckets_read": 1}
    new = add(many.withColumn("k", F.col("k") + 1_000_000), root)
    assert new["added"] == 20_000 and new["excluded"] > 19_400
    read = keyed.scan(spark, root, SCHEMA, [3]).inputFiles()
    assert read and all("/bucket=3/" in f for f in read)
    # Twice the keys need twice the segments: the filters were made anew from the stored keys.
    assert {r["segments"] for r in keyed.log(spark, root).where("load = 0").collect()} == {1}
    assert {r["segments"] for r in keyed.log(spark, root).where("load = 2").collect()} == {2}
    assert add(many, root)["added"] == 0 and keyed.scan(spark, root, SCHEMA).count() == 40_000


@pytest.mark.parametrize("step", ["_added", "_write_filters", "_segments"])
def test_a_load_that_breaks_off_is_not_seen_and_can_be_repeated(spark, root, monkeypatch, step):
    add(rows(spark, (1, 1, "a")), root, load=0)

    def lost(*_):
        raise OSError("the driver is gone")

    with monkeypatch.context() as broken:
        broken.setattr(keyed, step, lost)
        with pytest.raises(OSError):
            add(rows(spark, (1, 2, "b"), (2, 1, "c")), root, load=1)
    assert seen(spark, root) == [(1, 1, "a")]
    assert add(rows(spark, (1, 2, "b"), (2, 1, "c")), root, load=1)["added"] == 1
    assert add(rows(spark, (9, 9, "replayed")), root, load=1)["added"] == 0
    assert seen(spark, root) == [(1, 1, "a"), (2, 1, "c")]


def test_stream_in_several_batches(spark, root):
    source = scratch_path(spark, "keyed-source")
    for part in ([(1, 1, "a"), (2, 1, "b")], [(2, 2, "c"), (3, 1, "d")], [(1, 0, "late")]):
        rows(spark, *part).coalesce(1).write.mode("append").json(source)
    stream = ingest.read_ndjson_stream(spark, source, SCHEMA, max_files=1)
    ingest.stream_upsert(stream, root, scratch_path(spark, "keyed-progress"), ["k"], ["at"], buckets=4).awaitTermination()
    assert len(keyed.committed(spark, root)) == 3
    assert [k for k, _, _ in seen(spark, root)] == [1, 2, 3]
