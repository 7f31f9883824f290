import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sidewise.operators import loads as L
from sidewise.session import scratch_path

SCHEMA = "k int, ts int, v string"
SF = "/root/testdata/sf0.001"


def table(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_first_record_wins_within_and_against_the_target(spark):
    target = table(spark, (1, 0, "old"))
    source = table(spark, (1, 5, "x"), (2, 7, "late"), (2, 6, "early"), (None, 1, "no key"))
    got = L.insert_if_absent(target, source, ["k"], [F.asc("ts")])
    assert as_set(got) == {(1, 0, "old"), (2, 6, "early")}


def test_upsert_takes_the_newest_source_row(spark):
    target = table(spark, (1, 0, "old"), (3, 0, "kept"))
    source = table(spark, (1, 5, "a"), (1, 6, "b"), (2, 1, "new"))
    got = L.merge_upsert(target, source, ["k"], [F.desc("ts")])
    assert as_set(got) == {(1, 6, "b"), (2, 1, "new"), (3, 0, "kept")}


def test_high_water_mark_drops_late_rows_and_keys_do_not(spark):
    target, source = table(spark, (1, 10, "t")), table(spark, (2, 5, "late"), (3, 11, "new"))
    assert as_set(L.hwm_filter(source, target, "ts", default="0")) == {(3, 11, "new")}
    assert as_set(L.hwm_filter(source, target, "ts", mode="anti", keys=["k"])) == {(2, 5, "late"), (3, 11, "new")}
    with pytest.raises(ValueError):
        L.hwm_filter(source, target, "ts", mode="other")


def test_delete_insert_keeps_other_tenants(spark):
    target = table(spark, (1, 0, "a"), (2, 0, "b"), (3, 0, None))
    got = L.delete_insert(target, table(spark, (9, 9, "a")), "v", "a")
    assert as_set(got) == {(2, 0, "b"), (3, 0, None), (9, 9, "a")}


def test_schema_guard_names_the_difference(spark):
    L.schema_guard(table(spark), table(spark))
    with pytest.raises(ValueError, match="ts: bigint instead of int"):
        L.schema_guard(table(spark), table(spark).withColumn("ts", F.col("ts").cast("bigint")))


def test_partitioned_upsert_leaves_untouched_partitions(spark):
    path = scratch_path(spark, "upsert-test")
    table(spark, (1, 0, "p"), (2, 0, "p"), (3, 0, "q")).write.partitionBy("v").parquet(path)
    before = sorted(os.listdir(f"{path}/v=q"))
    n = L.upsert_partitions(spark, path, table(spark, (2, 8, "p"), (4, 1, "p")), ["k"], ["v"], [F.desc("ts")])
    assert n == 1
    assert as_set(spark.read.parquet(path).select("k", "ts", "v")) == {(1, 0, "p"), (2, 8, "p"), (3, 0, "q"), (4, 1, "p")}
    assert sorted(os.listdir(f"{path}/v=q")) == before


def test_load_counts_come_from_scanned_files(spark):
    counts = entry.queries()["report_load_counts"](spark, SF)
    assert any(f.endswith(".txt") for f in counts.inputFiles())
    events = spark.read.parquet(f"{SF}/events.parquet")
    got = {r["outcome"]: r["records"] for r in counts.collect()}
    assert got["malformed"] == events.where("event_id % 11 = 0").count() > 0
    assert sum(got.values()) == events.count()
