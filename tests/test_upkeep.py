"""States that take signed changes."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from registry.inputs import Inputs
from sidewise.plans import appearances as A
from sidewise.plans import upkeep
from sidewise.session import scratch_path

SCHEMA = "team int, season int, total decimal(12,2), n bigint"
KEYS, MEASURES = ["team", "season"], ["total", "n"]


@pytest.fixture
def root(spark):
    return scratch_path(spark, "upkeep-test")


def change(spark, *rows):
    return spark.createDataFrame(list(rows), "team int, season int, total double, n bigint").withColumn("total", F.col("total").cast("decimal(12,2)"))


def add(root, load, df):
    return upkeep.apply(root, load, df, KEYS, MEASURES, "season", "n")


def seen(spark, root):
    rows = upkeep.read(spark, root, change(spark).schema, "season").collect()
    return sorted(((r["team"], r["season"], float(r["total"]), r["n"]) for r in rows), key=repr)


def test_changes_add_up_and_rows_of_nothing_go(spark, root):
    assert seen(spark, root) == []
    add(root, 1, change(spark, (1, 10, 2.5, 1), (1, 10, 1.5, 1), (2, 10, 7.0, 1), (1, 11, 3.0, 1), (None, None, 1.0, 1)))
    add(root, 2, upkeep.negated(change(spark, (2, 10, 7.0, 1)), MEASURES).unionByName(change(spark, (1, 10, 0.25, 0))))
    assert seen(spark, root) == sorted([(1, 10, 4.25, 2), (1, 11, 3.0, 1), (None, None, 1.0, 1)], key=repr)
    add(root, 3, upkeep.negated(change(spark, (1, 11, 3.0, 1), (None, None, 1.0, 1)), MEASURES))
    assert seen(spark, root) == [(1, 10, 4.25, 2)]
    assert not add(root, 4, change(spark)) or seen(spark, root) == [(1, 10, 4.25, 2)]


def test_only_touched_partitions_are_written(spark, root):
    add(root, 1, change(spark, (1, 10, 1.0, 1), (1, 11, 1.0, 1)))
    add(root, 2, change(spark, (1, 11, 1.0, 1)))
    files = spark.read.parquet(f"{root}/state").where("load = 2").select("season").distinct().collect()
    assert [r["season"] for r in files] == [11]
    assert seen(spark, root) == [(1, 10, 1.0, 1), (1, 11, 2.0, 2)]


def test_a_load_counts_once_and_a_broken_one_not_at_all(spark, root, monkeypatch):
    first, second = change(spark, (1, 10, 1.0, 1)), change(spark, (1, 10, 5.0, 1))
    assert add(root, 1, first) and not add(root, 1, first)
    with monkeypatch.context() as broken:
        # The state is written, the log is not.
        coalesce = type(first).coalesce
        broken.setattr(type(first), "coalesce", lambda self, n: (_ for _ in ()).throw(OSError("the driver is gone")))
        with pytest.raises(OSError):
            add(root, 2, second)
        assert coalesce is not type(first).coalesce
    assert seen(spark, root) == [(1, 10, 1.0, 1)]
    assert add(root, 2, second) and seen(spark, root) == [(1, 10, 6.0, 2)]


def test_totals_read_the_state_and_no_statistics(spark, root):
    data = Inputs(spark, "/root/testdata/sf0.001")
    sums = A.summed(A.season_entries(data.fact, data.side_values))
    upkeep.apply(root, 1, sums, ["team_id", "season_id", "metric"], ["total", "nonzero", "n"], "season_id", "n")
    kept = A.totals_of(upkeep.read(spark, root, sums.schema, "season_id"))
    assert "side_values" not in plan_of(kept)
    as_rows = lambda df: {(r["team_id"], r["season_id"]): {k: tuple(v) for k, v in r["totals"].items()} for r in df.collect()}
    assert as_rows(kept) == as_rows(data.totals())
    assert kept.schema["totals"].dataType.simpleString() == data.totals().schema["totals"].dataType.simpleString()
