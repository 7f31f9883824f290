"""Writes that show whole or not at all."""

import pytest

from sidewise.session import scratch_path
from sidewise.sources import files as S
from sidewise.sources import snapshots

LAYOUT, BY = "league int, date string", ["league", "date"]


@pytest.fixture
def root(spark):
    return scratch_path(spark, "snapshot-test")


def rows(spark, *values):
    return spark.createDataFrame(list(values), "league int, date string, v int")


def seen(spark, root, version=None):
    return sorted(map(tuple, S.well_formed(snapshots.scan(spark, root, "v int", LAYOUT, version)).collect()), key=repr)


FIRST = [(1, "a", 1), (1, "a", 2), (1, "b", 3), (2, "a", 4), (None, "a", 5)]


def test_append_replace_and_full(spark, root):
    assert seen(spark, root) == []
    assert snapshots.write(rows(spark, *FIRST), root, LAYOUT, BY) == 1
    assert snapshots.write(rows(spark, (1, "b", 6)), root, LAYOUT, BY) == 2
    assert snapshots.write(rows(spark, (1, "a", 7), (None, "a", 8)), root, LAYOUT, BY, "replace") == 3
    assert seen(spark, root) == sorted([(1, "a", 7), (1, "b", 3), (1, "b", 6), (2, "a", 4), (None, "a", 8)], key=repr)
    assert seen(spark, root, 1) == sorted(FIRST, key=repr)
    snapshots.write(rows(spark, (9, "z", 9)), root, LAYOUT, BY, "full")
    assert seen(spark, root) == [(9, "z", 9)]
    with pytest.raises(ValueError):
        snapshots.write(rows(spark, (9, "z", 9)), root, LAYOUT, BY, "merge")


def test_named_partitions_are_emptied_without_new_rows(spark, root):
    snapshots.write(rows(spark, *FIRST), root, LAYOUT, BY)
    snapshots.write(rows(spark, *FIRST).limit(0), root, LAYOUT, BY, "replace", replaced=rows(spark, (1, "a", 0)))
    assert seen(spark, root) == sorted(FIRST[2:], key=repr)


def test_a_failure_before_the_commit_leaves_the_old_rows(spark, root, monkeypatch):
    snapshots.write(rows(spark, *FIRST), root, LAYOUT, BY)

    def lost(*_):
        raise OSError("the driver is gone")

    with monkeypatch.context() as broken:
        broken.setattr(snapshots, "_commit", lost)
        with pytest.raises(OSError):
            snapshots.write(rows(spark, (1, "a", 7)), root, LAYOUT, BY, "replace")
    assert seen(spark, root) == sorted(FIRST, key=repr) and snapshots.versions(spark, root) == [1]
    assert snapshots.write(rows(spark, (1, "a", 7)), root, LAYOUT, BY, "replace") == 2
    assert (1, "a", 7) in seen(spark, root) and (1, "a", 1) not in seen(spark, root)


def test_of_two_writers_the_second_builds_on_the_first(spark, root, monkeypatch):
    snapshots.write(rows(spark, *FIRST), root, LAYOUT, BY)
    commit, other = snapshots._commit, []

    def after_another(*args):
        if not other:
            other.append(True)
            snapshots.write(rows(spark, (3, "c", 10)), root, LAYOUT, BY)
        commit(*args)

    monkeypatch.setattr(snapshots, "_commit", after_another)
    assert snapshots.write(rows(spark, (1, "a", 7)), root, LAYOUT, BY, "replace") == 3
    assert seen(spark, root) == sorted([*FIRST[2:], (1, "a", 7), (3, "c", 10)], key=repr)


def test_vacuum_keeps_what_the_newest_versions_name(spark, root):
    for n in range(4):
        snapshots.write(rows(spark, (n % 2, "a", n)), root, LAYOUT, BY, "replace")
    before = seen(spark, root), seen(spark, root, 3)
    gone = snapshots.vacuum(spark, root, LAYOUT)
    assert (seen(spark, root), seen(spark, root, 3)) == before and snapshots.versions(spark, root) == [3, 4]
    assert sum("/data/" in g for g in gone) == 1 and sum("/snapshots/" in g for g in gone) == 2


def test_only_live_writes_are_listed(spark, root):
    for n in range(3):
        snapshots.write(rows(spark, (1, "a", n)), root, LAYOUT, BY, "replace")
    files = snapshots.scan(spark, root, "v int", LAYOUT).inputFiles()
    assert len({f.split("/write=")[1].split("/")[0] for f in files if "/data/" in f}) == 1
