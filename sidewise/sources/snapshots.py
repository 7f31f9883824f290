"""Partitioned line-delimited JSON whose writes become visible all at once.

    root/data/write=<id>/<partition folders>/    files of one write, never changed again
    root/snapshots/<id>/                         parquet: which write holds which partition
    root/log/<number>                            names the snapshot that this number stands for

A write adds files and a snapshot, then commits by renaming one small file to the next
number of the log.  The rename fails if the number is taken, so of two writers one comes
second and puts its partitions on top of what the first committed.  Until the rename,
readers see the snapshot before; files of a write that never got there are in no
snapshot.  Nothing is overwritten or deleted in place; ``vacuum`` removes what no kept
snapshot names.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import CORRUPT, data_files, typed_lines

WRITE = "write"
MODES = ("append", "replace", "full")


class Conflict(RuntimeError):
    """Another writer took the number."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _names(spark: SparkSession, folder: str) -> list[str]:
    where = _path(spark, folder)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed numbers, oldest first."""
    return [int(name) for name in _names(spark, f"{root}/log") if name.isdigit()]


def _snapshot_of(spark: SparkSession, root: str, version: int) -> str:
    return spark.read.text(f"{root}/log/{version:010d}").first()[0]


def _commit(spark: SparkSession, root: str, version: int, snapshot: str) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    waiting, final = _path(spark, f"{root}/log/.{snapshot}"), _path(spark, f"{root}/log/{version:010d}")
    out = waiting.getFileSystem(conf).create(waiting, True)
    out.write(bytearray(snapshot.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(waiting.getFileSystem(conf).getUri(), conf)
    unforced = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(waiting, final, unforced)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception):
            raise Conflict(f"{root}: {version}") from error
        raise


def entries(spark: SparkSession, root: str, layout: str, version: int | None = None) -> DataFrame:
    """Partition values and the write that holds them, as of ``version`` (default: the newest); empty without one."""
    schema = f"{layout}, {WRITE} string"
    known = versions(spark, root)
    if version is None and not known:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/snapshots/{_snapshot_of(spark, root, known[-1] if version is None else version)}")


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]):
    return reduce(lambda a, b: a & b, (left[n].eqNullSafe(right[n]) for n in names))


def write(
    df: DataFrame, root: str, layout: str, by: Sequence[str], mode: str = "append",
    replaced: DataFrame | None = None, max_records: int = 1_000_000,
) -> int:
    """Add the rows of ``df`` in ``by`` folders, typed by ``layout``, and commit; returns the new version.

    ``append`` keeps all there is, ``replace`` drops the partitions that ``df`` has rows
    for and those that ``replaced`` (columns ``by``) names, ``full`` drops everything.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    spark, own = df.sparkSession, uuid.uuid4().hex
    folder = f"{root}/data/{WRITE}={own}"
    df.hint("rebalance", *by).write.partitionBy(*by).option("maxRecordsPerFile", max_records).json(folder)
    if any("=" in name for name in _names(spark, folder)):
        new = data_files(spark, folder, layout, "*.json").select(*by).distinct().withColumn(WRITE, F.lit(own))
    else:
        new = spark.createDataFrame([], f"{layout}, {WRITE} string").select(*by, WRITE)
    gone = new.select(*by) if replaced is None else new.select(*by).unionByName(replaced.select(*by).distinct())
    while True:
        known = versions(spark, root)
        old = entries(spark, root, layout).select(*by, WRITE)
        if mode == "replace":
            old = old.join(gone, _same(old, gone, by), "left_anti")
        snapshot = uuid.uuid4().hex
        (new if mode == "full" else old.unionByName(new)).write.parquet(f"{root}/snapshots/{snapshot}")
        version = known[-1] + 1 if known else 1
        try:
            _commit(spark, root, version, snapshot)
        except Conflict:
            continue
        return version


def scan(spark: SparkSession, root: str, schema: str, layout: str, version: int | None = None) -> DataFrame:
    """Records as of ``version`` (default: the newest), typed by ``schema`` like those of ``scan_ndjson``.

    Only folders of writes that the snapshot names are listed; of these the join keeps
    the partitions that were not replaced since.
    """
    live = entries(spark, root, layout, version)
    partitions = [c for c in live.columns if c != WRITE]
    # One row per write that still holds a partition; a full write starts anew.
    writes = [row[0] for row in live.select(WRITE).distinct().collect()]
    if not writes:
        return spark.createDataFrame([], f"{layout}, {schema}, {CORRUPT} string")
    paths = [f"{root}/data/{WRITE}={name}" for name in writes]
    lines = spark.read.schema(f"value string, {WRITE} string, {layout}").option("basePath", f"{root}/data").text(paths)
    kept = lines.where(F.trim("value") != "").join(live, _same(lines, live, [*partitions, WRITE]), "left_semi")
    return typed_lines(kept.withColumnRenamed("value", "data"), schema, partitions)


def vacuum(spark: SparkSession, root: str, layout: str, keep: int = 2) -> list[str]:
    """Delete files and snapshots that the ``keep`` newest versions don't name; returns the deleted folders.

    Not to be run beside a writer, whose files are in no snapshot yet.
    """
    if keep < 1:
        raise ValueError("keep must be positive")
    known = versions(spark, root)
    kept = known[-keep:]
    snapshots = {_snapshot_of(spark, root, v) for v in kept}
    named = {f"{WRITE}={r[0]}" for v in kept for r in entries(spark, root, layout, v).select(WRITE).distinct().collect()}
    gone = [f"{root}/log/{v:010d}" for v in known[:-keep]]
    gone += [f"{root}/snapshots/{n}" for n in _names(spark, f"{root}/snapshots") if n not in snapshots]
    gone += [f"{root}/data/{n}" for n in _names(spark, f"{root}/data") if n.startswith(f"{WRITE}=") and n not in named]
    for path in gone:
        where = _path(spark, path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return gone
