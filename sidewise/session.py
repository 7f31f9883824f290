"""Session defaults and the shared scratch location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "sidewise", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time, AQE and skew handling on; ``conf`` overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session (tests, the driver's check) may fall back to a
    temporary folder; on a cluster an unset setting is an error, because a
    machine-local folder would be lost with its executor.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="sidewise-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex[:12]}")


def write_bucketed(
    df: DataFrame, path: str, key: str, buckets: int | None = None, order: str | None = None, folders: Sequence[str] = (), more: Sequence[DataFrame] = (),
    in_order: bool = False,
) -> str:
    """Write ``df`` below ``path`` in sorted buckets of ``key`` and return the table's name.

    Tables bucketed by one key join and aggregate on it without a shuffle, if they have
    the same number of ``buckets``: the session's shuffle partitions unless stated.  Rows
    that are dealt by the key already are not moved.  Buckets are sorted by ``order``, else
    by the key; ``folders`` are columns that get a folder per value.  ``more`` are frames whose
    rows follow: each is written on its own, as a union may lose track of the buckets.
    ``in_order`` writes rows as they come, without a sort: for frames that follow the order
    of stored buckets and have grown in width or number since.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = re.sub(r"\W", "_", os.path.basename(path))
    for part in (df, *more):
        writer = part.repartition(buckets, key).write.bucketBy(buckets, key)
        writer = (writer if in_order else writer.sortBy(order or key)).partitionBy(*folders)
        # Stored buckets are read one per task, not packed by size; so a task writes one file and need not sort for it.
        conf = {"spark__sql__sources__bucketing__autoBucketedScan__enabled": "false"}
        if in_order:
            conf["spark__sql__maxConcurrentOutputFileWriters"] = "1"
        with set_conf(spark, **conf):
            writer.option("path", path).option("compression", "zstd").mode("append").saveAsTable(name)
    return name


@contextmanager
def set_conf(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings, with ``__`` for a dot, that hold inside the block only."""
    before = {key.replace("__", "."): spark.conf.get(key.replace("__", "."), None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key.replace("__", "."), value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
