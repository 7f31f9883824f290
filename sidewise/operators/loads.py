"""Incremental loading: append-if-new, upsert, replace-by-tenant, high-water marks.

The functions return the rows to write (or the new table content) as a plan.
``upsert_partitions`` is the sink for large tables: it rewrites only the
partitions that a batch touches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import missing_from
from .ranking import dedupe_latest


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Source rows to append: key not yet loaded, first record of the batch wins."""
    present = [F.col(k).isNotNull() for k in keys]
    usable = source.where(_all(present))
    return missing_from(dedupe_latest(usable, keys, order_by), target, keys)


def insert_if_absent(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[Column]
) -> DataFrame:
    return target.unionByName(new_rows(target, source, keys, order_by))


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[Column]
) -> DataFrame:
    """Source rows replace target rows of the same key; the newest source row wins.

    Only the batch is ranked.  The target passes through one anti join, which
    AQE turns into a broadcast join when the batch is small.
    """
    batch = dedupe_latest(source, keys, order_by)
    return missing_from(target, batch, keys).unionByName(batch)


def delete_insert(target: DataFrame, source: DataFrame, tenant: str, tenant_value: object) -> DataFrame:
    """All rows of one tenant make room for the fresh load."""
    kept = target.where(~F.col(tenant).eqNullSafe(F.lit(tenant_value)))
    return kept.unionByName(source)


def high_water_mark(target: DataFrame, ts: str, default: str = "1970-01-01") -> DataFrame:
    return target.agg(
        F.coalesce(F.max(ts), F.lit(default).cast(target.schema[ts].dataType)).alias("_mark")
    )


def hwm_filter(
    source: DataFrame,
    target: DataFrame,
    ts: str,
    mode: str = "hwm",
    keys: Sequence[str] = (),
    default: str = "1970-01-01",
) -> DataFrame:
    """Rows that are new against ``target``.

    ``mode="hwm"`` keeps rows strictly after the newest loaded timestamp, and so
    never picks up a late row; ``mode="anti"`` compares keys and does.
    """
    if mode == "anti":
        return missing_from(source, target, keys)
    if mode != "hwm":
        raise ValueError(f"unknown mode {mode!r}")
    # A one-row scalar subquery: Spark evaluates it once and filters the scan.
    mark = high_water_mark(target, ts, default)
    return source.where(F.col(ts) > mark.scalar())


def late_rows(source: DataFrame, target: DataFrame, ts: str, keys: Sequence[str]) -> DataFrame:
    """Rows that the high-water mark drops although their key was never loaded."""
    mark = high_water_mark(target, ts)
    return missing_from(source, target, keys).where(F.col(ts) <= mark.scalar())


def new_since_batch(df: DataFrame, batches: DataFrame, batch: str, on: Sequence[str], batch_value: object) -> DataFrame:
    """Detail rows of the keys that one batch loaded."""
    loaded = batches.where(F.col(batch) == F.lit(batch_value))
    return df.join(loaded.select(*on).distinct(), list(on), "left_semi")


def skip_existing(wanted: DataFrame, present: DataFrame, on: Sequence[str]) -> DataFrame:
    return missing_from(wanted, present, on)


def schema_guard(target: DataFrame, source: DataFrame) -> None:
    """Raise unless both have the same column names and types."""
    want = {f.name: f.dataType.simpleString() for f in target.schema}
    have = {f.name: f.dataType.simpleString() for f in source.schema}
    problems = [f"missing {c}" for c in want if c not in have]
    problems += [f"unexpected {c}" for c in have if c not in want]
    problems += [f"{c}: {have[c]} instead of {want[c]}" for c in want if c in have and have[c] != want[c]]
    if problems:
        raise ValueError("schema changed: " + "; ".join(problems))


def upsert_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
    order_by: Sequence[Column],
) -> int:
    """Upsert into a partitioned parquet table; returns the number of rewritten partitions.

    The partition columns must depend on the key.  A semi join on the touched
    partitions, which prunes the scan of the target at run time, leaves only their
    rows, and dynamic overwrite swaps exactly those partitions when the job commits.
    """
    touched = source.select(*partition_by).distinct()
    rewritten = touched.count()
    if not rewritten:
        return 0
    current = spark.read.schema(source.schema).parquet(path)
    in_scope = _all([current[c].eqNullSafe(touched[c]) for c in partition_by])
    merged = merge_upsert(current.join(touched, in_scope, "left_semi"), source, keys, order_by)
    (
        merged.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return rewritten


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out

