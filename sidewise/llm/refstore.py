"""Sharded cuckoo filters backed by exact reference counts.

A state is a DataFrame with one row per live digest (``n`` references, smallest and
largest referring id) and one row per shard that carries the shard's filter
(``digest`` null).  All work on a shard happens in one group of at most about
``keys per shard`` digests, whatever the size of the table; digests reach it
pre-aggregated, so a digest that a third of all rows share is one row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .cuckoo import MAX_LOAD, SLOTS, CuckooFilter, buckets_for

STATE = (
    "shard bigint, digest binary, n bigint, first_id bigint, last_id bigint, "
    "filter binary, filter_hits bigint, false_hits bigint, resizes bigint"
)
COLUMNS = [part.split()[0] for part in STATE.split(", ")]
IDS = ["first_id", "last_id"]


def shard_of(digest: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(shards))


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE)


def keys(state: DataFrame) -> DataFrame:
    return state.where(F.col("digest").isNotNull()).select("shard", "digest", "n", *IDS)


def filters(state: DataFrame) -> DataFrame:
    return state.where(F.col("digest").isNull()).select("shard", "filter", "filter_hits", "false_hits", "resizes")


def counters(state: DataFrame) -> dict[str, int]:
    """Over all shards: filter hits, those of them that were false, and filters made anew."""
    names = ("filter_hits", "false_hits", "resizes")
    return filters(state).agg(*[F.sum(n).alias(n) for n in names]).first().asDict()


def _hashes(digests) -> np.ndarray:
    """Last eight bytes of every digest as numbers."""
    return np.frombuffer(b"".join(bytes(d)[-8:] for d in digests), np.uint64)


def _split(old: pd.DataFrame) -> tuple[pd.DataFrame, CuckooFilter, dict[str, int]]:
    head = old[old["digest"].isna()]
    live = old[old["digest"].notna()][["digest", "n", *IDS]].astype({"digest": object}).reset_index(drop=True)
    if len(head):
        row = head.iloc[0]
        return live, CuckooFilter.from_bytes(row["filter"]), {k: int(row[k]) for k in ("filter_hits", "false_hits", "resizes")}
    return live, CuckooFilter(1), {"filter_hits": 0, "false_hits": 0, "resizes": 0}


def _join(shard: int, live: pd.DataFrame, cuckoo: CuckooFilter, counts: dict[str, int]) -> pd.DataFrame:
    head = pd.DataFrame([{"filter": cuckoo.to_bytes(), **counts}])
    out = pd.concat([live, head], ignore_index=True).reindex(columns=COLUMNS)
    out["shard"] = shard
    for c in ("n", *IDS, "filter_hits", "false_hits", "resizes"):
        out[c] = out[c].astype("Int64")
    return out.astype({"digest": object, "filter": object}).where(out.notna(), None)


def _inserted(key: tuple, new: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
    live, cuckoo, counts = _split(old)
    if not len(new):
        return _join(key[0], live, cuckoo, counts)
    hashes = _hashes(new["digest"])
    hit = cuckoo.contains(hashes)
    # A hit only says "perhaps": the stored digests decide.
    at = np.full(len(new), -1)
    if hit.any():
        at[hit] = pd.Index([bytes(d) for d in live["digest"]]).get_indexer([bytes(d) for d in new["digest"][hit]])
    known, fresh = at >= 0, at < 0
    counts["filter_hits"] += int(hit.sum())
    counts["false_hits"] += int((hit & fresh).sum())
    rows, where = new[known], at[known]
    live.loc[where, "n"] = live.loc[where, "n"].to_numpy() + rows["n"].to_numpy()
    for c, smaller in (("first_id", True), ("last_id", False)):
        both = pd.DataFrame({"a": live.loc[where, c].to_numpy(), "b": rows[c].to_numpy()}, dtype="Int64")
        live[c] = live[c].astype("Int64")
        live.loc[where, c] = (both.min(axis=1) if smaller else both.max(axis=1)).to_numpy()
    added = new[fresh][["digest", "n", *IDS]]
    live = pd.concat([live, added], ignore_index=True) if len(live) else added.reset_index(drop=True)
    roomy = len(live) <= cuckoo.table.size * MAX_LOAD
    if not roomy or not cuckoo.insert(hashes[fresh]):
        # Overflow: a larger filter from the stored keys.
        cuckoo = CuckooFilter.of(_hashes(live["digest"]), max(buckets_for(len(live)), 2 * cuckoo.table.size // SLOTS if roomy else 1))
        counts["resizes"] += 1
    return _join(key[0], live, cuckoo, counts)


def _deleted(key: tuple, gone: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
    live, cuckoo, counts = _split(old)
    if not len(gone) or not len(live):
        return _join(key[0], live, cuckoo, counts)
    at = pd.Index([bytes(d) for d in live["digest"]]).get_indexer([bytes(d) for d in gone["digest"]])
    gone, at = gone[at >= 0], at[at >= 0]
    live.loc[at, "n"] = live.loc[at, "n"].to_numpy() - gone["n"].to_numpy()
    for c in IDS:
        live[c] = live[c].astype("Int64")
        live.loc[at, c] = pd.array(gone[c], dtype="Int64")
    dead = live["n"].to_numpy() <= 0
    cuckoo.delete(_hashes(live["digest"][dead]))
    return _join(key[0], live[~dead], cuckoo, counts)


def _apply(state: DataFrame, refs: DataFrame, shards: int, update) -> DataFrame:
    batch = refs.select(shard_of(F.col("digest"), shards).alias("shard"), "digest", "n", *IDS)
    # One row of a shard's keys per digest: the cogroup touches each shard once.
    return batch.groupBy("shard").cogroup(state.groupBy("shard")).applyInPandas(update, STATE)


def insert(state: DataFrame, refs: DataFrame, shards: int) -> DataFrame:
    """``state`` with ``refs`` (digest, n, first_id, last_id; one row per digest) added."""
    return _apply(state, refs, shards, _inserted)


def delete(state: DataFrame, refs: DataFrame, shards: int) -> DataFrame:
    """``state`` without ``refs``: digest, references taken away, and the ids that remain (null: none)."""
    return _apply(state, refs, shards, _deleted)
