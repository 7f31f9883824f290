"""Exact de-duplication over an index of cuckoo filters.

Texts are equal when they are identical after lower-casing A-Z.  The index keeps
the live rows (``members``), the texts bucketed by digest (``content``) and the
reference counts with their filters (``state``).  Rows can be added and taken away.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import refstore
from .common import fold_ascii, sha256_bytes, stored, texts

#: Digests that one shard holds on average; bounds the memory of a task.
KEYS_PER_SHARD = 1_024
#: Parts, by a hash of doc_id, in which a whole table enters the index, so that later parts meet live filters.
BATCHES = 2


@dataclass(frozen=True)
class ExactIndex:
    members: DataFrame
    content: DataFrame
    state: DataFrame
    shards: int


def _folded(docs: DataFrame) -> DataFrame:
    rows = texts(docs).select("doc_id", fold_ascii("text").alias("folded"))
    return rows.select("doc_id", sha256_bytes(F.col("folded")).alias("digest"), "folded")


def _collect_content(docs: DataFrame) -> DataFrame:
    """One row per digest of a batch, pre-aggregated with one text; a second hash proves that the others are the same."""
    c = F.col
    groups = _folded(docs).groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"),
        F.min("folded").alias("folded"), F.min(F.xxhash64("folded")).alias("low"), F.max(F.xxhash64("folded")).alias("high"),
    )
    clash = F.raise_error(F.lit("two texts share a digest")).cast("string")
    return groups.select("digest", "n", *refstore.IDS, F.when(c("low") == c("high"), c("folded")).otherwise(clash).alias("folded"))


def build(docs: DataFrame, keys_per_shard: int = KEYS_PER_SHARD, batches: int = BATCHES) -> ExactIndex:
    """Index of ``docs``, inserted in ``batches`` parts; the number of shards follows the number of rows."""
    shards = max(16, math.ceil(docs.count() / keys_per_shard))
    none = _folded(docs.limit(0))
    index = ExactIndex(none.drop("folded"), none.select("digest", "folded"), refstore.empty(docs.sparkSession), shards)
    part = F.pmod(F.xxhash64(F.col("doc_id").cast("bigint")), F.lit(batches))
    for n in range(batches):
        index = insert(index, docs.where(part == n))
    return index


def insert(index: ExactIndex, docs: DataFrame) -> ExactIndex:
    """The index with the rows of ``docs`` added.

    A digest that its shard's filter misses is admitted without a comparison; one that it
    hits is looked up among the shard's digests, and its text compared with the stored one.
    """
    content = stored(_collect_content(docs), "content")
    state = stored(refstore.insert(index.state, content.drop("folded"), index.shards), "exact-state")
    known = content.join(index.content.withColumnRenamed("folded", "stored"), "digest")
    if not known.where(F.col("folded") != F.col("stored")).isEmpty():
        raise ValueError("two texts share a digest")
    added = content.join(refstore.keys(index.state), "digest", "left_anti").select("digest", "folded")
    members = stored(_folded(docs).drop("folded"), "members")
    return ExactIndex(index.members.unionByName(members), index.content.unionByName(added), state, index.shards)


def delete(index: ExactIndex, ids: DataFrame) -> ExactIndex:
    """The index without the rows whose doc_id is in ``ids``; texts that nobody refers to are forgotten."""
    gone_ids = ids.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    match = index.members["doc_id"].eqNullSafe(gone_ids["doc_id"])
    members = stored(index.members.join(gone_ids, match, "left_anti"), "members")
    gone = index.members.join(gone_ids, match, "left_semi").groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    rest = members.join(gone.select("digest"), "digest", "left_semi").groupBy("digest").agg(
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
    )
    refs = gone.join(rest, "digest", "left")
    state = stored(refstore.delete(index.state, refs, index.shards), "exact-state")
    content = stored(index.content.join(refstore.keys(state), "digest", "left_semi"), "content")
    return ExactIndex(members, content, state, index.shards)


def decisions(index: ExactIndex) -> DataFrame:
    """One row per indexed row: doc_id, keep_id, group_size, kept, text_sha256.

    The row with the largest doc_id stays.  A null doc_id is smaller than all others;
    null and empty texts are equal; rows that repeat a doc_id and text are one
    document and decided alike, each counted in group_size.
    """
    groups = refstore.keys(index.state).select("digest", F.col("n").alias("group_size"), F.col("last_id").alias("keep_id"))
    return index.members.join(groups, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The decisions over an index of all of ``docs``."""
    return decisions(build(docs))
