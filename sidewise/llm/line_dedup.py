"""Reversible removal of lines that repeat across documents.

The index keeps which documents hold which line keys (``postings``) and, per key,
exact counts behind sharded cuckoo filters (``state``).  Documents can be added and
deleted; a deleted document gives its lines back to the next one that holds them.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import refstore
from .common import free_name, on_arrow, stored, texts

#: Code points that a key needs to count, and keys that a shard holds on average.
LEAST_CHARS = 10
KEYS_PER_SHARD = 8_192
#: Parts, by a hash of doc_id, in which a whole table enters the index, so that later parts meet live filters.
BATCHES = 2


def line_digest(line: bytes) -> bytes | None:
    """128 bits of the SHA-256 of a line's key: stripped, A-Z lower-cased; None for short keys."""
    key = line.strip().lower()
    # bytes.strip() takes off x20 and x09 to x0D, bytes.lower() folds A-Z only.
    if len(key) < LEAST_CHARS or len(key) < 4 * LEAST_CHARS and len(key.decode()) < LEAST_CHARS:
        return None
    return hashlib.sha256(key).digest()[:16]


@on_arrow(pa.list_(pa.binary()))
def line_digests(text: pa.Array) -> pa.Array:
    """Distinct key digests of a text."""
    return pa.array(({d for line in t.encode().split(b"\n") if (d := line_digest(line))} for t in text.to_pylist()), pa.list_(pa.binary()))


_CLEANED = pa.struct([("text", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())])


@on_arrow(_CLEANED)
def without_lines(text: pa.Array, dropped: pa.Array) -> pa.Array:
    out = []
    for content, gone in zip(text.to_pylist(), dropped.to_pylist()):
        n = content.count("\n") + 1
        if gone:
            gone = set(gone)
            kept = [line for line in content.encode().split(b"\n") if line_digest(line) not in gone]
            out.append((b"\n".join(kept).decode(), n, n - len(kept)))
        else:
            out.append((content, n, 0))
    names = [f.name for f in _CLEANED]
    return pa.array([dict(zip(names, row)) for row in out], _CLEANED)


@dataclass(frozen=True)
class LineIndex:
    postings: DataFrame
    state: DataFrame
    shards: int


def _postings(docs: DataFrame) -> DataFrame:
    return texts(docs).select("doc_id", F.explode(line_digests("text")).alias("digest")).distinct()


def _references(postings: DataFrame) -> DataFrame:
    return postings.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))


def build(docs: DataFrame, keys_per_shard: int = KEYS_PER_SHARD, batches: int = BATCHES) -> LineIndex:
    """Index of ``docs``, inserted in ``batches`` parts; the number of shards follows the number of lines.

    A key that its shard's filter misses is admitted at once; one that it hits is looked up among the shard's keys.
    """
    postings = stored(_postings(docs), "postings")
    shards = max(16, math.ceil(postings.count() / keys_per_shard))
    state = refstore.empty(docs.sparkSession)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    for n in range(batches):
        state = stored(refstore.insert(state, _references(postings.where(part == n)), shards), "line-state")
    return LineIndex(postings, state, shards)


def insert(index: LineIndex, docs: DataFrame) -> LineIndex:
    """The index with ``docs`` added; pairs of line and document that it has already are not counted twice."""
    same_pair = lambda a, b: (a["digest"] == b["digest"]) & a["doc_id"].eqNullSafe(b["doc_id"])
    batch = _postings(docs)
    new = stored(batch.join(index.postings, same_pair(batch, index.postings), "left_anti"), "postings")
    state = stored(refstore.insert(index.state, _references(new), index.shards), "line-state")
    return LineIndex(index.postings.unionByName(new), state, index.shards)


def delete(index: LineIndex, ids: DataFrame) -> LineIndex:
    """The index without the documents whose doc_id is in ``ids``."""
    gone_ids = ids.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    match = index.postings["doc_id"].eqNullSafe(gone_ids["doc_id"])
    rest = stored(index.postings.join(gone_ids, match, "left_anti"), "postings")
    gone = index.postings.join(gone_ids, match, "left_semi").groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    left = _references(rest.join(gone.select("digest"), "digest", "left_semi")).drop("n")
    state = stored(refstore.delete(index.state, gone.join(left, "digest", "left"), index.shards), "line-state")
    return LineIndex(rest, state, index.shards)


def clean(index: LineIndex, docs: DataFrame, report: str = "lines") -> DataFrame:
    """``docs`` with ``text`` cleaned and a struct column ``report`` (n_lines, n_dropped) added.

    A key of at least ten code points that two or more documents hold keeps its lines
    in the smallest doc_id only, all of them.  A null doc_id is larger than all others;
    all rows with a null id, and all rows that repeat an id, are one document.  Null and
    empty texts are one empty line (null stays null).  All other columns stay; if
    ``report`` is taken, underscores are added to its name.
    """
    c = F.col
    shared = refstore.keys(index.state).where(c("n") >= 2).select("digest", "first_id")
    drops = index.postings.join(shared, "digest").where(~c("doc_id").eqNullSafe(c("first_id")))
    # No longer than the lines of one document.
    drops = drops.groupBy(c("doc_id").alias("of")).agg(F.collect_list("digest").alias("gone")).select("of", "gone")
    of, gone, report = free_name(docs, "of_id"), free_name(docs, "gone"), free_name(docs, report)
    drops = drops.toDF(of, gone).hint("shuffle_hash")
    joined = docs.join(drops, docs["doc_id"].cast("bigint").eqNullSafe(c(of)), "left")
    cleaned = joined.withColumn(report, without_lines(F.coalesce("text", F.lit("")), c(gone)))
    columns = [F.when(c("text").isNotNull(), c(report)["text"]).alias("text") if name == "text" else c(f"`{name}`") for name in docs.columns]
    return cleaned.select(*columns, F.struct(c(report)["n_lines"].alias("n_lines"), c(report)["n_dropped"].alias("n_dropped")).alias(report))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the digest of what stays."""
    rows = clean(build(docs), texts(docs))
    return rows.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("text", 256).alias("kept_sha256"))
