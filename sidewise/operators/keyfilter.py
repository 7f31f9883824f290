"""Bloom filters over the keys of a table, as rows of bitmaps.

A filter is a DataFrame with a bitmap per (bucket, segment).  A key's bucket and segment
come from one hash and its bits from further ones, so a filter of any size is built by a
partial aggregation, merged by another and looked up by an equi join; no task and no
driver holds it whole.  A key that the filter does not know is certainly absent; one that
it knows is perhaps present.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of one bitmap of Spark's bitmap functions.
SEGMENT_BITS = 32_768
#: Bits set per key, and the keys for which a segment is made: about one false hit in 150 when it is full.
PROBES, KEYS_PER_SEGMENT = 7, 3_000
SCHEMA = "bucket int, segment int, bits binary"


def canonical_key(df: DataFrame, on: Sequence[str]) -> list[Column]:
    """The key columns in a form in which equal keys have equal hashes; whole numbers of all widths are one type."""
    out = []
    for name in on:
        kind = df.schema[name].dataType
        if isinstance(kind, (T.FloatType, T.DoubleType)) or not isinstance(kind, T.AtomicType):
            raise ValueError(f"{name}: {kind.simpleString()} is no type for a key")
        out.append(F.col(f"`{name}`").cast("bigint") if isinstance(kind, T.IntegralType) else F.col(f"`{name}`"))
    return out


def key_type(df: DataFrame, on: Sequence[str]) -> list[str]:
    return ["bigint" if isinstance(t := df.schema[c].dataType, T.IntegralType) else t.simpleString() for c in on]


def bucket_of(df: DataFrame, on: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*canonical_key(df, on)), F.lit(buckets)).cast("int")


def segment_of(df: DataFrame, on: Sequence[str], segments: Column | int) -> Column:
    return F.pmod(F.xxhash64(F.lit("segment"), *canonical_key(df, on)), segments if isinstance(segments, Column) else F.lit(segments)).cast("int")


def positions(df: DataFrame, on: Sequence[str]) -> Column:
    """The bits of a key within its segment, from two hashes."""
    key = canonical_key(df, on)
    first, step = F.xxhash64(F.lit("first"), *key), F.xxhash64(F.lit("step"), *key)
    # The shift leaves room for the multiples; a step that is odd takes different bits.
    nth = [F.pmod(F.shiftright(first, 8) + n * F.shiftright(step, 8).bitwiseOR(F.lit(1)), F.lit(SEGMENT_BITS)) for n in range(PROBES)]
    return F.array(*nth)


def build(keys: DataFrame, on: Sequence[str], bucket: Column, segments: Column | int) -> DataFrame:
    """The filter of ``keys``; rows with a null in the key equal nothing and are left out."""
    usable = keys.where(~_any_null(on))
    bits = usable.select(bucket.alias("bucket"), segment_of(keys, on, segments).alias("segment"), F.explode(positions(keys, on)).alias("bit"))
    return bits.groupBy("bucket", "segment").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merged(*filters: DataFrame) -> DataFrame:
    """One filter of the keys of all; they must have the same numbers of buckets and segments."""
    out = filters[0]
    for other in filters[1:]:
        out = out.unionByName(other)
    return out.groupBy("bucket", "segment").agg(F.bitmap_or_agg("bits").alias("bits"))


def _holds(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def flagged(df: DataFrame, known: DataFrame, on: Sequence[str], bucket: Column, segments: Column | int, flag: str) -> DataFrame:
    """``df`` with a boolean column ``flag``: false where the filter ``known`` excludes the key."""
    columns = df.columns
    probe = df.select("*", bucket.alias("_bucket"), segment_of(df, on, segments).alias("_segment"), positions(df, on).alias("_positions"))
    bitmaps = known.toDF("_bucket", "_segment", "_bits")
    joined = probe.join(bitmaps, ["_bucket", "_segment"], "left")
    hit = F.coalesce(F.forall("_positions", lambda p: _holds(F.col("_bits"), p)), F.lit(False))
    return joined.select(*[f"`{c}`" for c in columns], (hit & ~_any_null(on)).alias(flag))


def missing_from(df: DataFrame, present: DataFrame, on: Sequence[str], known: DataFrame, segments: int) -> DataFrame:
    """Rows whose key is absent from ``present``, of whose keys ``known`` is a filter in one bucket.

    The same rows as the anti join, but only those that the filter does not exclude take
    part in it.
    """
    if key_type(df, on) != key_type(present, on):
        raise ValueError("both sides need keys of the same types")
    marked = flagged(df, known, on, F.lit(0), segments, "_perhaps")
    doubtful = marked.where("_perhaps").drop("_perhaps")
    return marked.where("not _perhaps").drop("_perhaps").unionByName(doubtful.join(present.select(*on), list(on), "left_anti"))


def _any_null(on: Sequence[str]) -> Column:
    out = F.lit(False)
    for name in on:
        out = out | F.col(f"`{name}`").isNull()
    return out
