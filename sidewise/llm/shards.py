"""Proportional stratified interleaving: shards that all have the mixture of the whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of shuffle keys, and of fractional ranks, that are numbered on their own.
RANGES = 4_096


def assign(docs: DataFrame, shards: int = 16, seed: str = "interleave", carry: list[str] | None = None) -> DataFrame:
    """doc_id, source, size, text_crc32, position, shard and slot of every row (law: rows).

    Rows of a source are shuffled by a seeded hash and ranked; the fractional rank
    (rank - 1/2) / rows spreads each source evenly over 0 to 1, and the order by it is
    cut into ``shards`` parts whose sizes differ by one row at most.

    Ranks come from counts: rows are numbered inside (source, range of hash) and
    inside (range of fractional rank), ranges are added up by their counts.  No window
    holds a whole source, so a hot source is as well divided as any other.

    A null source counts as the empty one, a null text as no bytes, a null doc_id as an
    id of its own (hashed as empty).  Rows that repeat a doc_id are ordered by text
    digest; identical rows are interchangeable, all are placed.  ``carry`` names input
    columns to keep, inside the struct column ``row``.
    """
    c = F.col
    content = F.coalesce("text", F.lit("")).cast("binary")
    kept = [F.struct(*[c(f"`{name}`") for name in carry]).alias("row")] if carry else []
    rows = docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("source"), (F.octet_length(content) + 1).cast("bigint").alias("size"),
        F.crc32(content).alias("text_crc32"), F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(c("doc_id").cast("string"), F.lit("")))).alias("key"), *kept,
    ).withColumn("range", F.conv(F.substring("key", 1, 3), 16, 10).cast("int"))

    counts = rows.groupBy(c("source").alias("r_source"), c("range").alias("r_range")).agg(F.count(F.lit(1)).alias("n"))
    source = Window.partitionBy("r_source")
    counts = counts.select(
        "r_source", "r_range", F.sum("n").over(source).alias("total"),
        F.coalesce(F.sum("n").over(source.orderBy("r_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
    )
    in_range = Window.partitionBy("source", "range").orderBy("key", "doc_id", "text_crc32", "size")
    ranked = rows.withColumn("nth", F.row_number().over(in_range)).join(
        counts, (c("source") == c("r_source")) & (c("range") == c("r_range"))
    )
    ranked = ranked.withColumn("fraction", (c("before") + c("nth") - F.lit(0.5)) / c("total"))
    ranked = ranked.withColumn("slice", F.floor(c("fraction") * RANGES).cast("int"))

    # At most RANGES rows: the counts of the slices of fractional rank.
    slices = ranked.groupBy(c("slice").alias("s_slice")).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy(F.lit(0))
    slices = slices.select(
        "s_slice", F.sum("n").over(everything).alias("rows"),
        F.coalesce(F.sum("n").over(everything.orderBy("s_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"),
    )
    in_slice = Window.partitionBy("slice").orderBy("fraction", "source", "key", "doc_id", "text_crc32", "size")
    placed = ranked.withColumn("nth", F.row_number().over(in_slice)).join(slices, c("slice") == c("s_slice"))
    placed = placed.withColumn("position", c("ahead") + c("nth") - 1)
    placed = placed.withColumn("shard", F.expr(f"cast(position * {shards} div rows as int)"))
    slot = F.expr(f"position - (shard * rows + {shards - 1}) div {shards}").alias("slot")
    return placed.select("doc_id", "source", "size", "text_crc32", "position", "shard", slot, *(["row"] if carry else []))


def write(docs: DataFrame, path: str, shards: int = 16, seed: str = "interleave") -> None:
    """Write all columns of ``docs`` as Parquet, one folder per shard, rows in slot order.

    Each shard is written by several tasks over ranges of slots, so no task holds a shard.
    """
    placed = assign(docs, shards, seed, carry=docs.columns)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").select("shard", "slot", "row").write.partitionBy(
        "shard"
    ).parquet(path)


def report(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (only of laws by key: null here)."""
    return assign(docs, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )
