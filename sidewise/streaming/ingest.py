"""Continuous insert-if-absent of line-delimited JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import keyed

def read_ndjson_stream(spark: SparkSession, root: str, schema: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(root)


def stream_upsert(
    stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], order_by: Sequence[str],
    available_now: bool = True, buckets: int = keyed.BUCKETS,
) -> StreamingQuery:
    """Add the first record of every key to the keyed table ``target``; ``keyed.scan`` reads it.

    Each micro-batch compares its keys with the buckets that they fall in, so there is no
    streaming state to bound, no record is too late, and a batch costs what it holds.
    The epoch is the number of the load: a batch that is replayed after a failure
    leaves the same rows.
    """

    def store(batch: DataFrame, epoch: int) -> None:
        keyed.insert(batch, target, keys, [F.asc(c) for c in order_by], epoch, buckets)

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def stream_deduplicated(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Bounded-state variant: repeats of a key within ``delay`` are dropped."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
