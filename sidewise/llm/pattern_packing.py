"""Best-fit packing of token sequences by patterns fitted with non-negative least squares.

Documents longer than a sequence are cut into whole sequences behind a first piece that
may be shorter.  Of all pieces only the histogram of lengths, at most one number per
length, reaches the driver.  There every pattern of one to three lengths that fills a
sequence exactly is enumerated and repeat counts are fitted to the histogram by
accelerated projected gradients.  The counts are rounded and cut to what the histogram
holds; what no pattern takes is packed best-fit, longest first, by lengths and counts.
The more pieces a length has, the more of them go by pattern: with a handful per length
most repeats are fractions and rounding leaves more to the residual.

The packing says how many pieces of which length go where.  Pieces are numbered within
their length, in buckets that follow the histogram, and their number picks the place:
the places are a sorted table of at most a few rows per pattern, whatever the corpus.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bpe import codec
from .common import stored, texts

SEQUENCE_IDS = 1_024
END_ID = 2
#: Pieces of one length and bucket, which one task numbers.
BUCKET_PIECES = 1_024
#: Steps of the fit, which work on patterns and lengths only.
FIT_STEPS = 200
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"


# Ids -------------------------------------------------------------------------


class Encoder:
    """Ids as the tokenizers library gives them, from the same vocabulary as ranks.

    Both libraries split by the same pattern and merge by the same ranks; only special
    tokens, which the tokenizers library finds inside a text, are left to it.
    """

    def __init__(self, tokenizer: str, ranks: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.codec = codec(ranks, pattern)

    def encode(self, text: str) -> np.ndarray:
        if any(token in text for token in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        return self.codec.encode(text)


@lru_cache(maxsize=2)
def encoder(tokenizer: str, ranks: str, pattern: str) -> Encoder:
    return Encoder(tokenizer, ranks, pattern)


def pieces(
    docs: DataFrame, tokenizer: str, ranks: str, pattern: str,
    sequence_ids: int = SEQUENCE_IDS, end_id: int = END_ID, keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if kept, ids (packed).

    A document is its ids and ``end_id``; null and empty texts are just that.  Rows that
    repeat a doc_id, and rows without one, are documents of their own.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(tokenizer, ranks, pattern), np.array([end_id], "<u4")
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.concatenate([own.encode(text), end])
                cuts = [0, *range(len(ids) % sequence_ids or sequence_ids, len(ids), sequence_ids), len(ids)] if len(ids) > sequence_ids else [0, len(ids)]
                for number, (low, high) in enumerate(zip(cuts, cuts[1:])):
                    packed = ids[low:high].tobytes()
                    rows.append((doc_id, number, low, high - low, zlib.crc32(packed), packed if keep_ids else None))
            columns = zip(*rows) if rows else [[]] * 6
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return texts(docs).mapInArrow(cut, PIECES)


# Patterns --------------------------------------------------------------------


def exact_patterns(present: np.ndarray) -> np.ndarray:
    """All patterns of one to three lengths that fill a sequence: rows of three lengths, zero for none.

    ``present[n]`` says whether length n occurs; the last index is the sequence's length.
    """
    size = len(present) - 1
    lengths = np.flatnonzero(present[1:]) + 1
    found = [np.array([[size, 0, 0]])] if present[size] else []
    low = lengths[lengths <= size // 2]
    low = low[present[size - low]]
    found.append(np.stack([low, size - low, np.zeros_like(low)], 1))
    for first in lengths[lengths <= size // 3]:
        second = lengths[(lengths >= first) & (lengths <= (size - first) // 2)]
        second = second[present[size - first - second]]
        found.append(np.stack([np.full_like(second, first), second, size - first - second], 1))
    return np.concatenate(found).astype(np.int64)


def fit_repeats(patterns: np.ndarray, histogram: np.ndarray, steps: int = FIT_STEPS) -> np.ndarray:
    """Repeats x >= 0 that bring the lengths used by x near ``histogram``, squares weighted by 1 / count."""
    weight = 1 / np.maximum(histogram, 1.0)
    weight[0] = 0
    flat = patterns.ravel()

    def used(x: np.ndarray) -> np.ndarray:
        return np.bincount(flat, np.repeat(x, patterns.shape[1]), len(histogram))

    def gradient(x: np.ndarray, target: np.ndarray | float) -> np.ndarray:
        return (weight * (used(x) - target))[patterns].sum(1)

    step = np.ones(len(patterns))
    for _ in range(30):
        step = gradient(step, 0.0)
        largest = np.linalg.norm(step)
        step /= largest
    x = ahead = np.zeros(len(patterns))
    pace = 1.0
    for _ in range(steps):
        slope = gradient(ahead, histogram)
        new = np.maximum(0, ahead - slope / largest)
        if np.dot(new - x, slope) > 0:
            pace, ahead, x = 1.0, new, new
        else:
            faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
            ahead, x, pace = new + (pace - 1) / faster * (new - x), new, faster
    return x


def roundings(x: np.ndarray) -> list[np.ndarray]:
    """Whole repeats near ``x``: down, to the nearest, and with the error carried on to the next pattern."""
    carried = np.diff(np.floor(np.cumsum(x) + 0.5), prepend=0)
    return [r.astype(np.int64) for r in (np.floor(x), np.rint(x), carried)]


def afforded(patterns: np.ndarray, x: np.ndarray, repeats: np.ndarray, histogram: np.ndarray) -> tuple[list[tuple[list, int]], np.ndarray]:
    """As many of ``repeats`` as the histogram can bear, largest fits first, and the counts that remain."""
    left, packed = histogram.copy(), []
    order = np.flatnonzero(repeats)
    for number in order[np.argsort(-x[order], kind="stable")]:
        lengths, times = np.unique(patterns[number][patterns[number] > 0], return_counts=True)
        count = int(min(repeats[number], (left[lengths] // times).min()))
        if count > 0:
            left[lengths] -= count * times
            packed.append((list(zip(lengths.tolist(), times.tolist())), count))
    return packed, left


def best_fit(histogram: np.ndarray) -> list[tuple[list, int]]:
    """Longest first, each into the fullest sequence with room; equal sequences are handled together."""
    size = len(histogram) - 1
    rooms: list[int] = []
    groups: dict[int, list[tuple[list, int]]] = {}

    def put(content: list, count: int, room: int) -> None:
        if count:
            if room not in groups:
                groups[room] = []
                insort(rooms, room)
            groups[room].append((content, count))

    for length in range(size, 0, -1):
        left = int(histogram[length])
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                whole, rest = divmod(left, size // length)
                put([(length, size // length)], whole, size - size // length * length)
                put([(length, rest)], 1 if rest else 0, size - rest * length)
                break
            room = rooms[at]
            content, count = groups[room].pop()
            times = min(room // length, left)
            taken = min(count, left // times)
            put(content, count - taken, room)
            if not groups[room]:
                del groups[room]
                rooms.pop(at)
            put([*content, (length, times)], taken, room - times * length)
            left -= taken * times
    return [group for room in rooms for group in groups[room]]


def pack_histogram(histogram: np.ndarray) -> list[tuple[list, int]]:
    """Patterns ((length, times) pairs) and how often each is used; together they use up ``histogram``.

    Of the roundings the one stays that needs the fewest sequences with its residual.
    """
    patterns = exact_patterns(histogram > 0)
    if not len(patterns):
        return best_fit(histogram)
    x = fit_repeats(patterns, histogram.astype(float))
    tried = []
    for repeats in roundings(x):
        taken, left = afforded(patterns, x, repeats, histogram)
        tried.append(taken + best_fit(left))
    return min(tried, key=lambda groups: sum(count for _, count in groups))


@dataclass(frozen=True)
class Places:
    """Where the pieces of each length go; row i holds pieces ``first[i]`` on of its length, up to the next row."""

    begins: np.ndarray
    first: np.ndarray
    times: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, packed: list[tuple[list, int]], size: int) -> Places:
        rows, taken, sequence = [], [0] * (size + 1), 0
        for content, count in packed:
            offset = 0
            for length, times in content:
                rows.append((length, taken[length], times, sequence, offset))
                taken[length] += count * times
                offset += length * times
            sequence += count
        table = np.array(rows, np.int64).reshape(-1, 5)
        table = table[np.lexsort((table[:, 1], table[:, 0]))]
        begins = np.searchsorted(table[:, 0], np.arange(size + 2))
        return cls(begins, *(np.ascontiguousarray(table[:, i]) for i in range(1, 5)))

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with these lengths and numbers within their length."""
        row = np.empty(len(length), np.int64)
        for value in np.unique(length):
            some, low, high = length == value, self.begins[value], self.begins[value + 1]
            row[some] = low + np.searchsorted(self.first[low:high], number[some], "right") - 1
        instance, within = np.divmod(number - self.first[row], self.times[row])
        return self.sequence[row] + instance, self.offset[row] + within * length


# Packing ---------------------------------------------------------------------


def _numbered(rows: DataFrame, histogram: np.ndarray) -> DataFrame:
    """``rows`` with their number within their length, counted per bucket of a length."""
    buckets = F.array(*(F.lit(max(1, -(-int(n) // BUCKET_PIECES))) for n in histogram))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.get(buckets, F.col("length").cast("int"))))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("length", "bucket").count()
    starts = sizes.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    placed = rows.withColumn("rank", F.row_number().over(within)).join(starts, ["length", "bucket"])
    return placed.withColumn("number", F.col("base") + F.col("rank") - 1)


def _total(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def packed(rows: DataFrame, sequence_ids: int = SEQUENCE_IDS) -> DataFrame:
    """Columns of stored ``rows`` (of ``pieces``) with sequence_id and offset, gapless from 0 in each sequence.

    ``rows`` is read twice, so it must be a written table.  An empty table gives no rows.
    """
    spark = rows.sparkSession
    histogram = np.zeros(sequence_ids + 1, np.int64)
    # At most one row for each length up to that of a sequence.
    for length, n in rows.groupBy("length").agg(_total("n")).collect():
        histogram[length] = n
    places = spark.sparkContext.broadcast(Places.of(pack_histogram(histogram), sequence_ids))
    columns = [c for c in rows.columns]
    numbered = _numbered(rows, histogram).select(*columns, "number")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            sequence, offset = places.value.find(length, number)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)], names=[*columns, "sequence_id", "offset"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return numbered.mapInArrow(place, f"{kinds}, sequence_id bigint, offset bigint")


def sequences(placed: DataFrame, sequence_ids: int = SEQUENCE_IDS) -> DataFrame:
    """sequence_id, ids (packed), and the offset and doc_id of each piece in it, from ``packed`` rows that kept their ids.

    A sequence has at most ``sequence_ids`` pieces, so its arrays are bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    grouped = placed.groupBy("sequence_id").agg(parts.alias("parts"))
    ids = F.aggregate("parts", F.lit("").cast("binary"), lambda done, part: F.concat(done, part["ids"]))
    return grouped.select("sequence_id", ids.alias("ids"), F.col("parts.offset").alias("offsets"), F.col("parts.doc_id").alias("doc_ids"))


def pack(docs: DataFrame, tokenizer: str, ranks: str, pattern: str, sequence_ids: int = SEQUENCE_IDS, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of ``docs``; with ``keep_ids`` also ids."""
    cut = pieces(docs, tokenizer, ranks, pattern, sequence_ids, end_id, keep_ids)
    return packed(stored(cut if keep_ids else cut.drop("ids"), "pieces"), sequence_ids)
