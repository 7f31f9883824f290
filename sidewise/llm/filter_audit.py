"""What each of five filters removes in every order of application, from additive counts of failure masks.

Four filters look at one text; the fifth, E, asks whether a row with a smaller doc_id holds
the identical text.  A counting Bloom filter answers most of that before anything is moved:
tasks count hashed cells, the counts are summed by block of cells, and the merged sketch,
two bits a cell, clears every text with a cell that was counted once.  Only texts that may
repeat are shuffled and grouped whole for their smallest doc_id, with partial minima first,
so a text that is most of the table is no hot group.  Rows then carry a mask of five bits;
their counts per part and mask are all that the 120 orders need.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

FILTERS = "ABCDE"
#: Fixed values of the filters.
WORD_BREAKS = "[\\x20\\x09-\\x0D]+"
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT, MARKS = 200, 50, 3, "[#$%&*|]"

#: Cells that a text is counted in and cells per text; about one unique text in forty is then not cleared.
HASHES, CELLS_PER_TEXT = 4, 8
#: The sketch's largest size in cells, two bits each (64 MB).  With more texts it fills up and clears fewer of them.
MOST_CELLS = 1 << 28
BLOCK_CELLS = 1 << 20
#: Cells that a task counts before it hands them on.
WAITING_CELLS = 1 << 20


# Counting Bloom filter -------------------------------------------------------


def cells_for(texts: int) -> int:
    """Cells of a sketch for so many texts: a power of two between one block and ``MOST_CELLS``."""
    return min(MOST_CELLS, max(BLOCK_CELLS, 1 << (max(1, texts * CELLS_PER_TEXT) - 1).bit_length()))


def cells_of(first: np.ndarray, second: np.ndarray, cells: int) -> np.ndarray:
    """The cells, in rows, of texts with these two hashes; one text may meet a cell twice."""
    a, b = first.astype(np.uint64), second.astype(np.uint64) | np.uint64(1)
    return np.stack([(a + np.uint64(i) * b) >> np.uint64(40) ^ (a + np.uint64(i) * b) & np.uint64(0xFFFFFFFF) for i in range(HASHES)], 1) & np.uint64(cells - 1)


def distinct_in_row(cells: np.ndarray) -> np.ndarray:
    """True at the first place of every cell of a row, so that a text counts a cell once."""
    ordered = np.sort(cells, 1)
    return np.concatenate([np.ones((len(cells), 1), bool), ordered[:, 1:] != ordered[:, :-1]], 1)


def sketch(hashes: DataFrame, cells: int) -> bytes:
    """Two bits a cell, four cells a byte: 0, 1 or, at 2, more texts.  ``hashes`` has columns h1 and h2.

    The bytes are collected block by block; there are ``cells / 4`` of them, 64 MB at most.
    """

    def emit(waiting: list[np.ndarray]) -> pa.RecordBatch:
        met, times = np.unique(np.concatenate(waiting), return_counts=True)
        blocks = (met // np.uint64(BLOCK_CELLS)).astype(np.int64)
        bounds = np.flatnonzero(np.diff(blocks, prepend=-1, append=-1))
        parts = list(zip(bounds, bounds[1:]))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(blocks[bounds[:-1]]),
                pa.array([(met[a:b] % np.uint64(BLOCK_CELLS)).astype("<u4").tobytes() for a, b in parts], pa.binary()),
                pa.array([np.minimum(times[a:b], 2).astype("u1").tobytes() for a, b in parts], pa.binary()),
            ],
            names=["block", "cell", "times"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            of = cells_of(batch.column(0).to_numpy(), batch.column(1).to_numpy(), cells)
            waiting.append(np.sort(of, 1)[distinct_in_row(of)])
            size += len(waiting[-1])
            if size >= WAITING_CELLS:
                yield emit(waiting)
                waiting, size = [], 0
        if size:
            yield emit(waiting)

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BLOCK_CELLS, np.uint8)
        for batch in batches:
            for cell, times in zip(batch.column("cell"), batch.column("times")):
                at = np.frombuffer(cell.as_buffer(), "<u4")
                counts[at] = np.minimum(counts[at] + np.frombuffer(times.as_buffer(), "u1"), 2)
        four = counts.reshape(-1, 4)
        packed = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([packed.tobytes()], pa.binary())], names=["block", "packed"])

    partial = hashes.select("h1", "h2").mapInArrow(count, "block bigint, cell binary, times binary")
    merged = partial.groupBy("block").applyInArrow(merge, "block bigint, packed binary")
    out = bytearray(cells // 4)
    for row in merged.toLocalIterator():
        at = row["block"] * (BLOCK_CELLS // 4)
        out[at : at + BLOCK_CELLS // 4] = row["packed"]
    return bytes(out)


def may_repeat(h1: Column, h2: Column, counts: object, cells: int) -> Column:
    """False where a cell of the text was counted once; ``counts`` is a broadcast ``sketch``."""
    from pyspark.sql.functions import arrow_udf

    def test(first: pa.Array, second: pa.Array) -> pa.Array:
        of = cells_of(first.to_numpy(), second.to_numpy(), cells)
        packed = np.frombuffer(counts.value, np.uint8)
        times = packed[(of >> np.uint64(2)).astype(np.int64)] >> ((of & np.uint64(3)) << np.uint64(1)).astype(np.uint8) & 3
        return pa.array((times >= 2).all(1))

    return arrow_udf(test, returnType="boolean")(h1, h2)


# Masks -----------------------------------------------------------------------


def text_mask(text: Column) -> Column:
    """Bits of the filters A to D that ``text`` fails."""
    words = F.filter(F.split(text, WORD_BREAKS), lambda w: w != "")
    n_words, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = (
        n_words < LEAST_WORDS,
        100 * distinct < LEAST_DISTINCT_PERCENT * n_words,
        100 * capitals.cast("bigint") > MOST_CAPITALS_PERCENT * F.length(text).cast("bigint"),
        text.rlike(MARKS),
    )
    return reduce(lambda a, b: a + b, (F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)))


def masks(docs: DataFrame) -> DataFrame:
    """doc_id, part and mask of every row of ``docs``; bit i of the mask says that filter i fails.

    Null texts count as empty, a null lang is the part of the empty string.  A row without
    doc_id has no smaller one before it and passes E.  Rows that repeat the smallest
    doc_id of a text all pass E.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    hashed = rows.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit("second"), "text")})
    cells = cells_for(docs.count())
    counts = spark.sparkContext.broadcast(sketch(hashed, cells))
    repeats = may_repeat(F.col("h1"), F.col("h2"), counts, cells)
    tested = hashed.withColumn("repeats", repeats).select(
        "doc_id", "part", text_mask(F.col("text")).alias("mask"),
        F.when(F.col("repeats"), F.col("text")).alias("text"), F.when(F.col("repeats"), F.sha2("text", 256)).alias("digest"),
    )
    tested = stored(tested, "audited")
    firsts = (
        tested.where(F.col("text").isNotNull()).groupBy("text").agg(F.min("doc_id").alias("doc_id"))
        .where(F.col("doc_id").isNotNull()).select("doc_id", F.sha2("text", 256).alias("digest"), F.lit(True).alias("first"))
    )
    # A smallest id is met by doc_id, which no group of copies shares, and told apart from other texts of that id by digest.
    joined = tested.drop("text").join(firsts, ["doc_id", "digest"], "left")
    late = F.col("digest").isNotNull() & F.col("doc_id").isNotNull() & F.col("first").isNull()
    return joined.select("doc_id", "part", (F.col("mask") + F.when(late, 1 << 4).otherwise(0)).alias("mask"))


def mask_counts(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask and the rows, good rows and toxic rows of each; ``labels`` may lack or repeat a doc_id.

    A row is good or toxic if any label of its doc_id says 1.
    """
    said = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    one = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("bigint")), F.lit(0)).alias(c)
    known = masked.join(said.agg(one("quality"), one("toxic")), "doc_id", "left")
    return known.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("quality"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")
    )


# Orders ----------------------------------------------------------------------


def steps() -> list[tuple[str, int, int, int]]:
    """filter_order, step, bits of the filters before it and the bit of its own: 600 rows."""
    bit = {name: 1 << i for i, name in enumerate(FILTERS)}
    return [("".join(order), n + 1, sum(bit[f] for f in order[:n]), bit[f]) for order in permutations(FILTERS) for n, f in enumerate(order)]


def shapley_weight(before: int) -> int:
    """In how many orders exactly the filters of ``before`` precede a given other one."""
    n = before.bit_count()
    return factorial(n) * factorial(len(FILTERS) - 1 - n)


def by_order(counted: DataFrame) -> DataFrame:
    """The audit of each part in every order and step from ``mask_counts``; a part has 600 rows, zeros included."""
    listed = steps()
    pairs = sorted({(before, own) for _, _, before, own in listed})
    # Both arrays are fixed: 80 pairs and 600 steps.
    choice = F.array(*(F.struct(F.lit(b).alias("before"), F.lit(o).alias("own"), F.lit(shapley_weight(b)).alias("weight")) for b, o in pairs))
    each = counted.withColumn("choice", F.explode(choice)).select("part", "mask", "rows", "good", "toxic", "choice.*")
    fails, earlier = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0

    def total(value: str, condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(value)).otherwise(0))

    of_pair = each.groupBy("part", "before", "own", "weight").agg(
        total("rows", ~fails & ~earlier).alias("kept"),
        total("rows", fails & ~earlier).alias("removed"),
        total("rows", fails & earlier).alias("redundant"),
        total("rows", F.col("mask") == F.col("own")).alias("unique_fails"),
        total("good", fails & ~earlier).alias("good_lost"),
        total("toxic", fails & ~earlier).alias("toxic_lost"),
    )
    shares = of_pair.groupBy("part", "own").agg(F.sum(F.col("weight") * F.col("removed")).alias("shapley"))
    spread = counted.sparkSession.createDataFrame(listed, "filter_order string, step int, before int, own int")
    return of_pair.join(shares, ["part", "own"]).join(F.broadcast(spread), ["before", "own"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All orders of the five filters over ``docs``, per lang; an empty table has no parts and gives no rows."""
    return by_order(mask_counts(masks(docs), labels))
