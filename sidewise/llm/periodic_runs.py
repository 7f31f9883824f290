"""Periodic runs of words, found in tiles per octave of periods and stitched per document and period.

A run of smallest period q is a stretch of words in which words q apart are identical,
at least ``max(6, 4 q)`` long, that no neighbouring word extends.  The octave of Q holds
the periods Q to 2 Q - 1.  Its tiles are centred on every Q-th word (every second one for
Q = 1) and reach one step to the left and a step and 2 Q words to the right.  Z-functions
at the centre, forward and backward, say how far words q apart agree on either side; a
run's agreement covers three steps, so it covers one side of each of its centres whole,
and fragments of neighbouring centres touch.

A document of usual size is tiled and solved where it is read; a longer one is exploded
into rows of tiles that are dealt out over the cluster.  Fragments that touch are joined
per document and period; of equal stretches the smallest period stays, which is the
primitive one, as any smaller period of a run this long divides the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, texts

LEAST_WORDS, LEAST_EXPONENT = 6, 4
#: Documents of more words are exploded into tile rows of at least this many words.
TILE_WORDS = 16_384
#: Pairs of words that are compared at once.
COMPARED = 1 << 20
FRAGMENT = pa.struct([("period", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])
OPENED = "key bigint, doc_id bigint, text string, collapsed_sha256 string, fragments array<struct<period bigint, low bigint, high bigint>>"
RESULT = "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"

Words = list[bytes]
Rewrite = Callable[[int | None, Words], Words]


def words_of(text: str) -> Words:
    """Words between blanks, tabs, line ends, vertical tabs and form feeds."""
    return text.encode().split()


def unchanged(doc_id: int | None, words: Words) -> Words:
    return words


def least_length(period: int) -> int:
    return max(LEAST_WORDS, LEAST_EXPONENT * period)


# Tiles -----------------------------------------------------------------------


def z_function(codes: list[int]) -> list[int]:
    """For every place, how many words from there on equal the first ones."""
    n = len(codes)
    z = [0] * n
    low = high = 0
    for i in range(1, n):
        k = min(high - i, z[i - low]) if i < high else 0
        while i + k < n and codes[k] == codes[i + k]:
            k += 1
        z[i] = k
        if i + k > high:
            low, high = i, i + k
    return z


def step_of(octave: int) -> int:
    return max(octave, 2)


def solve_tile(codes: np.ndarray, centre: int, octave: int) -> tuple[list[int], list[int]]:
    """How far words q apart agree before and from ``centre`` on, for each q of the octave, at most a step."""
    step = step_of(octave)
    ahead = z_function(codes[centre : centre + step + 2 * octave].tolist())
    ahead += [0] * (2 * octave - len(ahead))
    before = codes[max(0, centre - step) : centre][::-1].tolist()
    right = min(len(codes), centre + 2 * octave)
    back = z_function([*before, -2, *codes[max(0, centre - step) : right][::-1].tolist()])
    # The words before centre + q begin, backwards, right - centre - q places into the second part.
    shift = len(before) + 1 + right - centre
    periods = range(octave, 2 * octave)
    return [min(step, back[shift - q]) if centre + q <= right else 0 for q in periods], [min(step, ahead[q]) for q in periods]


def octave_fragments(codes: np.ndarray, octave: int, first: int = 0, last: int | None = None) -> np.ndarray:
    """Rows (period, low, high): words i and i + period agree for low <= i < high.

    Centres are the multiples of the step from ``first`` to before ``last``.  Tiles in
    which no period can hold a run are passed over by comparing a few of their words.
    """
    step, n = step_of(octave), len(codes) if last is None else last
    centres = np.arange(-(-first // step) * step, min(n, len(codes)), step)
    if not len(centres):
        return np.empty((0, 3), np.int64)
    padded = np.concatenate([codes, np.full(3 * octave + 2 * step, -1, codes.dtype)])
    windows = np.lib.stride_tricks.sliding_window_view(padded[octave:], octave)
    rows = []
    block = max(1, COMPARED // octave)
    for some in (centres[i : i + block] for i in range(0, len(centres), block)):
        at, beyond = np.nonzero(windows[some[0] :: step][: len(some)] == codes[some][:, None])
        centre, period = some[at], beyond + octave
        ahead = back = np.ones(len(centre), bool)
        for k in sorted({1, step // 4, step // 2, step - step // 4, step - 1} - {0}):
            ahead = ahead & (padded[centre + k] == padded[centre + period + k])
            # Index -1 and below is the padding, which equals no word.
            back = back & (padded[centre - k] == padded[centre + period - k]) & (centre >= k)
            alive = ahead | back
            centre, period, ahead, back = centre[alive], period[alive], ahead[alive], back[alive]
        bounds = np.flatnonzero(np.diff(centre, prepend=-1, append=-1)) if len(centre) else []
        for low, high in zip(bounds, bounds[1:]):
            middle = int(centre[low])
            before, after = solve_tile(codes, middle, octave)
            for q in period[low:high].tolist():
                left, right = before[q - octave], after[q - octave]
                if max(left, right) == step:
                    rows.append((q, middle - left, middle + right))
    return stitched(np.array(rows, np.int64).reshape(-1, 3))


def stitched(rows: np.ndarray) -> np.ndarray:
    """Fragments of one octave joined where they touch, by period and place."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] > rows[:-1, 2])
    starts = np.flatnonzero(new)
    return np.stack([rows[starts, 0], rows[starts, 1], np.maximum.reduceat(rows[:, 2], starts)], 1)


def batch_fragments(documents: list[Words]) -> list[list[tuple[int, int, int]]]:
    """Fragments of each document that may be runs; the documents' words are compared side by side."""
    order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))
    sizes = np.array([len(documents[i]) for i in order], np.int64)
    ends = np.cumsum(sizes)
    found: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    flat = [word for i in order for word in documents[i]]
    if not flat:
        return found
    codes = pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    codes += np.repeat(np.arange(len(order)) << 32, sizes)
    octave = 1
    while octave * LEAST_EXPONENT <= sizes[0]:
        used = int(np.searchsorted(-sizes, -least_length(octave), "right"))
        if not used:
            break
        rows = octave_fragments(codes[: ends[used - 1]], octave)
        rows = rows[rows[:, 2] - rows[:, 1] + rows[:, 0] >= np.maximum(LEAST_WORDS, LEAST_EXPONENT * rows[:, 0])]
        for number, (period, low, high) in zip(np.searchsorted(ends, rows[:, 1], "right").tolist(), rows.tolist()):
            start = int(ends[number] - sizes[number])
            found[order[number]].append((period, low - start, high - start))
        octave *= 2
    return found


# Distribution ----------------------------------------------------------------


def collapsed(words: Words, runs: list[dict]) -> str:
    """Digest of the words that stay when every run is cut to its first period."""
    kept = np.ones(len(words), bool)
    for run in runs:
        kept[run["start"] + run["period"] : run["start"] + run["length"]] = False
    return hashlib.sha256(b" ".join([words[i] for i in np.flatnonzero(kept)] if runs else words)).hexdigest()


def opened(docs: DataFrame, rewrite: Rewrite = unchanged, tile_words: int = TILE_WORDS) -> DataFrame:
    """One stored row per document: its fragments, and its text where a run may still have to be cut.

    Longer documents have null fragments; ``exploded`` tiles them.
    """

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Only one attempt of a task is committed, so keys are unique in the stored table.
        key = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids, read = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            words = [rewrite(i, words_of(t)) for i, t in zip(ids, read)]
            short = [n for n, w in enumerate(words) if len(w) <= tile_words]
            fragments: list = [None] * len(words)
            for n, rows in zip(short, batch_fragments([words[n] for n in short])):
                fragments[n] = [{"period": p, "low": a, "high": b} for p, a, b in rows]
            done = [f == [] for f in fragments]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(key, key + len(ids)), pa.int64()),
                    batch.column(0),
                    pa.array([None if d else t for t, d in zip(read, done)], pa.string()),
                    pa.array([collapsed(w, []) if d else None for w, d in zip(words, done)], pa.string()),
                    pa.array(fragments, pa.list_(FRAGMENT)),
                ],
                names=["key", "doc_id", "text", "collapsed_sha256", "fragments"],
            )
            key += len(ids)

    return stored(texts(docs).mapInArrow(solve, OPENED), "opened-runs")


def exploded(longer: DataFrame, rewrite: Rewrite = unchanged, tile_words: int = TILE_WORDS) -> DataFrame:
    """Tile rows of each octave: key, octave, place of the first code, range of centres, codes of the words."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = rewrite(doc_id, words_of(text))
                codes = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy().astype("<i4")
                octave = 1
                while len(words) >= least_length(octave):
                    step = step_of(octave)
                    size = -(-max(tile_words, 16 * octave) // step) * step
                    for first in range(0, len(words), size):
                        base = max(0, first - step)
                        part = codes[base : first + size + step + 2 * octave].tobytes()
                        yield pa.RecordBatch.from_pydict({"key": [key], "octave": [octave], "base": [base], "first": [first], "size": [size], "codes": pa.array([part], pa.binary())})
                    octave *= 2

    return longer.select("key", "doc_id", "text").mapInArrow(explode, "key bigint, octave bigint, base bigint, first bigint, size bigint, codes binary")


def tile_fragments(tiles: DataFrame) -> DataFrame:
    """key, period, low and high of each tile row, solved on its own."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes, base = np.frombuffer(row["codes"], "<i4").astype(np.int64), row["base"]
                rows = octave_fragments(codes, row["octave"], row["first"] - base, row["first"] + row["size"] - base)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["key"]] * len(rows), pa.int64()), pa.array(rows[:, 0]), pa.array(rows[:, 1] + base), pa.array(rows[:, 2] + base)],
                    names=["key", "period", "low", "high"],
                )

    # Tiles of a long document have nothing in common any more: deal them out one by one.
    return tiles.repartition("key", "octave", "first").mapInArrow(solve, "key bigint, period bigint, low bigint, high bigint")


def runs_of(fragments: DataFrame) -> DataFrame:
    """key, start, length and period of every run, from fragments that touch within a document and period."""
    placed = Window.partitionBy("key", "period").orderBy("low", "high")
    before = F.max("high").over(placed.rowsBetween(Window.unboundedPreceding, -1))
    marked = fragments.withColumn("begins", F.coalesce((F.col("low") > before).cast("int"), F.lit(1)))
    numbered = marked.withColumn("island", F.sum("begins").over(placed.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy("key", "period", "island").agg(F.min("low").alias("start"), (F.max("high") - F.min("low") + F.first("period")).alias("length"))
    long_enough = whole.where(F.col("length") >= F.greatest(F.lit(LEAST_WORDS), F.col("period") * LEAST_EXPONENT))
    return long_enough.groupBy("key", "start", "length").agg(F.min("period").alias("period"))


def report(docs: DataFrame, rewrite: Rewrite = unchanged, tile_words: int = TILE_WORDS) -> DataFrame:
    """Runs of each document, its most repeated one, and digests of all runs and of the collapsed text.

    The strongest run has the greatest exact length / period; ties go to the smallest
    start, then period.  ``collapsed`` drops every word behind a run's first period.  Null
    and empty texts have no words and no runs; repeated rows give one row each.  ``rewrite``
    may change a document's words first and has to give the same words each time.
    """
    base = opened(docs, rewrite, tile_words)
    short = base.select("key", F.explode("fragments").alias("f")).select("key", "f.*")
    tiled = tile_fragments(exploded(base.where(F.col("fragments").isNull()), rewrite, tile_words))
    runs = runs_of(short.unionByName(tiled))
    # At most as many runs as words, so the array is no larger than the text.
    of_document = runs.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    unsettled = base.where(F.col("text").isNotNull()).select("key", "doc_id", "text").join(of_document, "key", "left").select("doc_id", "text", "runs")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, found in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = found or []
                best: dict | None = None
                for run in found:
                    if best is None or run["length"] * best["period"] > best["length"] * run["period"]:
                        best = run
                values = (best["start"], best["length"], best["period"], 1000 * best["length"] // best["period"]) if best else (None,) * 4
                lines = "".join(f"{r['start']},{r['length']},{r['period']}\n" for r in found)
                rows.append((doc_id, len(found), *values, hashlib.sha256(lines.encode()).hexdigest(), collapsed(rewrite(doc_id, words_of(text)), found)))
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            columns = zip(*rows) if rows else [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[p.split()[0] for p in RESULT.split(", ")])

    nothing = F.lit(None).cast("bigint")
    settled = base.where(F.col("text").isNull()).select(
        "doc_id", F.lit(0).cast("bigint").alias("n_runs"), nothing.alias("start"), nothing.alias("length"), nothing.alias("period"),
        nothing.alias("exponent_milli"), F.sha2(F.lit(""), 256).alias("runs_sha256"), "collapsed_sha256",
    )
    return settled.unionByName(unsettled.mapInArrow(settle, RESULT))
