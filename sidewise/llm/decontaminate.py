"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Benchmark items are taken in blocks of a bounded size.  For each block one pass over
all documents finds its word n-grams and cuts a window around places where n-grams of
one item lie together.  All n-grams of an item are seeds, so copies of it
in other documents change nothing; only windows that share too few words with the
item to reach the score are not aligned with it.  An n-gram is three words of which one
neighbour may be skipped, in the item, in the document or in both, so edits that
are spread evenly leave seeds, too: what keeps none is a run of at most two words
between any two edits and two edits around each such pair, which only insertions
can do at a score just above the limit.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import on_arrow, texts

GRAM = 3
#: Places of an n-gram's second and third word after its first.
STEPS = ((1, 2), (1, 3), (2, 3))
#: Characters of benchmark text that are sent to the tasks at once.
BLOCK_CHARS = 4_000_000
MATCH, MISMATCH, GAP = 2, -1, -1
#: Score of an alignment over that of the unchanged item from which a document counts as contaminated.
LEAST_SCORE = 0.5
REMEMBERED = 100_000
_NOT_WORD = re.compile(r"\W+")


def clean_word(token: str) -> str:
    """Lower-cased, without anything but word characters."""
    return token.lower() if token.isalnum() else _NOT_WORD.sub("", token.lower())


class Block:
    """The words and n-grams of some items as numbers; 0 stands for any word that no item has."""

    def __init__(self, items: list[tuple[int, str]]):
        split = [(item, [w for t in text.split() if (w := clean_word(t))]) for item, text in items]
        split = [(item, words) for item, words in split if len(words) >= GRAM]
        self.words = {w: i + 1 for i, w in enumerate(sorted({w for _, words in split for w in words}))}
        self.base = np.uint64(len(self.words) + 1)
        self.items = [(item, np.array([self.words[w] for w in words], np.int64)) for item, words in split]
        # (n-gram, item) pairs sorted by n-gram; an item's index is its place in ``items``.
        pairs = {(int(code), nth) for nth, (_, ids) in enumerate(self.items) for code in self.codes(ids)[1]}
        self.pairs = np.array(sorted(pairs), np.uint64).reshape(-1, 2)
        self.grams = np.unique(self.pairs[:, 0])
        self.first = np.searchsorted(self.pairs[:, 0], self.grams)
        self.last = np.searchsorted(self.pairs[:, 0], self.grams, side="right")
        self.owner = self.pairs[:, 1].astype(np.int64)
        self.lengths = np.array([len(ids) for _, ids in self.items], np.int64)
        #: The distinct words of each item and how often it has them.
        self.counts = [np.unique(ids, return_counts=True) for _, ids in self.items]
        self.memo: dict[str, int] = {}

    def codes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First places and codes of all n-grams of known words."""
        places, codes = [], []
        for second, third in STEPS:
            n = max(0, len(ids) - third)
            one, two, three = ids[:n], ids[second : second + n], ids[third : third + n]
            at = np.flatnonzero((one > 0) & (two > 0) & (three > 0))
            one, two, three = (some[at].astype(np.uint64) for some in (one, two, three))
            places.append(at)
            codes.append((one * self.base + two) * self.base + three)
        return np.concatenate(places), np.concatenate(codes)

    def numbered(self, text: str) -> np.ndarray:
        """The text's words as numbers."""
        memo, tokens = self.memo, text.split()
        if len(memo) > REMEMBERED:
            memo.clear()
        for token in set(tokens).difference(memo):
            word = clean_word(token)
            memo[token] = self.words.get(word, 0) if word else -1
        ids = np.fromiter(map(memo.__getitem__, tokens), np.int64, len(tokens))
        return ids[ids >= 0]

    def may_reach(self, nth: int, window: np.ndarray) -> bool:
        """Whether the words that item and window share, each aligned as a match, would reach the score."""
        words, times = self.counts[nth]
        ordered = np.sort(window)
        held = np.searchsorted(ordered, words, side="right") - np.searchsorted(ordered, words)
        return np.minimum(times, held).sum() >= LEAST_SCORE * self.lengths[nth]

    def find(self, text: str) -> list[dict]:
        """Windows around clusters of an item's n-grams."""
        ids = self.numbered(text)
        if len(ids) < GRAM or not len(self.grams):
            return []
        at, codes = self.codes(ids)
        if not len(at):
            return []
        gram = np.minimum(np.searchsorted(self.grams, codes), len(self.grams) - 1)
        hit = self.grams[gram] == codes
        at, gram = at[hit], gram[hit]
        if not len(at):
            return []
        # Every hit once for each item that has the n-gram.
        times = self.last[gram] - self.first[gram]
        start = np.repeat(self.first[gram] - np.cumsum(times) + times, times)
        item = self.owner[start + np.arange(times.sum())]
        at = np.repeat(at, times)
        order = np.lexsort((at, item))
        item, at = item[order], at[order]
        cut = np.flatnonzero((np.diff(item) != 0) | (np.diff(at) > self.lengths[item[1:]])) + 1
        windows = []
        for some in np.split(np.arange(len(item)), cut):
            nth = int(item[some[0]])
            reach = int(self.lengths[nth])
            low, high = max(0, int(at[some[0]]) - reach), int(at[some[-1]]) + GRAM + 1 + reach
            if self.may_reach(nth, ids[low:high]):
                windows.append({"item": nth, "at": low, "words": ids[low:high].tolist()})
        return windows


def _best(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: score, and the last positions in item and window."""
    steps = -GAP * np.arange(len(window) + 1)
    row = np.zeros(len(window) + 1, np.int64)
    best = (0, 0, 0)
    for i, word in enumerate(item):
        scored = np.where(window == word, MATCH, MISMATCH)
        new = np.maximum(row + GAP, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + scored)
        row = np.maximum.accumulate(new + steps) - steps
        j = int(row.argmax())
        if row[j] > best[0]:
            best = (int(row[j]), i, j - 1)
    return best


def align(item: np.ndarray, window: np.ndarray) -> tuple[float, int, int]:
    """Smith-Waterman score over that of the whole item, and the aligned part of the window (end exclusive)."""
    score, i, j = _best(item, window)
    if not score:
        return 0.0, 0, 0
    _, _, back = _best(item[i::-1], window[j::-1])
    return score / (MATCH * len(item)), j - back, j + 1


_WINDOWS = pa.list_(pa.struct([("item", pa.int32()), ("at", pa.int32()), ("words", pa.list_(pa.int32()))]))
_ALIGNED = pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("start", pa.int32()), ("end", pa.int32())])


def _finder(block: Block):
    @on_arrow(_WINDOWS)
    def find_windows(text: pa.Array) -> pa.Array:
        return pa.array([block.find(t) for t in text.to_pylist()], _WINDOWS)

    return find_windows


def _aligner(items: list[tuple[int, np.ndarray]]):
    @on_arrow(_ALIGNED)
    def align_items(item: pa.Array, window: pa.Array) -> pa.Array:
        out = []
        for nth, words in zip(item.to_pylist(), window.to_pylist()):
            item_id, ids = items[nth]
            out.append(dict(zip(("item_id", "score", "start", "end"), (item_id, *align(ids, np.array(words, np.int64))))))
        return pa.array(out, _ALIGNED)

    return align_items


def _search(rows: DataFrame, block: Block) -> DataFrame:
    """doc_id, item_id, score, first_word, last_word for the items of one block."""
    c, spark = F.col, rows.sparkSession
    windows = rows.select("doc_id", F.explode(_finder(block)("text")).alias("w")).select("doc_id", "w.*")
    # Few bytes, much work: spread by number, not by size.
    windows = windows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    scored = windows.select("doc_id", "at", _aligner(block.items)("item", "words").alias("hit")).where(c("hit.score") >= LEAST_SCORE)
    best = F.max(F.struct(c("hit.score").alias("score"), (-c("at") - c("hit.start")).alias("first"), (c("at") + c("hit.end")).alias("last")))
    return scored.groupBy("doc_id", c("hit.item_id").alias("item_id")).agg(best.alias("best")).select(
        "doc_id", "item_id", c("best.score").alias("score"), (-c("best.first")).alias("first_word"), c("best.last").alias("last_word")
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row for each document and item that it holds a whole, edited or paraphrased copy of.

    ``score`` is 1 for the unchanged item; first_word and last_word (exclusive) are the
    place in the document's words.  Items of fewer than three words are too short to
    prove anything and match nothing; null and empty texts match nothing; a null
    item_id or doc_id is reported as null; repeated rows give one result.  Other columns
    are left out.  The number of passes follows the size of the benchmark alone.
    """
    rows = texts(docs)
    items = texts(benchmark, "item_id").select(F.col("doc_id").alias("item_id"), "text")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / block_chars))
    out = None
    for number in range(blocks):
        # The only rows that come to the driver: one block of the benchmark.
        some = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).distinct().collect()
        block = Block(sorted(((r["item_id"], r["text"]) for r in some), key=lambda r: (r[0] is None, r[0] or 0, r[1])))
        if block.items:
            hits = _search(rows, block)
            out = hits if out is None else out.unionByName(hits)
    if out is None:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint, score double, first_word int, last_word int")
    return out
