"""Toxicity by multiple-instance learning.

A document is toxic if any of its sentences is: sentence scores p are combined by
noisy-or, 1 - prod(1 - p).  Only document labels are known; the weights of words and
word beginnings in sentences are fitted to them, and then point at the sentences.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import on_arrow, texts

#: The fitting sample: at most so many labelled documents of each class, the first by a hash of their ids.
TOXIC_SAMPLE, CLEAN_SAMPLE = 2_000, 4_000
#: Features that are kept, and documents of the sample that a feature must occur in.
MOST_FEATURES, LEAST_DOCUMENTS = 8_000, 3
#: Log-odds of a sentence before any evidence; what such a sentence would add is taken off,
#: so that one without evidence counts nothing and long clean documents stay clean.
NO_EVIDENCE = -5.0
#: Share of documents that are labelled toxic for reasons that no sentence shows; used in fitting only.
UNEXPLAINED = 0.03
BEGINNINGS = (4, 5, 6, 7)
STEPS, RATE, PENALTY = 150, 0.3, 1e-6
THRESHOLD = 0.7
#: Features are numbered by a hash, so that fitting needs the same memory whatever the sample holds.
BINS = 1 << 22
REMEMBERED = 500_000
_SENTENCE = re.compile(r"[^.!?\n]+")
_PIECE = re.compile(r"[^.!?\s]+")
_NOT_WORD = re.compile(r"[\W_]+")


def sentences(text: str) -> list[tuple[int, int]]:
    """Start and end of every stretch between full stops, marks and line ends that is not blank."""
    return [m.span() for m in _SENTENCE.finditer(text) if not m.group().isspace()]


def features(token: str) -> tuple[int, ...]:
    """Numbers of the word and of its first letters."""
    word = _NOT_WORD.sub("", token.lower())
    named = [f"={word}", *(f"^{word[:n]}" for n in BEGINNINGS if len(word) > n)] if word else []
    return tuple(xxhash.xxh32_intdigest(f) % BINS for f in named)


@dataclass(frozen=True)
class Model:
    """Weights (never negative) of features; everything else counts nothing."""

    weights: dict[int, float]

    def weight(self, token: str) -> float:
        return sum(self.weights.get(f, 0.0) for f in features(token))


def _risk(z):
    """-log(1 - p) of a sentence of log-odds ``z``, beyond that of one without evidence."""
    return np.logaddexp(0, z) - np.logaddexp(0, NO_EVIDENCE)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame) -> list[tuple[str, int]]:
    """The bounded sample of labelled texts outside the held-out part."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where(~held_out(F.col("doc_id")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = known.where("toxic = 1").orderBy(*order).limit(TOXIC_SAMPLE).unionByName(known.where("toxic = 0").orderBy(*order).limit(CLEAN_SAMPLE))
    rows = texts(docs).join(some, "doc_id").select("doc_id", "text", "toxic").toLocalIterator()
    return [(text, toxic) for _, text, toxic in sorted((r["doc_id"], r["text"], r["toxic"]) for r in rows)]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on a bounded sample; without labels of both classes nothing is evidence."""
    sample = _sample(docs, labels)
    toxic = np.array([y for _, y in sample], np.int64)
    sizes = np.bincount(toxic, minlength=2)
    if not sizes.all():
        return Model({})
    of_token = lru_cache(100_000)(features)
    counts = np.zeros((2, BINS), np.int32)
    for text, label in sample:
        counts[label, list({f for t in set(_PIECE.findall(text)) for f in of_token(t)})] += 1
    lift = np.log((counts[1] + 0.5) / (sizes[1] + 1)) - np.log((counts[0] + 0.5) / (sizes[0] + 1))
    gain = np.where((lift > 0) & (counts.sum(0) >= LEAST_DOCUMENTS), counts[1] * lift, 0)
    chosen = np.argsort(-gain, kind="stable")[:MOST_FEATURES]
    number = {int(f): i for i, f in enumerate(chosen[gain[chosen] > 0])}
    if not number:
        return Model({})
    # Sentences with any of the features; the others count nothing.
    feature, place, owner = [], [], []
    for d, (text, _) in enumerate(sample):
        for start, end in sentences(text):
            own = [number[f] for t in text[start:end].split() for f in of_token(t) if f in number]
            if own:
                feature += own
                place += [len(owner)] * len(own)
                owner.append(d)
    feature, place, owner = np.array(feature), np.array(place), np.array(owner)
    weights, mean, square = np.full(len(number), 0.5), np.zeros(len(number)), np.zeros(len(number))
    for step in range(1, STEPS + 1):
        z = NO_EVIDENCE + np.bincount(place, weights[feature], len(owner))
        # -log(1 - p) of a document is the sum of those of its sentences.
        total = np.bincount(owner, _risk(z), len(sample)) + UNEXPLAINED
        by_document = np.where(toxic == 1, -1 / np.expm1(np.minimum(total, 500)), 1.0) / len(sample)
        by_sentence = by_document[owner] / (1 + np.exp(-z))
        gradient = np.bincount(feature, by_sentence[place], len(number)) + PENALTY * weights
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        weights -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        weights = np.maximum(weights, 0)
    return Model({f: float(weights[i]) for f, i in number.items() if weights[i] > 1e-3})


_SCORED = pa.struct(
    [
        ("score", pa.float64()),
        ("n_sentences", pa.int64()),
        ("offending", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))),
    ]
)


class _Weights(dict):
    """Weights of the tokens met so far; a new token's is worked out when it is asked for."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, token: str) -> float:
        weight = self[token] = self.model.weight(token)
        return weight


def scored(text: Column, model: Model) -> Column:
    """Struct of score, n_sentences and offending sentences (start, end, score of at least one half)."""
    # Filled where the function runs, once a worker.
    memos: list[_Weights] = []

    @on_arrow(_SCORED)
    def score_text(batch: pa.Array) -> pa.Array:
        if not memos:
            memos.append(_Weights(model))
        memo = memos[0]
        weight_of = memo.__getitem__
        out = []
        for content in batch.to_pylist():
            if len(memo) > REMEMBERED:
                memo.clear()
            spans = sentences(content)
            total, offending = 0.0, []
            for start, end in spans:
                weight = sum(map(weight_of, content[start:end].split()))
                if weight:
                    z = NO_EVIDENCE + weight
                    total += float(_risk(z))
                    if z >= 0:
                        offending.append({"start": start, "end": end, "score": float(1 / (1 + np.exp(-z)))})
            out.append({"score": float(-np.expm1(-total)), "n_sentences": len(spans), "offending": offending})
        return pa.array(out, _SCORED)

    return score_text(text)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_sentences and the offending sentences of every row.

    Labels of the held-out third are never read for fitting.  Null and empty texts
    score 0; a null doc_id is scored and not held out; repeated rows are scored each;
    several labels of a document count as toxic if one does.  Other columns are left out.
    """
    model = fit(docs, labels)
    rows = texts(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scored(F.col("text"), model).alias("s"))
    return rows.select(
        "doc_id", "held_out", F.col("s.score").alias("score"), (F.col("s.score") >= THRESHOLD).cast("int").alias("predicted"),
        F.col("s.n_sentences").alias("n_sentences"), F.col("s.offending").alias("offending"),
    )
