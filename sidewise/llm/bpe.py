"""Byte-level BPE encoding and decoding as a monoid reduction.

A text is halved until a part is short; parts are encoded on their own and
neighbours are joined upwards.  A join encodes a window around the border anew.
The window ends where a non-space is followed by a blank or a line end: the split
pattern has no alternative that runs from a non-space into white space and none
that looks back, so every scan, of the part or of the whole, starts a new match
there.  Tokens outside such a window are therefore those of the whole text; while
no such place is in reach, the window doubles, at worst up to the whole part.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import on_arrow, texts

LEAF_CHARS = 4_096
LEAF_IDS = 4_096
WINDOW_CHARS = 32
#: Ids in the packed form: little-endian unsigned 32-bit integers.
PACKED = np.dtype("<u4")


class Codec:
    """Encoder and decoder for one rank file."""

    def __init__(self, path: str, pattern: str, leaf_chars: int = LEAF_CHARS, leaf_ids: int = LEAF_IDS):
        import tiktoken

        self.leaf_chars, self.leaf_ids = leaf_chars, leaf_ids
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.width[rank] = len(token)

    def encode(self, text: str) -> np.ndarray:
        return self._encode(text, 0, len(text))

    def _encode(self, text: str, start: int, end: int) -> np.ndarray:
        if end - start <= self.leaf_chars:
            return np.array(self.encoding.encode_ordinary(text[start:end]), PACKED)
        middle = (start + end) // 2
        return self._join(text, start, middle, end, self._encode(text, start, middle), self._encode(text, middle, end))

    def _join(self, text: str, start: int, middle: int, end: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        reach = WINDOW_CHARS
        while True:
            low, high = max(start, middle - reach), min(end, middle + reach)
            first = next((i for i in range(middle - 1, low, -1) if _starts_match(text, i)), start if low == start else None)
            last = next((i for i in range(middle + 1, high) if _starts_match(text, i)), end if high == end else None)
            if first is not None and last is not None:
                break
            reach *= 2
        keep_left = len(left) - self._count(left[::-1], len(text[first:middle].encode()))
        drop_right = self._count(right, len(text[middle:last].encode()))
        window = np.array(self.encoding.encode_ordinary(text[first:last]), PACKED)
        return np.concatenate([left[:keep_left], window, right[drop_right:]])

    def _count(self, ids: np.ndarray, size: int) -> int:
        """How many of the first ids make up ``size`` bytes."""
        return int(np.searchsorted(np.cumsum(self.width[ids[:size]]), size)) + 1 if size else 0

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= self.leaf_ids:
            return self.encoding.decode_bytes(ids.tolist())
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


def _starts_match(text: str, i: int) -> bool:
    return text[i] in " \n" and not text[i - 1].isspace()


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encoded(text: Column, path: str, pattern: str) -> Column:
    """Packed ids of ``text`` (binary); null stays null.  ``path`` must be readable on every executor."""

    @on_arrow(pa.binary())
    def encode_text(batch: pa.Array) -> pa.Array:
        own = codec(path, pattern)
        return pa.array((None if t is None else own.encode(t).tobytes() for t in batch.to_pylist()), pa.binary())

    return encode_text(text)


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """Bytes that packed ``ids`` stand for; an id outside the vocabulary fails the task."""

    @on_arrow(pa.binary())
    def decode_ids(batch: pa.Array) -> pa.Array:
        own = codec(path, pattern)
        return pa.array((None if b is None else own.decode(np.frombuffer(b, PACKED)) for b in batch.to_pylist()), pa.binary())

    return decode_ids(ids)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (packed), n_tokens and decoded bytes of every row.

    Null and empty texts have no ids and decode to nothing; repeated rows and null
    ids give one row each; other columns are left out.
    """
    ids = texts(docs).select("doc_id", encoded(F.col("text"), path, pattern).alias("ids"))
    return ids.select(
        "doc_id", "ids", (F.octet_length("ids") / PACKED.itemsize).cast("bigint").alias("n_tokens"),
        decoded(F.col("ids"), path, pattern).alias("decoded"),
    )


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to."""
    return round_trip(docs, path, pattern).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
