"""A cuckoo filter over 64-bit hashes that works on whole arrays at a time."""

from __future__ import annotations

import numpy as np

SLOTS = 4
MAX_ROUNDS = 120
MAX_LOAD = 0.85


def buckets_for(keys: int) -> int:
    """Smallest power of two of buckets that keeps ``keys`` below the load limit."""
    need = max(1, int(np.ceil(keys / (SLOTS * MAX_LOAD))))
    return 1 << (need - 1).bit_length()


class CuckooFilter:
    """16-bit fingerprints, four slots a bucket, two buckets a key; 0 marks a free slot.

    The other bucket of a fingerprint follows from its present one, so entries can
    move and be deleted without the keys.  ``insert`` returns False when entries
    found no place: the caller then rebuilds a larger filter from its stored keys.
    """

    def __init__(self, buckets: int, table: bytes | None = None):
        self.mask = np.uint64(buckets - 1)
        self.table = (
            np.zeros((buckets, SLOTS), np.uint16) if table is None else np.frombuffer(table, np.uint16).reshape(-1, SLOTS).copy()
        )

    @classmethod
    def from_bytes(cls, table: bytes) -> CuckooFilter:
        return cls(len(table) // (2 * SLOTS), table)

    @classmethod
    def of(cls, hashes: np.ndarray, buckets: int | None = None) -> CuckooFilter:
        """A filter that holds all ``hashes``, doubled until they fit."""
        buckets = buckets or buckets_for(len(hashes))
        while True:
            made = cls(buckets)
            if made.insert(hashes):
                return made
            buckets *= 2

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def _home(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes = np.asarray(hashes, np.uint64)
        prints = (hashes >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        return prints, (hashes & self.mask).astype(np.int64)

    def _other(self, prints: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        step = (prints.astype(np.uint64) * np.uint64(0x9E3779B1)) & self.mask
        return bucket ^ step.astype(np.int64)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, bucket = self._home(hashes)
        wanted = prints[:, None]
        return (self.table[bucket] == wanted).any(1) | (self.table[self._other(prints, bucket)] == wanted).any(1)

    def insert(self, hashes: np.ndarray) -> bool:
        prints, bucket = self._home(hashes)
        for turn in range(MAX_ROUNDS):
            if not len(prints):
                return True
            order = np.argsort(bucket, kind="stable")
            prints, bucket = prints[order], bucket[order]
            rank = np.arange(len(bucket)) - np.searchsorted(bucket, bucket)
            taken = self.table[bucket] != 0
            fits = rank < SLOTS - taken.sum(1)
            free_first = np.argsort(taken, axis=1, kind="stable")
            self.table[bucket[fits], free_first[fits, rank[fits]]] = prints[fits]
            prints, bucket = prints[~fits], bucket[~fits]
            if turn and len(prints):
                # One entry of each full bucket takes a slot; what it pushes out moves on in its stead.
                _, first = np.unique(bucket, return_index=True)
                slot = (turn + prints[first]) % SLOTS
                prints[first], self.table[bucket[first], slot] = self.table[bucket[first], slot], prints[first].copy()
            bucket = self._other(prints, bucket)
        return not len(prints)

    def delete(self, hashes: np.ndarray) -> int:
        """Remove one entry for each hash that was inserted; returns how many were found."""
        prints, bucket = self._home(hashes)
        found = 0
        for bucket_of in (lambda p, b: b, self._other):
            at = bucket_of(prints, bucket)
            left = np.ones(len(prints), bool)
            for slot in range(SLOTS):
                index = np.flatnonzero(left & (self.table[at, slot] == prints))
                # Equal fingerprints of one bucket take different slots.
                _, once = np.unique(at[index], return_index=True)
                index = index[once]
                self.table[at[index], slot] = 0
                left[index] = False
                found += len(index)
            prints, bucket = prints[left], bucket[left]
        return found
