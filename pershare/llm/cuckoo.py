"""Cuckoo filters over 64-bit keys, as numpy arrays; inserts and deletes work on whole arrays of keys."""

from __future__ import annotations

import numpy as np

from .common import mixed

SLOTS = 4
#: Share of the slots that may be taken before a filter is built anew with twice the buckets.
MAX_LOAD = 0.8
MAX_MOVES = 500


class Cuckoo:
    """Buckets of four 16-bit fingerprints. A key is in one of two buckets; either follows from the other and the fingerprint."""

    def __init__(self, n_keys: int = 0, blob: bytes | None = None) -> None:
        if blob is not None:
            self.slots = np.frombuffer(blob, np.uint16).reshape(-1, SLOTS).copy()
        else:
            n = 1 << max(2, int(np.ceil(np.log2(max(1, n_keys) / (SLOTS * MAX_LOAD)))))
            self.slots = np.zeros((n, SLOTS), np.uint16)
        self.mask = np.uint64(len(self.slots) - 1)

    def blob(self) -> bytes:
        return self.slots.tobytes()

    def has_room(self, more: int) -> bool:
        return np.count_nonzero(self.slots) + more <= MAX_LOAD * self.slots.size

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mixed(keys.view(np.uint64))
        prints = (h >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        return prints, h & self.mask

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return (bucket ^ mixed(prints.astype(np.uint64))) & self.mask

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, first = self._places(keys)
        second = self._other(first, prints)
        return ((self.slots[first] == prints[:, None]) | (self.slots[second] == prints[:, None])).any(1)

    def insert(self, keys: np.ndarray) -> bool:
        """Adds each key once more; False if no place was found (then build a larger filter)."""
        prints, bucket = self._places(keys)
        rng = np.random.default_rng(len(keys))
        for move in range(MAX_MOVES):
            if not len(prints):
                return True
            order = np.argsort(bucket, kind="stable")
            prints, bucket = prints[order], bucket[order]
            new = np.r_[True, bucket[1:] != bucket[:-1]]
            rank = np.arange(len(bucket)) - np.maximum.accumulate(np.where(new, np.arange(len(bucket)), 0))
            free = self.slots[bucket] == 0
            fits = rank < free.sum(1)
            # the rank-th free slot of the bucket
            column = np.argmax(np.cumsum(free, 1) == (rank + 1)[:, None], 1)
            self.slots[bucket[fits], column[fits]] = prints[fits]
            left, at = prints[~fits], bucket[~fits]
            if move and len(left):
                # one newcomer for each full bucket takes the place of a random tenant, which moves on
                head = np.r_[True, at[1:] != at[:-1]]
                column = rng.integers(0, SLOTS, head.sum())
                out = self.slots[at[head], column].copy()
                self.slots[at[head], column] = left[head]
                left[head] = out
            prints, bucket = left, self._other(at, left)
        return not len(prints)

    def delete(self, keys: np.ndarray) -> None:
        """Takes each key, inserted before, out once."""
        prints, first = self._places(keys)
        for one, at in zip(prints, first):
            for bucket in (at, self._other(at[None], one[None])[0]):
                found = np.flatnonzero(self.slots[bucket] == one)
                if len(found):
                    self.slots[bucket, found[0]] = 0
                    break
