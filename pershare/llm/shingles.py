"""Sets of word shingles as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

from .common import lower, mixed, word_hashes, word_spans

#: Words in a shingle.
WIDTH = 5


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """Different shingles of each text; a shorter text is one shingle, a text without words none."""
    data = lower(data)
    start, end, before = word_spans(data, offsets)
    word = word_hashes(data, start, end) if len(start) else np.zeros(0, np.uint64)
    run = np.zeros(len(word), np.uint64)
    n = max(0, len(word) - width + 1)
    for k in range(width):
        run[:n] = run[:n] * np.uint64(0xD6E8FEB86659FD93) + word[k : k + n]
    run = mixed(run)
    out = []
    for a, b in zip(before[:-1], before[1:]):
        if b - a >= width:
            out.append(np.unique(run[a : b - width + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            for w in word[a:b]:
                whole = mixed(np.array([whole]) * np.uint64(0xD6E8FEB86659FD93) + w)[0]
            out.append(np.array([whole]))
        else:
            out.append(run[:0])
    return out


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for the set."""
    total = np.add.reduce(mixed(shingles + np.uint64(1)), dtype=np.uint64)
    other = np.add.reduce(mixed(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)
    return int(np.int64(total)), int(np.int64(other))


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a)) if len(b) else 0
