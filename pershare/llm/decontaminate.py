"""Benchmark passages in documents: q-gram lemma filtering in diagonal bands, then banded alignment.

Texts are compared with A-Z in lower case and every run of other ASCII than letters and digits as one space. Each
benchmark text is cut into patterns of ``WINDOW`` bytes, one every ``STRIDE`` bytes; a shorter text is one pattern. A region
within ``k`` edits of a pattern of m bytes has at least ``m - Q + 1 - k Q`` q-grams in common with it, on
diagonals that differ by k at most. So common q-grams are counted in bands of 2(k + 1) diagonals that overlap by half, and only
bands with enough of them are aligned: edit distance of the whole pattern against any part of the band's region.

Benchmark texts go to the tasks in blocks of ``BLOCK_BYTES``; a larger benchmark takes several passes over the documents,
with the same result. Rules: null and empty texts, and benchmark texts of fewer than ``SHORTEST`` bytes after folding, match
nothing. Rows are documents; rows that repeat are found each. An item whose text is in the table twice is found under
each id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, bytes_of, chunks, free_name, prefix_hashes, released, row_keys, span_hash

WINDOW = 80
#: Bytes from one pattern of a text to the next.
STRIDE = 20
Q = 10
SHORTEST = 30
#: Share of a pattern's bytes that may be edits.
EDITS = 0.08
#: Bytes of benchmark text that tasks hold at once.
BLOCK_BYTES = 4 << 20
TABLE_BITS = 23
#: Bytes of document text that are searched at once: each takes some 60 bytes of arrays.
STEP_BYTES = 1 << 19
#: Bands aligned at once.
SLICE = 4096

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[48:58] = np.arange(48, 58)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)


def folded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, offsets of the texts in them, and where each byte was."""
    data = _FOLD[data]
    space = data == 32
    keep = np.ones(len(data), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep[offsets[:-1][offsets[:-1] < len(data)]] = True
    return data[keep], np.r_[0, np.cumsum(keep)][offsets], np.flatnonzero(keep)


class Patterns:
    """Patterns of some benchmark texts and the q-grams in them."""

    def __init__(self, item_ids: list[int], texts: list[str]) -> None:
        data, offsets = bytes_of(pa.array(texts, pa.string()))
        data, offsets, _ = folded(data, offsets)
        self.items, pieces = [], []
        for item, a, b in zip(item_ids, offsets[:-1], offsets[1:]):
            own = data[a:b].tobytes().strip(b" ")
            if len(own) < SHORTEST:
                continue
            last = max(0, len(own) - WINDOW)
            for at in sorted({*range(0, last, STRIDE), last}):
                self.items.append(item)
                pieces.append(own[at : at + WINDOW])
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.edits = np.minimum((EDITS * self.size).astype(np.int64), np.maximum(self.size - Q, 0) // Q)
        self.least = self.size - Q + 1 - Q * self.edits
        self.data = np.zeros((len(pieces), WINDOW), np.uint8)
        for i, p in enumerate(pieces):
            self.data[i, : len(p)] = np.frombuffer(p, np.uint8)
        flat = self.data.ravel()
        hashes = span_hash(prefix_hashes(flat), np.arange(len(flat) - Q + 1), np.arange(Q, len(flat) + 1)) if len(flat) else np.zeros(0, np.uint64)
        place = np.arange(len(hashes))
        good = place % WINDOW + Q <= self.size[place // WINDOW] if len(flat) else place > 0
        order = np.argsort(hashes[good], kind="stable")
        self.grams, self.place = hashes[good][order], place[good][order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.grams >> np.uint64(64 - TABLE_BITS)] = True

    def bands(self, data: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, pattern, first diagonal, width) of the bands with enough q-grams in common."""
        none = (np.zeros(0, np.int64),) * 4
        if len(data) < Q or not len(self.grams):
            return none
        at = np.arange(len(data) - Q + 1)
        hashes = span_hash(prefix_hashes(data), at, at + Q)
        at = at[self.table[hashes >> np.uint64(64 - TABLE_BITS)]]
        at = at[text[at] == text[at + Q - 1]]
        low, high = np.searchsorted(self.grams, hashes[at], "left"), np.searchsorted(self.grams, hashes[at], "right")
        n = high - low
        if not n.sum():
            return none
        spot = np.repeat(at, n)
        place = self.place[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
        pattern = place // WINDOW
        # a quick look first: a pattern needs that many in the whole text
        pair = text[spot].astype(np.int64) * len(self.size) + pattern
        order = np.argsort(pair, kind="stable")
        border = np.flatnonzero(np.r_[True, pair[order][1:] != pair[order][:-1]])
        count = np.diff(np.r_[border, len(pair)])
        order = order[np.repeat(count >= self.least[pattern[order[border]]], count)]
        if not len(order):
            return none
        spot, pattern = spot[order], pattern[order]
        diagonal = spot - place[order] % WINDOW
        step = self.edits[pattern] + 1
        key = np.stack([np.r_[pattern, pattern], np.r_[diagonal // step, diagonal // step - 1], np.r_[text[spot], text[spot]]])
        order = np.lexsort(key)
        key = key[:, order]
        border = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(0)])
        count = np.diff(np.r_[border, key.shape[1]])
        pattern, band, own = key[:, border[count >= self.least[key[0, border]]]]
        return own, pattern, band * (self.edits[pattern] + 1), 2 * (self.edits[pattern] + 1)

    def aligned(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, pattern: np.ndarray, diagonal: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fewest edits of each pattern in its band of the text from begin to end, and where the part ends."""
        most, ends = np.zeros(len(pattern), np.int64), np.zeros(len(pattern), np.int64)
        for at in range(0, len(pattern), SLICE):
            own = slice(at, at + SLICE)
            p, k = pattern[own], self.edits[pattern[own]]
            start = diagonal[own] - k
            cells = int((width[own] + 2 * k).max())
            column = np.arange(cells)
            inside = column < (width[own] + 2 * k)[:, None]
            big = np.int64(WINDOW * 2)
            row = np.where(inside, 0, big)
            for i in range(int(self.size[p].max())):
                place = start[:, None] + i + column
                there = (place >= begin[own][:, None]) & (place < end[own][:, None])
                same = there & (data[np.clip(place, 0, len(data) - 1)] == self.data[p, i][:, None])
                following = np.minimum(np.where(same, row, np.where(there, row + 1, big)), np.c_[row[:, 1:] + 1, np.full(len(p), big)])
                # bytes of the text left out: the running minimum along the row
                following = np.minimum.accumulate(following - column, 1) + column
                following = np.where(inside, np.minimum(following, big), big)
                row = np.where((i < self.size[p])[:, None], following, row)
            best = row.argmin(1)
            most[own], ends[own] = row[np.arange(len(p)), best], start + self.size[p] + best
        return most, ends


def _passages(patterns: Patterns, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, pattern, edits, end) of the patterns found in folded texts."""
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    own, pattern, diagonal, width = patterns.bands(data, text)
    if not len(own):
        return own, pattern, own, own
    edits, end = patterns.aligned(data, offsets[own], offsets[own + 1], pattern, diagonal, width)
    good = edits <= patterns.edits[pattern]
    return own[good], pattern[good], edits[good], end[good]


def _finder(held):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = Patterns(*held.value)
        for rows, data, offsets in chunks(batches, size=STEP_BYTES):
            data, offsets, _ = folded(data, offsets)
            own, pattern, edits, end = _passages(patterns, data, offsets)
            if not len(own):
                continue
            found: dict = {}
            for i, p, e, z in zip(own.tolist(), pattern.tolist(), edits.tolist(), end.tolist()):
                one = found.setdefault((i, patterns.items[p]), [set(), e, z, z])
                one[0].add(p)
                one[1:] = min(one[1], e), min(one[2], z - int(patterns.size[p])), max(one[3], z)
            i = np.array([key[0] for key in found])
            made = {c: rows.column(c).take(pa.array(i)) for c in ("doc_id", "r1", "r2")}
            first = [max(0, int(v[2] - offsets[k])) for k, v in zip(i, found.values())]
            last = [min(int(v[3]), int(offsets[k + 1])) - int(offsets[k]) for k, v in zip(i, found.values())]
            yield pa.RecordBatch.from_pydict(made | {"item_id": pa.array([key[1] for key in found], pa.int64()), "n_windows": pa.array([len(v[0]) for v in found.values()], pa.int64()), "edits": pa.array([v[1] for v in found.values()], pa.int64()), "first": pa.array(first, pa.int64()), "last": pa.array(last, pa.int64())})

    return find


def _marked(held):
    """Whether texts hold a passage, as a function on columns."""

    @F.arrow_udf("boolean")
    def marked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        patterns = Patterns(*held.value)
        for batch in released(batches):
            bad = np.zeros(len(batch), bool)
            first = 0
            for rows, data, offsets in chunks(iter([pa.RecordBatch.from_arrays([batch], ["text"])]), size=STEP_BYTES):
                data, offsets, _ = folded(data, offsets)
                bad[first + _passages(patterns, data, offsets)[0]] = True
                first += rows.num_rows
            yield pa.array(bad)

    return marked


def _blocks(benchmark: DataFrame) -> Iterator:
    """The benchmark's texts with their ids, in blocks of bounded size, each sent to all tasks."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-2 * total // BLOCK_BYTES))
    for block in range(n_blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).orderBy("item_id", "text").collect()
        yield benchmark.sparkSession.sparkContext.broadcast(([r["item_id"] for r in own], [r["text"] for r in own]))


def _found(docs: DataFrame, blocks: list) -> DataFrame:
    k1, k2 = row_keys("doc_id", "text")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), k1.alias("r1"), k2.alias("r2"), "text")
    schema = "doc_id long, r1 long, r2 long, item_id long, n_windows long, edits long, first long, last long"
    return reduce(DataFrame.unionByName, (arrow_map(texts, _finder(held), schema) for held in blocks))


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents with benchmark passages: doc_id, r1 and r2 (row key), item_id, n_windows found, fewest edits, and the region in the folded text (first, last)."""
    return _found(docs, list(_blocks(benchmark)))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that hold a benchmark passage.

    With one block of benchmark texts rows are marked where they are read, and no text is shuffled. With more, what is found with each
    block is gathered by row key, so that no task holds more than a block.
    """
    blocks = list(_blocks(benchmark))
    if len(blocks) == 1:
        return docs.where(~_marked(blocks[0])(F.col("text")))
    k1, k2 = row_keys("doc_id", "text")
    r1, r2 = free_name(docs, "r1"), free_name(docs, "r2")
    bad = _found(docs, blocks).select("r1", "r2").distinct().toDF(r1, r2)
    return docs.withColumns({r1: k1, r2: k2}).join(bad, [r1, r2], "left_anti").drop(r1, r2)
