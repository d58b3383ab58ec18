"""Removal of byte strings of ``length`` bytes that occur elsewhere, by a hash-compared suffix sort of anchored text.

Every window of ``length`` bytes has an *anchor*: its q-gram with the smallest hash, the leftmost of equals. Equal windows
have the same anchor at the same place, so only text around equal anchors is ever compared. The windows of
one anchor are a run; the text they cover is a *segment*. Segments are grouped by the anchor's hash. Where all of a
group are alike nothing is left to compare. Of the others one copy each goes to a task by anchor hash.

There the suffixes that begin at the anchors, and the reversed prefixes that end there, are merge-sorted. Two are compared by
their common extension, found by binary search on prefix polynomial hashes; extensions of neighbours are then
checked byte by byte, and sorted again with other hash values if a check fails. A window with ``x`` bytes before the
anchor and ``y`` from it occurs elsewhere exactly if another member has common extensions of at least x and y bytes:
members in the same block of both orders, blocks ending where neighbours have less in common.

Rules. Null text is empty. Rows are documents, so the text of rows that repeat occurs elsewhere. Matches stay within a
document but may overlap in it. Texts shorter than ``length`` are kept. Kept bytes may be no UTF-8, so they are binary.
The text of an anchor that is in many different segments is compared in one task; a segment has at most two
windows of bytes, and equal ones are sent once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, byte_values, chunks, free_name, mixed, partitions, powers, prefix_hashes, row_keys, signed, span_hash, stored

#: Bytes of an anchor.
Q = 24
#: Bytes of segments that are sorted at once; groups are never parted.
SORT_BYTES = 1 << 22
PLACE_BITS = 28


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(text, anchor's place, first and last window start, hash) of every run of windows with one anchor."""
    none = np.zeros(0, np.int64)
    span = length - Q + 1
    n = len(data) - length + 1
    if n <= 0:
        return none, none, none, none, none.astype(np.uint64)
    prefix = prefix_hashes(data)
    at = np.arange(len(data) - Q + 1)
    gram = mixed(span_hash(prefix, at, at + Q))
    key = (gram >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | at.astype(np.uint64)
    # minimum of each span from running minima of blocks, forwards and backwards
    rows = -(-len(key) // span)
    blocks = np.full(rows * span, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(key)] = key
    blocks = blocks.reshape(rows, span)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    start = np.arange(n)
    place = (np.minimum(behind[start], ahead[start + span - 1]) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    text = np.searchsorted(offsets, start, "right") - 1
    start = start[start + length <= offsets[text + 1]]
    if not len(start):
        return none, none, none, none, none.astype(np.uint64)
    text, place = text[start], place[start]
    new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (text[1:] != text[:-1])])
    return text[new], place[new], start[new], start[np.r_[new[1:] - 1, len(start) - 1]], gram[place[new]]


def _anchor_rows(length: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches):
            text, place, first, last, gram = anchors(data, offsets, length)
            if not len(text):
                continue
            raw = data.tobytes()
            digest = [xxhash.xxh3_128_digest(raw[a : b + length], p - a) for p, a, b in zip(place.tolist(), first.tolist(), last.tolist())]
            halves = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
            base = offsets[text]
            yield pa.RecordBatch.from_pydict(
                {"r1": rows.column("r1").to_numpy()[text], "r2": rows.column("r2").to_numpy()[text], "h": signed(gram), "d1": halves[:, 0].copy(), "d2": halves[:, 1].copy()}
                | {c: (v - base).astype(np.int32) for c, v in (("a", place), ("o1", first), ("o2", last))}
            )

    return step


def _segment_rows(length: int, asked: str):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = (batch.column("text")[i].as_py() or "").encode()
                wanted = batch.column(asked)[i].values
                cols = {c: wanted.field(c) for c in ("h", "d1", "d2", "n", "a", "o1", "o2")}
                a, o1, o2 = (cols[c].to_numpy() for c in ("a", "o1", "o2"))
                made = {c: cols[c] for c in ("h", "d1", "d2", "n")}
                yield pa.RecordBatch.from_pydict(made | {"lo": o1 - a, "hi": o2 - a, "segment": pa.array([raw[x : y + length] for x, y in zip(o1, o2)], pa.binary())})

    return step


class _Order:
    """Suffixes of one array of bytes in order, by group first, and the common extension of neighbours."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, group: np.ndarray) -> None:
        self.data, self.start, self.end, self.group = data, start, end, group
        for salt in range(8):
            self.values = mixed(byte_values() + np.uint64(salt))
            self.prefix = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(self.values[data] * powers(len(data))[: len(data)], out=self.prefix[1:])
            self.inverse = powers(len(data), True)
            self.order = self._sorted()
            self.common = self.extension(self.order[:-1], self.order[1:])
            if self._verified():
                return
        raise RuntimeError("prefix hashes collide with every set of values")

    def _hash(self, start: np.ndarray, n: np.ndarray) -> np.ndarray:
        return (self.prefix[start + n] - self.prefix[start]) * self.inverse[start]

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes i and j have in common; 0 for different groups."""
        low = np.zeros(len(i), np.int64)
        high = np.minimum(self.end[i] - self.start[i], self.end[j] - self.start[j])
        high[self.group[i] != self.group[j]] = 0
        x, y = self.start[i], self.start[j]
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = self._hash(x, middle) == self._hash(y, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def less(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        shared = self.extension(i, j)
        x, y = self.start[i] + shared, self.start[j] + shared
        over_i, over_j = x >= self.end[i], y >= self.end[j]
        last = len(self.data) - 1
        by_byte = self.data[np.minimum(x, last)] < self.data[np.minimum(y, last)]
        tie = over_i & over_j
        inside = np.where(tie, i < j, np.where(over_i, True, np.where(over_j, False, by_byte)))
        return np.where(self.group[i] != self.group[j], self.group[i] < self.group[j], inside)

    def _sorted(self) -> np.ndarray:
        """Bottom-up mergesort; all merges of a level at once, each element ranked in the other run by binary search."""
        order = np.arange(len(self.start))
        width, n = 1, len(order)
        while width < n:
            place = np.arange(n)
            run = place // width
            other = run ^ 1
            low = np.minimum(other * width, n)
            first, high = low.copy(), np.minimum(low + width, n)
            while (low < high).any():
                open_ = np.flatnonzero(low < high)
                middle = (low[open_] + high[open_]) >> 1
                before = self.less(order[middle], order[open_])
                low[open_] = np.where(before, middle + 1, low[open_])
                high[open_] = np.where(before, high[open_], middle)
            target = np.minimum(run, other) * width + (place - run * width) + (low - first)
            merged = np.empty_like(order)
            merged[target] = order
            order, width = merged, 2 * width
        return order

    def _verified(self) -> bool:
        """Whether neighbours agree in all bytes of their extension, differ after it and are in order."""
        i, j, n = self.order[:-1], self.order[1:], self.common
        reach = np.repeat(np.cumsum(n) - n, n)
        step = np.arange(int(n.sum())) - reach
        if (self.data[np.repeat(self.start[i], n) + step] != self.data[np.repeat(self.start[j], n) + step]).any():
            return False
        x, y = self.start[i] + n, self.start[j] + n
        inside = (self.group[i] == self.group[j]) & (x < self.end[i]) & (y < self.end[j])
        return bool((self.data[x[inside]] < self.data[y[inside]]).all())


def repeated_windows(segments: list[bytes], lo: np.ndarray, hi: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """For each segment and window start from -(length - Q) to 0 before the anchor: whether another segment of its group has it."""
    sizes = np.array([len(s) for s in segments])
    data = np.frombuffer(b"".join(segments), np.uint8)
    begin = np.cumsum(sizes) - sizes
    anchor, end = begin - lo, begin + sizes
    forward = _Order(data, anchor, end, group)
    total = len(data)
    backward = _Order(data[::-1].copy(), total - anchor, total - begin, group)
    n = len(segments)
    out = np.zeros((n, length - Q + 1), bool)
    own = [np.empty(n, np.int64), np.empty(n, np.int64)]
    for column, r in enumerate(range(Q - length, 1)):
        active = np.flatnonzero((lo <= r) & (hi >= r))
        if len(active) < 2:
            continue
        for side, sorting, least in ((0, forward, length + r), (1, backward, -r)):
            block = np.r_[0, np.cumsum((sorting.common < least) | (group[sorting.order[1:]] != group[sorting.order[:-1]]))]
            own[side][sorting.order] = block
        pair = own[0][active] * n + own[1][active]
        at = np.argsort(pair, kind="stable")
        same = pair[at][1:] == pair[at][:-1]
        out[active[at], column] = np.r_[same, False] | np.r_[False, same]
    return out


def _comparer(length: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("h", "d1", "d2", "n", "lo", "hi", "segment"))):
                if held and row[:3] == held[-1][:3]:
                    continue
                if size > SORT_BYTES and row[0] != held[-1][0]:
                    yield found(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[6])
        if held:
            yield found(held)

    def found(rows: list) -> pa.RecordBatch:
        h, d1, d2, n, lo, hi = (np.array(c) for c in list(zip(*rows))[:6])
        group = np.r_[0, np.cumsum(h[1:] != h[:-1])]
        windows = repeated_windows([r[6] for r in rows], lo, hi, group, length)
        place = np.arange(Q - length, 1)
        windows |= (n >= 2)[:, None] & (place >= lo[:, None]) & (place <= hi[:, None])
        edge = np.diff(np.pad(windows, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        (i, first), (_, last) = np.nonzero(edge == 1), np.nonzero(edge == -1)
        return pa.RecordBatch.from_pydict({"h": h[i], "d1": d1[i], "d2": d2[i], "low": (first + Q - length).astype(np.int32), "high": (last - 1 + Q).astype(np.int32)})

    return step


def _cutter(spans: str, names: tuple[str, ...]):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500)
                made = []
                for text, own in zip(rows.column("text").to_pylist(), rows.column(spans)):
                    raw, gone, runs = (text or "").encode(), 0, []
                    if own.is_valid and len(own.values):
                        x, y = (own.values.field(c).to_numpy() for c in ("x", "y"))
                        order = np.argsort(x, kind="stable")
                        x, y = x[order], np.maximum.accumulate(y[order])
                        new = np.flatnonzero(np.r_[True, x[1:] > y[:-1]])
                        runs = list(zip(x[new].tolist(), y[np.r_[new[1:] - 1, len(y) - 1]].tolist()))
                    parts, last = [], 0
                    for x, y in runs:
                        parts.append(raw[last:x])
                        gone, last = gone + y - x, y
                    parts.append(raw[last:])
                    made.append((b"".join(parts), len(raw), gone, len(runs)))
                kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
                columns = {c: rows.column(c) for c in rows.schema.names if c != spans}
                yield pa.RecordBatch.from_pydict(columns | {c: pa.array(v, kind) for c, v, kind in zip(names, zip(*made), kinds)})

    return step


def drop_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """``docs`` (doc_id, text) with kept (binary), n_bytes, n_removed and n_spans."""
    size = partitions(docs.sparkSession)
    k1, k2 = row_keys("doc_id", "text")
    s1, s2, s3 = (free_name(docs, c) for c in ("r1", "r2", "spans"))
    # both joins of the texts read all columns, and so the same shuffle: texts are moved and held on disk once
    keyed = docs.withColumns({s1: k1, s2: k2})
    texts = keyed.select(F.col(s1).alias("r1"), F.col(s2).alias("r2"), "text")
    marks = stored(arrow_map(texts, _anchor_rows(length), "r1 long, r2 long, h long, d1 long, d2 long, a int, o1 int, o2 int"), "anchors")
    shared = marks.groupBy("h").agg(F.count("*").alias("n"), ((F.min("d1") != F.max("d1")) | (F.min("d2") != F.max("d2"))).alias("differ")).where("n > 1").select("h", "differ")
    met = stored(marks.join(shared, "h"), "shared")
    alike = met.where("not differ").selectExpr("r1", "r2", "o1 as x", f"o2 + {length} as y")
    mixed_ = met.where("differ").drop("differ")
    one = mixed_.groupBy("h", "d1", "d2").agg(F.count("*").alias("n"), F.min(F.struct("r1", "r2", "a", "o1", "o2")).alias("m"))
    wanted = one.select("m.r1", "m.r2", F.struct("h", "d1", "d2", "n", "m.a", "m.o1", "m.o2").alias("w")).groupBy("r1", "r2").agg(F.collect_list("w").alias("w")).toDF(s1, s2, s3)
    segments = arrow_map(keyed.join(wanted, [s1, s2]), _segment_rows(length, s3), "h long, d1 long, d2 long, n long, lo int, hi int, segment binary")
    found = arrow_map(segments.repartition(size, "h").sortWithinPartitions("h", "d1", "d2"), _comparer(length), "h long, d1 long, d2 long, low int, high int")
    unlike = mixed_.join(found, ["h", "d1", "d2"]).selectExpr("r1", "r2", "a + low as x", "a + high as y")
    spans = alike.unionByName(unlike).groupBy("r1", "r2").agg(F.collect_list(F.struct("x", "y")).alias("spans")).toDF(s1, s2, s3)
    names = tuple(free_name(docs, c) for c in ("kept", "n_bytes", "n_removed", "n_spans"))
    joined = keyed.join(spans, [s1, s2], "left").drop(s1, s2)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return arrow_map(joined, _cutter(s3, names), f"{schema}, {names[0]} binary, {names[1]} long, {names[2]} long, {names[3]} long")
