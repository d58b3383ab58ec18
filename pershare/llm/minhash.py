"""Near copies by one-permutation hashing with optimal densification, banded buckets and stars of candidates.

The hash values of a set's shingles are its one permutation: the range of hashes is cut into ``BANDS * BAND_ROWS`` bins and the least
value of each bin is kept. An empty bin borrows from the first bin that is not empty among bins that a rule draws for it; each
bin has draws of its own, so borrowed values of similar sets agree like all others. ``BAND_ROWS`` bins are a band; sets that agree in
all bins of a band meet in its bucket. At a similarity of 0.85 a pair misses all 40 bands of 5 with a probability of 7e-11.

Equal sets are one class from the start, so copies never meet in a bucket. In each bucket the set with the smallest key is the centre
of a star and the others are its candidates: one pair for each place in a bucket, however large it is. Pairs that differ too much in
size, or in the parities of their shingles at 256 places, cannot be similar enough and go; all others are confirmed on the
full sets. Where a bucket still holds sets of different components, a second star starts at a set outside the first component. What is
open after that is compared in full: each open bucket is cut by size into blocks, and each pair of blocks that sizes allow is one
piece of work of fixed size, whose pairs that are not connected are confirmed likewise. So no link between sets that share a
bucket is lost, whatever the stars left out.

Rules. Rows are documents. A set has the different 5-word shingles of the text with A-Z lower-cased; with fewer words the
whole text is one shingle; null or empty text and text without words has an empty set and is linked with nothing. Ties: the
smallest doc_id names the component and is the document kept; if all are null, the name is null and all are kept; of rows that
repeat all are kept or none. Sets are told apart by a 64-bit hash and their size, shingles by 64-bit hashes. An empty table gives
no rows; other columns than ``doc_id`` and ``text`` are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import _tables, arrow_map, chunks, filter_place, mixed, partitions, passes, row_filter, row_keys, stored
from .components import components
from .shingles import common, set_key, shingle_sets

BANDS = 40
BAND_ROWS = 5
#: Draws of a donor that are looked up at once.
DRAWS = 64
#: Sets in a block of an open bucket.
BLOCK = 1024
#: Words of 64 places each that hold the parities of a set.
PARITIES = ("p0", "p1", "p2", "p3")
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _donors(bins: int, first: int) -> np.ndarray:
    """Bins that each bin borrows from, in the order in which they are asked: draws ``first`` to ``first + DRAWS``."""
    name = f"donors{bins}-{first}"
    if name not in _tables:
        draw = np.arange(bins, dtype=np.uint64)[:, None] << np.uint64(32) | np.arange(first, first + DRAWS, dtype=np.uint64)
        _tables[name] = (mixed(draw + np.uint64(1)) % np.uint64(bins)).astype(np.int64)
    return _tables[name]


def signature(shingles: np.ndarray, bins: int) -> np.ndarray:
    """The least hash of each bin of a sorted set that is not empty; empty bins borrow."""
    start = np.searchsorted(shingles, np.arange(bins, dtype=np.uint64) * np.uint64((1 << 64) // bins))
    full = start < np.r_[start[1:], len(shingles)]
    out = np.zeros(bins, np.uint64)
    out[full] = shingles[start[full]]
    empty, first = np.flatnonzero(~full), 0
    while len(empty):
        asked = _donors(bins, first)[empty]
        has = full[asked]
        met = has.any(1)
        out[empty[met]] = out[asked[met, has[met].argmax(1)]]
        empty, first = empty[~met], first + DRAWS
    return out


def band_keys(signature_: np.ndarray, bands: int) -> np.ndarray:
    """One bucket for each band."""
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for column in signature_.reshape(bands, -1).T:
        key = mixed(key * _STEP + column)
    return key.view(np.int64)


def parities(shingles: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls on each of 256 places, as four words."""
    odd = np.bincount((shingles >> np.uint64(8) & np.uint64(255)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def least_size(percent: int) -> int:
    """Shingles that a set needs to be similar enough to a different one."""
    return -(-100 // (100 - percent)) - 1 if percent < 100 else 1 << 62


def _sketch(least: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document; the buckets of a set come with the first document of the task that has it."""
        seen = set()
        for rows, data, offsets in chunks(batches):
            sids, sizes, bands = [], [], []
            for s in shingle_sets(data, offsets):
                sid = set_key(s)[0]
                sids.append(sid)
                sizes.append(len(s))
                if len(s) >= least and (sid, len(s)) not in seen:
                    seen.add((sid, len(s)))
                    bands.append(band_keys(signature(s, BANDS * BAND_ROWS), BANDS))
                else:
                    bands.append(None)
            made = {c: rows.column(c) for c in ("doc_id", "r1", "r2")}
            yield pa.RecordBatch.from_pydict(made | {"sid": pa.array(sids, pa.int64()), "n": pa.array(sizes, pa.int64()), "bands": pa.array(bands, pa.list_(pa.int64()))})

    return step


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by bucket and set those of buckets with two sets or more, and those at both ends of the partition, whose bucket may go on."""
    bucket, sid, kept, first = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), True

    def rows(keep: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"bucket": bucket[: len(keep)][keep], "sid": sid[: len(keep)][keep]})

    for batch in batches:
        if not batch.num_rows:
            continue
        # the last row of the batch before is held until its successor is known
        bucket = np.r_[bucket[-1:], batch.column("bucket").to_numpy()]
        sid = np.r_[sid[-1:], batch.column("sid").to_numpy()]
        new = np.r_[True, (bucket[1:] != bucket[:-1]) | (sid[1:] != sid[:-1])]
        bucket, sid, held = bucket[new], sid[new], kept[-1:]
        same = bucket[1:] == bucket[:-1]
        kept = np.r_[False, same] | np.r_[same, False]
        if len(held):
            kept[0] |= held[0]
        if first:
            kept[0], first = True, False
        if len(kept) > 1:
            yield rows(kept[:-1])
    if len(bucket):
        bucket, sid = bucket[-1:], sid[-1:]
        yield rows(np.ones(1, bool))


def _packer(held):
    """Texts of rows that the filter lets through, compressed, with sizes and parities of their sets."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, squeeze = np.frombuffer(held.value, np.uint8), zstandard.ZstdCompressor(3).compress
        for batch in batches:
            keep = batch.filter(pa.array(passes(bits, batch.column("place").to_numpy())))
            for part, data, offsets in chunks(iter([keep])):
                sets = shingle_sets(data, offsets)
                words = np.stack([parities(s) for s in sets], 1)
                packed = pa.array([squeeze(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())
                made = {"r1": part.column("r1"), "r2": part.column("r2"), "text": packed, "n": pa.array(map(len, sets), pa.int64())}
                yield pa.RecordBatch.from_pydict(made | dict(zip(PARITIES, words)))

    return pack


def _chooser(held):
    """Rows that the filter lets through."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(held.value, np.uint8)
        for batch in batches:
            yield batch.select(["sid", "text"]).filter(pa.array(passes(bits, batch.column("place").to_numpy())))

    return choose


def _full_set(text: pa.BinaryScalar) -> np.ndarray:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(text.as_buffer()), np.uint8)
    return shingle_sets(data, np.array([0, len(data)]))[0]


def _similar(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs whose full sets are similar enough; a centre's rows come together."""
        centre, own = None, None
        for batch in batches:
            keep = []
            for a, x, y in zip(batch.column("a").to_pylist(), batch.column("left"), batch.column("right")):
                if a != centre:
                    centre, own = a, _full_set(x)
                other = _full_set(y)
                both = common(own, other)
                keep.append(100 * both >= percent * (len(own) + len(other) - both))
            if any(keep):
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return confirm


def may_link(percent: int, one: str, other: str) -> Column:
    """False only for pairs that sizes or parities show to be too different."""
    differ = sum(F.bit_count(F.col(f"{one}.{p}").bitwiseXOR(F.col(f"{other}.{p}"))) for p in PARITIES)
    n, m = F.col(f"{one}.n"), F.col(f"{other}.n")
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * differ <= (100 - percent) * (n + m))


def open_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """All pairs of the ``entries`` (bucket, sid, root, n, parities) of a bucket that are not connected and may link, each from the least bucket both are in."""
    order = Window.partitionBy("bucket").orderBy("n", "sid")
    cut = stored(entries.withColumn("block", F.floor((F.row_number().over(order) - 1) / BLOCK)), "blocks")
    blocks = cut.groupBy("bucket", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    second = blocks.select("bucket", F.col("block").alias("j"), F.col("low").alias("next"))
    pairs = blocks.withColumnRenamed("block", "i").join(second, "bucket").where((F.col("i") <= F.col("j")) & (percent * F.col("next") <= 100 * F.col("high"))).select("bucket", "i", "j")
    # at most one bucket for each band
    cut = cut.join(cut.groupBy("sid").agg(F.collect_set("bucket").alias("own")), "sid")
    left = cut.withColumnRenamed("block", "i").join(pairs, ["bucket", "i"]).alias("s")
    right = cut.withColumnRenamed("block", "j").join(pairs, ["bucket", "j"]).alias("o")
    met = reduce(lambda x, y: x & y, (F.col(f"s.{c}") == F.col(f"o.{c}") for c in ("bucket", "i", "j")))
    one_way = (F.col("s.i") < F.col("s.j")) | (F.col("s.sid") < F.col("o.sid"))
    first = F.array_min(F.array_intersect("s.own", "o.own")) == F.col("s.bucket")
    found = left.join(right, met & (F.col("s.root") != F.col("o.root")) & one_way & may_link(percent, "s", "o") & first)
    return found.select(F.least("s.sid", "o.sid").alias("a"), F.greatest("s.sid", "o.sid").alias("b"))


def near_copies(docs: DataFrame, percent: int = 85) -> DataFrame:
    """A row for each of ``docs`` (doc_id integer, text): doc_id, n_shingles, component_id, kept."""
    spark, size = docs.sparkSession, partitions(docs.sparkSession)
    r1, r2 = row_keys("doc_id", "text")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), r1.alias("r1"), r2.alias("r2"), "text")
    known = stored(arrow_map(texts, _sketch(least_size(percent)), "doc_id long, r1 long, r2 long, sid long, n long, bands array<long>"), "sketch")

    placed = known.where("bands is not null").select(F.explode("bands").alias("bucket"), "sid")
    # a range of buckets and sets: a bucket with very many sets takes several tasks
    dealt = placed.repartitionByRange(size, "bucket", "sid").sortWithinPartitions("bucket", "sid")
    buckets = stored(arrow_map(dealt, _shared, "bucket long, sid long"), "buckets")

    whole = buckets.select("sid").distinct().join(known.groupBy("sid").agg(F.min(F.struct("r1", "r2")).alias("r")), "sid")
    whole = stored(whole.select("sid", "r.r1", "r.r2"), "wanted")
    held = spark.sparkContext.broadcast(row_filter(whole, "r1"))
    packed = arrow_map(texts.select("r1", "r2", filter_place("r1").alias("place"), "text"), _packer(held), "r1 long, r2 long, text binary, n long, " + ", ".join(f"{p} long" for p in PARITIES))
    whole = stored(packed.join(whole, ["r1", "r2"]).dropDuplicates(["r1", "r2", "sid"]).select("sid", "text", "n", *PARITIES), "sets")
    entries = stored(buckets.join(whole.drop("text"), "sid"), "entries")

    def confirmed(pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs, "candidates")
        asked = spark.sparkContext.broadcast(row_filter(pairs.selectExpr("explode(array(a, b)) as sid"), "sid"))
        chosen = arrow_map(whole.select("sid", filter_place("sid").alias("place"), "text"), _chooser(asked), "sid long, text binary")
        joined = pairs.join(chosen.toDF("b", "right"), "b").join(chosen.toDF("a", "left"), "a").sortWithinPartitions("a")
        return stored(arrow_map(joined, _similar(percent), "a long, b long"), "links")

    def stars(of: DataFrame, centres: DataFrame) -> DataFrame:
        """Candidates of the centre ``c`` of each bucket: the sets of its bucket in other components."""
        met = of.select("bucket", F.struct("sid", "root", "n", *PARITIES).alias("s")).join(centres, "bucket")
        met = met.where((F.col("s.root") != F.col("c.root")) & may_link(percent, "s", "c"))
        return met.select(F.least("c.sid", "s.sid").alias("a"), F.greatest("c.sid", "s.sid").alias("b")).distinct()

    def least(of: DataFrame) -> DataFrame:
        return of.groupBy("bucket").agg(F.min(F.struct("sid", "root", "n", *PARITIES)).alias("c"))

    def still_open(labels: DataFrame) -> DataFrame:
        """Entries of buckets with sets of several components, with the least of these."""
        now = entries.join(labels.toDF("sid", "root"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
        several = now.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
        return stored(now.join(several.select("bucket", "low"), "bucket"), "open")

    def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
        return stored(components(labels.selectExpr("id as a", "root as b").unionByName(links)), "labels")

    first = entries.withColumn("root", F.col("sid"))
    labels = stored(components(confirmed(stars(first, least(first)))), "labels")
    left = still_open(labels)
    labels = joined(labels, confirmed(stars(left, least(left.where(F.col("root") != F.col("low"))))))
    labels = joined(labels, confirmed(open_pairs(still_open(labels).drop("low"), percent)))

    classes = known.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("least")).join(labels.toDF("sid", "root"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    classes = stored(classes, "classes")
    named = classes.join(classes.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("sid", "component_id")
    out = known.where("n > 0").join(named, "sid").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    out = out.unionByName(known.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
