"""Line dedup that can be undone: exact reference counts of lines in tables, cuckoo filters in front of them.

A *reference count* says in how many documents a line occurs. The counts lie in a table in the shared
folder; inserting documents adds to them, deleting documents takes away again. Lines at or above the
threshold are also in a cuckoo filter of their shard. Which lines of a document go is asked of the filters
first; what they let through (about all frequent lines, few others) is checked against the exact counts.

Rules. A row is a document, so rows that repeat count each. Null or empty text is one empty line. The key of a
line is the line without white space ``[\\x20\\x09-\\x0D]`` at both ends, with A-Z in lower case; its identity is a
128-bit hash. Empty keys never go. An empty table gives an empty result. Other columns are kept as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE_SPACE, arrow_map, free_name, partitions, row_keys, shared_folder
from .cuckoo import Cuckoo

#: Pieces into which the lines asked of one shard are dealt, as one line may be in very many documents.
SALTS = 8


def line_keys(text: str | None) -> list[bytes]:
    return [line.strip(WHITE_SPACE) for line in (text or "").encode().lower().split(b"\n")]


def key_hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _document_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each different key of each document."""
    for batch in batches:
        for first in range(0, batch.num_rows, 1000):
            part = batch.slice(first, 1000)
            sizes, digests = [], []
            for text in part.column("text").to_pylist():
                own = {key_hash(k) for k in line_keys(text) if k}
                sizes.append(len(own))
                digests.extend(own)
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            row = np.repeat(np.arange(part.num_rows), sizes)
            r1, r2 = (part.column(c).to_numpy()[row] for c in ("r1", "r2"))
            yield pa.RecordBatch.from_pydict({"r1": r1, "r2": r2, "k1": halves[:, 0].copy(), "k2": halves[:, 1].copy()})


def document_lines(docs: DataFrame) -> DataFrame:
    """(r1, r2) of the document and (k1, k2) of each of its lines."""
    r1, r2 = row_keys("doc_id", "text")
    return arrow_map(docs.select(r1.alias("r1"), r2.alias("r2"), "text"), _document_keys, "r1 long, r2 long, k1 long, k2 long")


class LineRegistry:
    """Reference counts and filters in ``folder``; each change writes a new version of both."""

    def __init__(self, spark: SparkSession, min_docs: int = 10, folder: str | None = None) -> None:
        self.spark, self.min_docs, self.shards = spark, min_docs, partitions(spark)
        self.folder = folder or f"{shared_folder(spark)}/lines-{uuid.uuid4().hex}"
        self.version = 0

    def _read(self, kind: str, schema: str) -> DataFrame:
        if not self.version:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{kind}-{self.version}")

    def counts(self) -> DataFrame:
        return self._read("counts", "k1 long, k2 long, n long")

    def filters(self) -> DataFrame:
        return self._read("filters", "shard int, filter binary")

    def _shard(self):
        return F.pmod("k2", F.lit(self.shards)).cast("int")

    def insert(self, docs: DataFrame) -> None:
        self._change(docs, 1)

    def delete(self, docs: DataFrame) -> None:
        """Takes documents that were inserted before out of the counts."""
        self._change(docs, -1)

    def _change(self, docs: DataFrame, sign: int) -> None:
        new = document_lines(docs).groupBy("k1", "k2").agg((sign * F.count("*")).alias("m"))
        if self.version:
            both = self.counts().join(new, ["k1", "k2"], "full").select("k1", "k2", F.coalesce("n", F.lit(0)).alias("was"), (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))
        else:
            both = new.select("k1", "k2", F.lit(0).cast("long").alias("was"), F.col("m").alias("n"))
        following = self.version + 1
        both.where((F.col("n") > 0) | (F.col("was") > 0)).write.parquet(f"{self.folder}/changed-{following}")
        changed = self.spark.read.parquet(f"{self.folder}/changed-{following}")
        changed.where("n > 0").select("k1", "k2", "n").write.parquet(f"{self.folder}/counts-{following}")
        least = self.min_docs
        hot = changed.where((F.col("n") >= least) | (F.col("was") >= least)).select(self._shard().alias("shard"), "k1", (F.col("was") >= least).alias("before"), (F.col("n") >= least).alias("after"))
        self.filters().groupBy("shard").cogroup(hot.groupBy("shard")).applyInArrow(_refilter, "shard int, filter binary").write.parquet(f"{self.folder}/filters-{following}")
        self.version = following

    def frequent(self, docs: DataFrame) -> DataFrame:
        """(r1, r2) of each document that has frequent lines, and ``gone``: (k1, k2) of those."""
        filters = self.filters().select("shard", F.explode(F.array(*map(F.lit, range(SALTS)))).alias("salt"), "filter", *(F.lit(None).cast("long").alias(c) for c in ("r1", "r2", "k1", "k2")))
        asked = document_lines(docs).select(self._shard().alias("shard"), F.pmod("r2", F.lit(SALTS)).cast("int").alias("salt"), F.lit(None).cast("binary").alias("filter"), "r1", "r2", "k1", "k2")
        together = filters.unionByName(asked).repartition(self.shards, "shard", "salt").sortWithinPartitions("shard", "salt", F.col("filter").desc_nulls_last())
        passed = arrow_map(together, _probe, "r1 long, r2 long, k1 long, k2 long")
        exact = passed.join(self.counts().where(F.col("n") >= self.min_docs), ["k1", "k2"])
        return exact.groupBy("r1", "r2").agg(F.collect_set(F.struct("k1", "k2")).alias("gone"))

    def drop_lines(self, docs: DataFrame) -> DataFrame:
        """``docs`` with the text without frequent lines, ``n_lines`` before and ``n_dropped``; null text stays null."""
        r1, r2, gone, lines, dropped = (free_name(docs, c) for c in ("r1", "r2", "gone", "n_lines", "n_dropped"))
        k1, k2 = row_keys("doc_id", "text")
        found = self.frequent(docs).toDF(r1, r2, gone)
        joined = docs.withColumns({r1: k1, r2: k2}).join(found, [r1, r2], "left").drop(r1, r2)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", {lines} long, {dropped} long"
        return arrow_map(joined, _cutter(gone, lines, dropped), schema)


def _refilter(key, old: pa.Table, hot: pa.Table) -> pa.Table:
    keys, before, after = (hot.column(c).to_numpy() for c in ("k1", "before", "after")) if len(hot) else (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, bool))
    cuckoo = Cuckoo(blob=old.column("filter")[0].as_py()) if len(old) else None
    coming, going = keys[after & ~before], keys[before & ~after]
    if cuckoo is not None:
        cuckoo.delete(going)
    if cuckoo is None or not cuckoo.has_room(len(coming)) or not cuckoo.insert(coming):
        own, room = keys[after], int(after.sum())
        cuckoo = Cuckoo(room)
        while not cuckoo.insert(own):
            room *= 2
            cuckoo = Cuckoo(room)
    shard = key[0].as_py()
    return pa.table({"shard": pa.array([shard], pa.int32()), "filter": pa.array([cuckoo.blob()], pa.binary())})


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A filter comes before the lines asked of it; only one filter is in memory at a time."""
    held, cuckoo = None, None
    for batch in batches:
        place = batch.column("shard").to_numpy().astype(np.int64) * SALTS + batch.column("salt").to_numpy()
        is_filter = batch.column("filter").is_valid().to_numpy(zero_copy_only=False)
        borders = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | is_filter[1:] | is_filter[:-1]]) if len(place) else []
        for first, last in zip(borders, [*borders[1:], len(place)]):
            if is_filter[first]:
                held, cuckoo = place[first], Cuckoo(blob=batch.column("filter")[int(first)].as_py())
            elif held == place[first]:
                part = batch.slice(first, last - first)
                keep = cuckoo.contains(part.column("k1").to_numpy())
                if keep.any():
                    yield part.select(["r1", "r2", "k1", "k2"]).filter(pa.array(keep))


def _cutter(gone: str, lines: str, dropped: str):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                texts, n_lines, n_dropped = [], [], []
                for text, keys in zip(part.column("text").to_pylist(), part.column(gone).to_pylist()):
                    own = (text or "").split("\n")
                    kept = own
                    if keys:
                        bad = {np.array([k["k1"], k["k2"]], np.int64).tobytes() for k in keys}
                        kept = [line for line, k in zip(own, line_keys(text)) if not k or key_hash(k) not in bad]
                    texts.append(None if text is None else "\n".join(kept))
                    n_lines.append(len(own))
                    n_dropped.append(len(own) - len(kept))
                columns = {c: part.column(c) for c in part.schema.names if c != gone}
                columns["text"] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_pydict(columns | {lines: pa.array(n_lines, pa.int64()), dropped: pa.array(n_dropped, pa.int64())})

    return cut


def dedup_lines(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """Drops every line found in ``min_docs`` or more documents of ``docs``."""
    registry = LineRegistry(docs.sparkSession, min_docs)
    registry.insert(docs)
    return registry.drop_lines(docs)
