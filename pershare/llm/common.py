"""What several operators share: Arrow batches as numpy arrays, text hashing, tables in the shared folder."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python step works on at once.
CHUNK_BYTES = 1 << 20

#: The white space of all word and line rules.
WHITE_SPACE = b" \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``; a temporary one only where it is unset on a local master, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="pershare-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back: a cut of the lineage that survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_keys(*columns: Column | str) -> tuple[Column, Column]:
    """128 bits that identify a row by what it holds: equal rows have equal keys, whatever task reads them."""
    return F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that clashes with none of the frame's."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def _give_back() -> None:
    """Workers live on from task to task: memory that Arrow and the C library keep of what is done goes back."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def released(batches: Iterator) -> Iterator:
    """The batches; memory is given back after the last."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()
    _give_back()


def arrow_map(df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(released(batches))
        _give_back()

    return df.mapInArrow(run, schema)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts end to end as bytes, and where each begins and ends; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string() if not pa.types.is_binary(column.type) else pa.large_binary())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_large_string(column.type) else b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about ``size`` bytes of text, a longer text alone: (rows, bytes, offsets)."""
    for batch in batches:
        data, offsets = bytes_of(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
            yield batch.slice(first, last - first), data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
            first = last


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input changes every bit of the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


class _Cache(dict):
    """Tables made by a rule; they are made anew in each process instead of being sent along."""

    def __reduce__(self):
        return _Cache, ()


_tables = _Cache()


def byte_values() -> np.ndarray:
    """A random 64-bit value for each byte, from a rule."""
    if "values" not in _tables:
        _tables["values"] = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
    return _tables["values"]


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """0th to n-th power of the base (or of its inverse) modulo 2**64."""
    name = f"powers{inverse}"
    if len(_tables.get(name, ())) <= n:
        steps = np.full(max(n + 1, CHUNK_BYTES + 1), BASE_INVERSE if inverse else BASE, np.uint64)
        steps[0] = 1
        _tables[name] = np.multiply.accumulate(steps)
    return _tables[name]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes; ``span_hash`` takes the hash of any span from them."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_values()[data] * powers(len(data))[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (prefix[end] - prefix[start]) * powers(len(prefix), True)[start]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, bool)
_WORD[list(WHITE_SPACE)] = False


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word of all texts, and how many words come before each text."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _WORD[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    return start, end, np.searchsorted(start, offsets)


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mixed(span_hash(prefix_hashes(data), start, end) + (end - start).astype(np.uint64))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


#: Bits of a row filter, as a power of two, and the pieces in which it is gathered.
FILTER_BITS = 24
FILTER_PIECES = 64


def _gathered(key, table):
    bits = np.zeros((1 << FILTER_BITS) // FILTER_PIECES, bool)
    bits[table.column("place").to_numpy()] = True
    return pa.table({"piece": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})


def row_filter(keys: DataFrame, column: str) -> bytes:
    """Which hashed places the keys of a long column take: a filter of fixed size, 2 MB, that lets all of them through and few others.

    It only saves shuffling rows that a join would drop; with very many keys it lets everything through.
    """
    place = F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS))
    size = (1 << FILTER_BITS) // FILTER_PIECES
    taken = keys.select(F.floor(place / size).cast("int").alias("piece"), (place % size).cast("int").alias("place")).distinct()
    bits = np.zeros((FILTER_PIECES, size // 8), np.uint8)
    for row in taken.groupBy("piece").applyInArrow(_gathered, "piece int, bits binary").collect():
        bits[row["piece"]] = np.frombuffer(row["bits"], np.uint8)
    return bits.tobytes()


def passes(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which rows a filter lets through, by ``filter_place`` of their keys."""
    return (bits[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1 == 1


def filter_place(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS))
