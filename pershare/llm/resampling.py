"""Importance resampling of documents towards a target by hashed n-gram features.

Texts are cut into words by an untrained pre-tokeniser, a Regex Split over the text with A-Z lower-cased, which returns
words with their byte offsets. A feature is a window of 1 to ``longest`` consecutive words joined by one space; its bucket
is the crc32 of its bytes modulo ``buckets``. No feature is ever put together as text: words are looked up in the
vocabulary of a chunk, and the checksum of a window follows from those of its words and the lengths their offset pairs
give, as a checksum is linear over GF(2).

One pass over the texts writes a histogram of each document and one of each task's documents; the latter are summed by
bucket. The gain of a bucket is the logarithm of its smoothed share of the target's features over its share of the
documents' features, in thousandths, rounded down. A document's weight is the mean gain of its features, rounded down, and its score
is the weight plus Gumbel noise that belongs to its id: the highest scores are a sample without replacement by weight.

Rules. Every row is a document, with its own row in the result; other columns than ``doc_id`` and ``text`` are left out.
Null, empty and wordless texts have no features and weight 0. Ties in the score go to the smaller doc_id, null last; rows
that repeat share their score and have ranks of their own. A null id is drawn as an empty one. An empty table of
documents gives no rows, an empty target gives gains from smoothing alone. Long texts are tokenised in pieces that end between
two words; windows run across pieces.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, chunks, lower, stored
from .ordered import numbered

#: What a word is, on texts with A-Z lower-cased.
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BETWEEN = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
#: Bytes of a text that are tokenised at once, about, and words gathered before they are looked up.
PIECE = 1 << 15
GATHERED = 1 << 18
#: Longest shift of a checksum, in bytes, as a power of two.
SHIFTS = 40
HISTOGRAM = "doc_id long, n_words long, n_features long, buckets array<int>, counts array<int>, total boolean"


def _shift_tables() -> np.ndarray:
    """For each power of two the images of all bytes at the four places of a checksum, when so many zero bytes follow."""
    one = np.array([[zlib.crc32(b"\0", byte << 8 * place) ^ zlib.crc32(b"\0") for byte in range(256)] for place in range(4)], np.uint32)
    out = [one]
    while len(out) < SHIFTS:
        out.append(_shifted(out[-1], out[-1]))
    return np.stack(out)


def _shifted(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]


def appended(tables: np.ndarray, first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Checksums of texts put together, from those of their two parts and the length of the second."""
    out = first.copy()
    for bit in range(int(length.max(initial=0)).bit_length()):
        at = np.flatnonzero(length >> bit & 1)
        out[at] = _shifted(tables[bit], out[at])
    return out ^ second


def pieces(text: bytes) -> Iterator[str]:
    """A text in parts that end between two words."""
    first = 0
    while len(text) - first > PIECE and (cut := _BETWEEN.search(text, first + PIECE)):
        yield text[first : cut.start()].decode()
        first = cut.start()
    yield text[first:].decode()


class Features:
    """Words of texts and the buckets of their windows."""

    def __init__(self, longest: int, buckets: int):
        from tokenizers import PreTokenizedString, Regex
        from tokenizers.pre_tokenizers import Split

        self.text, self.split = PreTokenizedString, Split(Regex(WORDS), "removed", invert=True)
        self.tables, self.longest, self.buckets = _shift_tables(), longest, buckets

    def _words(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[list, list, np.ndarray]]:
        """(words, their offset pairs, number of words in each of the texts), in parts."""
        words, spans, counts = [], [], np.zeros(len(offsets) - 1, np.int64)
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            for piece in pieces(data[a:b].tobytes()):
                cut = self.text(piece)
                self.split.pre_tokenize(cut)
                found = cut.get_splits("original", "byte")
                words.extend(word for word, _, _ in found)
                spans.extend(span for _, span, _ in found)
                counts[i] += len(found)
                if len(words) > GATHERED:
                    yield words, spans, counts
                    words, spans, counts = [], [], np.zeros(len(offsets) - 1, np.int64)
        yield words, spans, counts

    def histograms(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For texts with A-Z lower-cased: number of words of each, then (text, bucket, count) of each of their buckets."""
        crcs, lengths, counts = [], [], np.zeros(len(offsets) - 1, np.int64)
        for words, spans, own in self._words(data, offsets):
            held = pa.array(words, pa.string()).dictionary_encode()
            known = np.array([zlib.crc32(w.encode()) for w in held.dictionary.to_pylist()], np.uint32)
            crcs.append(known[held.indices.to_numpy()] if len(known) else known)
            span = np.array(spans, np.int64).reshape(-1, 2)
            lengths.append(span[:, 1] - span[:, 0])
            counts += own
        word, length = np.concatenate(crcs), np.concatenate(lengths)
        text = np.repeat(np.arange(len(counts)), counts)
        keys, run, one, space = [], word, np.ones(len(word), np.int64), np.uint32(zlib.crc32(b" "))
        for more in range(self.longest):
            if more:  # windows of one word more, as far as they stay in their text
                run = appended(self.tables, appended(self.tables, run[:-1], space, one[: len(run) - 1]), word[more:], length[more:])
            inside = text[: len(run)] == text[more:]
            keys.append(text[: len(run)][inside] * self.buckets + run[inside] % np.uint32(self.buckets))
            if len(run) < 2:
                break
        key, n = np.unique(np.concatenate(keys), return_counts=True)
        return counts, key // self.buckets, key % self.buckets, n


def _histogram(longest: int, buckets: int):
    def rows(doc_id, n_words, texts, bucket, n, total) -> pa.RecordBatch:
        border = pa.array(np.searchsorted(texts, np.arange(len(n_words) + 1)), pa.int32())
        lists = [pa.ListArray.from_arrays(border, pa.array(values, pa.int32())) for values in (bucket, n)]
        features = np.bincount(texts, weights=n, minlength=len(n_words)).astype(np.int64)
        return pa.RecordBatch.from_pydict({"doc_id": doc_id, "n_words": pa.array(n_words), "n_features": pa.array(features), "buckets": lists[0], "counts": lists[1], "total": pa.array([total] * len(n_words))})

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(longest, buckets), np.zeros(buckets, np.int64)
        for part, data, offsets in chunks(batches):
            n_words, texts, bucket, n = features.histograms(lower(data), offsets)
            total += np.bincount(bucket, weights=n, minlength=buckets).astype(np.int64)
            yield rows(part.column("doc_id"), n_words, texts, bucket, n, False)
        met = np.flatnonzero(total)
        if len(met):
            yield rows(pa.nulls(1, pa.int64()), np.zeros(1, np.int64), np.zeros(len(met), np.int64), met, total[met], True)

    return step


def histograms(docs: DataFrame, longest: int, buckets: int) -> DataFrame:
    """A row for each of ``docs`` (doc_id, text) with its buckets, and a row for each task (``total``) with their sums."""
    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _histogram(longest, buckets), HISTOGRAM)


def _bucket_counts(found: DataFrame, name: str) -> DataFrame:
    each = found.where("total").select(F.explode(F.arrays_zip("buckets", "counts")).alias("b"))
    return each.groupBy(F.col("b.buckets").alias("bucket")).agg(F.sum("b.counts").alias(name))


def gains(found: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """The gain of every bucket, from histograms of documents and target; ``buckets`` numbers, whatever the input."""
    raw, wanted = _bucket_counts(found, "s"), _bucket_counts(target, "t")
    all_ = raw.join(wanted, "bucket", "full").select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t"))
    s, t = np.zeros(buckets), np.zeros(buckets)
    for row in all_.toLocalIterator():
        s[row["bucket"]], t[row["bucket"]] = row["s"], row["t"]
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def _weigh(gain):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket, count = batch.column("buckets"), batch.column("counts")
            sizes = np.diff(bucket.offsets.to_numpy())
            worth = np.r_[0, np.cumsum(gain.value[bucket.flatten().to_numpy()] * count.flatten().to_numpy().astype(np.int64))]
            ends = np.cumsum(sizes)
            n = batch.column("n_features").to_numpy()
            weight = (worth[ends] - worth[ends - sizes]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_words": batch.column("n_words"), "n_features": batch.column("n_features"), "weight": pa.array(weight, pa.int64())})

    return step


def gumbel(key: str, seed: int) -> Column:
    """Noise in thousandths that belongs to the id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(float(1 << 32))))).cast("long")


def importance(docs: DataFrame, target: DataFrame, longest: int = 2, buckets: int = 10_000, seed: int = 7) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of all ``docs`` (doc_id, text) with a view to the texts of ``target``."""
    found = stored(histograms(docs, longest, buckets), "histograms")
    wanted = histograms(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), longest, buckets)
    gain = docs.sparkSession.sparkContext.broadcast(gains(found, stored(wanted, "target"), buckets))
    weighed = arrow_map(found.where("not total").select("doc_id", "n_words", "n_features", "buckets", "counts"), _weigh(gain), "doc_id long, n_words long, n_features long, weight long")
    return weighed.withColumn("score", F.col("weight") + gumbel("doc_id", seed))


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, **how) -> DataFrame:
    """``importance`` with rank: 1, 2, 3... for the ``percent`` of all documents with ``least_words`` words that score highest, else null."""
    scored = stored(importance(docs, target, **how), "scored")
    ranked = numbered(scored.where(F.col("n_words") >= least_words), [F.desc("score"), F.asc_nulls_last("doc_id")], "rank")
    n = scored.where(F.col("n_words") >= least_words).count() * percent // 100
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= n, F.col("rank")))
    return ranked.unionByName(scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))
