"""Language of a text by a string kernel: which byte n-grams occur, Nystroem landmarks, kernel ridge regression.

The kernel of two texts is the number of n-grams (1 to 4 bytes, hashed to ``DIM`` places) that occur in both,
over the root of the product of their own numbers. A sample of labelled texts gives landmarks; the kernel values
with them, made independent by the inverse root of the landmarks' own kernel, are the features of one ridge
regression for each language against the rest. Texts are scored in batches of matrix products.

The sample has about ``per_lang`` different texts of each language, and at most twice as many, chosen by a hash of the text; copies count
once, so no copied text fills it, and every language that has a text with letters is learned. The driver holds ``DIM`` bits
for each text of the sample, and their numbers for ``BATCH`` of them at once. All else sees every row and whole texts. Rules: A-Z is lower-cased, ASCII that is no letter counts as a space. A text that is null or without letters
is ``und`` with score 0, and so is every text if there is nothing to learn from. Ties go to the first language in
alphabetical order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BASE, arrow_map, chunks, free_name

DIM_BITS = 13
DIM = 1 << DIM_BITS
LONGEST = 4
#: Texts scored at once.
BATCH = 256

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of 0 and 1 for each text."""
    n = len(offsets) - 1
    out = np.zeros(n * DIM, np.float32)
    folded = _FOLD[data].astype(np.uint64)
    row = np.repeat(np.arange(n), np.diff(offsets))
    rest = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))  # bytes from here to the end of the text
    code = np.zeros(len(data), np.uint64)
    for length in range(1, LONGEST + 1):
        m = len(data) - length + 1
        if m <= 0:
            break
        code = (code[:m] << np.uint64(8)) | folded[length - 1 :]
        place = (((code + np.uint64(length << 40)) * np.uint64(BASE)) >> np.uint64(64 - DIM_BITS)).astype(np.int64)
        inside = rest[:m] >= length
        out[(row[:m] * DIM + place)[inside]] = 1
    return out.reshape(n, DIM)


def letters(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter."""
    ascii_letter = (_FOLD[data] != 32) & (data < 128)
    sums = np.r_[0, np.cumsum(ascii_letter)]
    out = sums[offsets[1:]] > sums[offsets[:-1]]
    for i in np.flatnonzero(~out):
        out[i] = any(map(str.isalpha, bytes(data[offsets[i] : offsets[i + 1]]).decode(errors="replace")))
    return out


def _batches(batches: Iterator[pa.RecordBatch]):
    for rows, data, offsets in chunks(batches):
        for first in range(0, rows.num_rows, BATCH):
            o = offsets[first : first + BATCH + 1]
            yield rows.slice(first, BATCH), data[o[0] : o[-1]], o - o[0]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in _batches(batches):
        bits = np.packbits(presence(data, offsets).astype(bool), 1)
        good = letters(data, offsets)
        yield pa.RecordBatch.from_pydict({"lang": rows.column("lang"), "place": rows.column("place"), "bits": pa.array([b.tobytes() for b in bits], pa.binary())}).filter(pa.array(good))


def unpacked(bits: np.ndarray) -> np.ndarray:
    return np.unpackbits(bits, 1).astype(np.float32)


class LanguageModel:
    def __init__(self, langs: list[str], landmarks: np.ndarray, weights: np.ndarray) -> None:
        self.langs, self.landmarks, self.weights = langs, landmarks, weights
        self.norms = np.sqrt(np.maximum(landmarks.sum(1), 1))

    def kernel(self, x: np.ndarray) -> np.ndarray:
        """Kernel values of texts with the landmarks."""
        return (x @ self.landmarks.T) / np.sqrt(np.maximum(x.sum(1), 1))[:, None] / self.norms

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Regression values, about 1 for the language and -1 for the others."""
        return self.kernel(x) @ self.weights


def fit(docs: DataFrame, per_lang: int = 1000, landmarks: int = 160, ridge: float = 1.0) -> LanguageModel:
    """Learns from the rows of ``docs`` (text, lang) with both; see the module for the sample."""
    labelled = docs.where("text is not null and lang is not null").select("text", "lang", F.xxhash64("text", "lang").alias("place"))
    different = labelled.select("lang", "place").distinct().groupBy("lang").count()
    counts = {r["lang"]: r["count"] for r in different.collect()}
    if not counts:
        return LanguageModel([], np.zeros((0, DIM), np.float32), np.zeros((0, 0), np.float32))
    share = F.create_map(*[x for lang, n in sorted(counts.items()) for x in (F.lit(lang), F.lit(min(1.0, per_lang / n)))])
    chosen = labelled.where(F.pmod("place", F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))
    featured = arrow_map(chosen, _features, "lang string, place long, bits binary").dropDuplicates(["lang", "place"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    sample = featured.withColumn("number", number).where(F.col("number") <= 2 * per_lang).collect()
    sample.sort(key=lambda r: (r["place"], r["lang"]))
    langs = sorted({r["lang"] for r in sample})
    if not langs:
        return LanguageModel([], np.zeros((0, DIM), np.float32), np.zeros((0, 0), np.float32))
    bits = np.frombuffer(b"".join(r["bits"] for r in sample), np.uint8).reshape(len(sample), -1)
    y = np.array([langs.index(r["lang"]) for r in sample])
    each = max(1, landmarks // len(langs))
    marks = unpacked(bits[np.concatenate([np.flatnonzero(y == k)[:each] for k in range(len(langs))])])
    model = LanguageModel(langs, marks, np.eye(len(marks), dtype=np.float32))
    value, vector = np.linalg.eigh(model.scores(marks).astype(np.float64))
    keep = value > 1e-6 * value.max()
    root = vector[:, keep] / np.sqrt(value[keep])
    features = np.concatenate([model.kernel(unpacked(bits[a : a + BATCH])) for a in range(0, len(bits), BATCH)]) @ root
    # rows weigh so that each language counts the same
    weight = (1 / np.bincount(y, minlength=len(langs)))[y][:, None]
    target = np.where(np.arange(len(langs)) == y[:, None], 1.0, -1.0)
    gram = (features * weight).T @ features
    solved = np.linalg.solve(gram + ridge * 1e-3 * np.eye(len(gram)), (features * weight).T @ target)
    return LanguageModel(langs, marks, (root @ solved).astype(np.float32))


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1)."""
    held = docs.sparkSession.sparkContext.broadcast((model.langs, model.landmarks, model.weights))
    pred, score = free_name(docs, "lang_pred"), free_name(docs, "score")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LanguageModel(*held.value)
        for rows, data, offsets in _batches(batches):
            langs, best = ["und"] * rows.num_rows, np.zeros(rows.num_rows)
            if model.langs:
                values = model.scores(presence(data, offsets))
                top, good = values.argmax(1), letters(data, offsets)
                best = np.where(good, np.clip((values.max(1).astype(np.float64) + 1) / 2, 0, 1), 0)
                langs = [model.langs[k] if ok else "und" for k, ok in zip(top, good)]
            columns = {c: rows.column(c) for c in rows.schema.names}
            yield pa.RecordBatch.from_pydict(columns | {pred: pa.array(langs, pa.string()), score: pa.array(best, pa.float64())})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return arrow_map(docs, step, f"{schema}, {pred} string, {score} double")
