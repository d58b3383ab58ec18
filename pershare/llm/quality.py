"""Quality of documents from weak labels: expectation-maximisation over heuristic labellers, then a hashed linear scorer.

Labellers vote good, bad or nothing. How often each is right is not known; expectation-maximisation estimates the share of good
documents and each labeller's accuracy on good and on bad ones from how often the votes occur together, over all documents.
The votes of n labellers have at most 3**n patterns, so that is a table of bounded size. The posterior of a document's
pattern is its label. A logistic regression on hashed byte n-grams, normalised to unit length, learns the labels of a sample
of about ``sample`` documents, chosen by a hash, and scores all whole texts.

Toxic texts are found by the share of abusive words; they are not kept whatever their quality.

Rules. Null and empty texts, and texts of white space, get score 0 and are not kept. If no labeller has ever voted
differently from the others, labels are the majority of votes; ties count as good. Rows are documents, rows that repeat count each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, WHITE_SPACE, arrow_map, bytes_of, chunks, free_name, lower, word_hashes, word_spans

DIM_BITS = 13
DIM = 1 << DIM_BITS
BATCH = 256
GRAMS = (2, 3)
#: Words of abuse.
ABUSIVE = ("stupid", "idiot", "moron", "loser", "scum", "clown", "trash", "pathetic", "worthless", "disgusting")
GOOD, BAD, NOTHING = 1, 0, 2
#: Labellers are built to vote bad on few good documents. Without this bound the two classes would be any two groups of
#: documents whose votes go together, such as one kind of bad document and all others.
FALSE_ALARMS = 0.001



def _marks(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


#: Byte classes of the labellers.
SYMBOLS = _marks(b"#$%&*|\\^~<>{}=_+@")
CAPITALS = _marks(bytes(range(65, 91)))
LETTERS = _marks(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
EXCLAIMING = _marks(b"!?|")
ENDS = _marks(b".!?\"')")
LABELLERS = ("symbols", "capitals", "exclaiming", "repeating", "word_length", "closed")


def _vote(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    return np.where(bad, BAD, np.where(good, GOOD, NOTHING))


def facts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All votes of each text as one number, its words, and those of abuse."""
    def number(inside: np.ndarray) -> np.ndarray:
        sums = np.r_[0, np.cumsum(inside)]
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)

    small = lower(data)
    start, end, before = word_spans(small, offsets)
    n_words = np.diff(before)
    word = word_hashes(small, start, end) if len(start) else np.zeros(0, np.uint64)
    again = np.r_[False, word[1:] == word[:-1]] if len(word) else np.zeros(0, bool)
    again[before[:-1][before[:-1] < len(again)]] = False
    sums = np.r_[0, np.cumsum(again)]
    repeats = (sums[before[1:]] - sums[before[:-1]]) / np.maximum(n_words, 1)
    size, words = np.maximum(np.diff(offsets), 1), np.maximum(n_words, 1)
    symbols, exclaiming = number(SYMBOLS[data]) / size, number(EXCLAIMING[data]) / words
    capitals = number(CAPITALS[data]) / np.maximum(number(LETTERS[data]), 1)
    length = number(~_marks(WHITE_SPACE)[data]) / words
    last = np.array([data[end[b - 1] - 1] if b > a else 0 for a, b in zip(before[:-1], before[1:])], np.int64)
    many = n_words >= 8
    votes = {
        "symbols": _vote(symbols > 0.03, symbols < 0.005),
        "capitals": _vote((capitals > 0.4) & many, (capitals < 0.2) & many),
        "exclaiming": _vote((exclaiming > 0.2) & many, (exclaiming < 0.05) & many),
        "repeating": _vote((repeats > 0.2) & many, (repeats < 0.05) & many),
        "word_length": _vote((length > 14) | (length < 2), (length > 3) & (length < 10)),
        "closed": _vote(np.zeros(len(size), bool), ENDS[last]),
    }
    code = np.zeros(len(size), np.int64)
    for name in LABELLERS:
        code = code * 3 + votes[name]
    bare = np.zeros(len(data) + 2, bool)
    bare[1:-1] = LETTERS[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    start, end = np.flatnonzero(bare[1:] & (~bare[:-1] | cut)), np.flatnonzero(bare[:-1] & (~bare[1:] | cut))
    plain, at = bytes_of(pa.array(ABUSIVE))
    wanted = word_hashes(plain, at[:-1], at[1:])
    abusive = np.isin(word_hashes(small, start, end), wanted) if len(start) else np.zeros(0, bool)
    abuse = np.diff(np.r_[0, np.cumsum(abusive)][np.searchsorted(start, offsets)])
    return code, n_words, abuse


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(3 ** len(LABELLERS), np.int64)
    for _, data, offsets in chunks(batches):
        code, words, _ = facts(data, offsets)
        counts += np.bincount(code[words > 0], minlength=len(counts))
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_pydict({"pattern": seen, "n": counts[seen]})


def posteriors(patterns: np.ndarray, counts: np.ndarray, n: int, steps: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """Probability of good for each of the 3**n patterns, accuracies on (bad, good) documents, and the share of good."""
    def votes(codes: np.ndarray) -> np.ndarray:
        return np.stack([codes // 3**k % 3 for k in reversed(range(n))], 1)

    seen, weight = votes(patterns), counts.astype(float)
    # rates[c, j, v]: how often labeller j votes v on documents of class c; at first a bad vote is rarely wrong
    rates = np.zeros((2, n, 3))
    rates[0], rates[1] = (0.45, 0.55, 1), (0.001, 0.999, 1)
    prior = 0.8

    def expected(v: np.ndarray) -> np.ndarray:
        logs = np.stack([np.log([1 - prior, prior][c]) + sum(np.log(rates[c, j, v[:, j]]) for j in range(n)) for c in (0, 1)])
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))

    for _ in range(steps if len(seen) else 0):
        good = expected(seen)
        prior = float(np.clip((good * weight).sum() / weight.sum(), 1e-3, 1 - 1e-3))
        for c, share in ((0, 1 - good), (1, good)):
            for v in (BAD, GOOD):
                rates[c, :, v] = ((seen == v) * (share * weight)[:, None]).sum(0) + 0.5
            rates[c, :, :2] /= rates[c, :, :2].sum(1, keepdims=True)  # no vote says nothing, its rate stays 1
        rates[1, :, BAD] = np.minimum(rates[1, :, BAD], FALSE_ALARMS)
        rates[1, :, GOOD] = 1 - rates[1, :, BAD]
    accuracy = np.stack([rates[0, :, BAD], rates[1, :, GOOD]])
    return expected(votes(np.arange(3**n))), accuracy, prior


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row for each text: which hashed n-grams occur, of unit length."""
    n = len(offsets) - 1
    out = np.zeros(n * DIM, np.float32)
    wide = data.astype(np.uint64)
    row = np.repeat(np.arange(n), np.diff(offsets))
    rest = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    for length in GRAMS:
        m = len(data) - length + 1
        if m <= 0:
            break
        code = np.full(m, length << 40, np.uint64)
        for k in range(length):
            code += wide[k : k + m] << np.uint64(8 * k)
        place = ((code * np.uint64(BASE)) >> np.uint64(64 - DIM_BITS)).astype(np.int64)
        inside = rest[:m] >= length
        out[(row[:m] * DIM + place)[inside]] = 1
    out = out.reshape(n, DIM)
    return out / np.sqrt(np.maximum(out.sum(1), 1))[:, None]


def _batches(batches: Iterator[pa.RecordBatch]):
    for rows, data, offsets in chunks(batches):
        for first in range(0, rows.num_rows, BATCH):
            o = offsets[first : first + BATCH + 1]
            yield rows.slice(first, BATCH), data[o[0] : o[-1]], o - o[0]


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in _batches(batches):
        bits = np.packbits(features(data, offsets) > 0, 1)
        code, words, _ = facts(data, offsets)
        yield pa.RecordBatch.from_pydict({"pattern": np.where(words > 0, code, -1), "place": rows.column("place"), "bits": pa.array([b.tobytes() for b in bits], pa.binary())})


def fit_linear(x: np.ndarray, y: np.ndarray, steps: int = 400, rate: float = 40.0, ridge: float = 1e-5) -> np.ndarray:
    """Weights and bias of a logistic regression on soft labels."""
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    weight = np.float32(1 / len(y))
    for _ in range(steps):
        gap = (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y) * weight
        w -= rate * (x.T @ gap + ridge * w)
        b -= rate * gap.sum() / 4
    return np.r_[w, b].astype(np.float32)


def quality(docs: DataFrame, sample: int = 4000) -> DataFrame:
    """``docs`` (text) with weak_label (posterior), score (0 to 1), toxic and keep."""
    spark = docs.sparkSession
    n = len(LABELLERS)
    counts = arrow_map(docs.select("text"), _patterns, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    known = np.array([r["pattern"] for r in counts], np.int64), np.array([r["n"] for r in counts], np.int64)
    label, _, _ = posteriors(*known, n)
    weights = np.zeros(DIM + 1, np.float32)
    if len(counts):
        place = F.xxhash64("text")
        limit = int(min(1.0, sample / known[1].sum()) * (1 << 30))
        chosen = docs.where(F.pmod(place, F.lit(1 << 30)) < limit).select("text", place.alias("place"))
        rows = arrow_map(chosen, _feature_rows, "pattern long, place long, bits binary").where("pattern >= 0").orderBy("place").limit(2 * sample).collect()
        if rows:
            x = np.unpackbits(np.frombuffer(b"".join(r["bits"] for r in rows), np.uint8).reshape(len(rows), -1), 1).astype(np.float32)
            x /= np.sqrt(np.maximum(x.sum(1), 1))[:, None]
            weights = fit_linear(x, label[[r["pattern"] for r in rows]].astype(np.float32))
    held = spark.sparkContext.broadcast((weights, label))
    names = weak, score, toxic, keep = tuple(free_name(docs, c) for c in ("weak_label", "score", "toxic", "keep"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, label = held.value
        for rows, data, offsets in _batches(batches):
            value = 1 / (1 + np.exp(-(features(data, offsets) @ weights[:-1] + weights[-1]).astype(np.float64)))
            code, words, abuse = facts(data, offsets)
            some = words > 0
            value, posterior = np.where(some, value, 0.0), np.where(some, label[code], 0.0)
            bad = (abuse >= 2) | ((abuse > 0) & (abuse * 40 >= words))
            columns = {c: rows.column(c) for c in rows.schema.names}
            yield pa.RecordBatch.from_pydict(columns | dict(zip(names, (posterior, value, bad, (value >= 0.5) & ~bad & some))))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return arrow_map(docs, step, f"{schema}, {weak} double, {score} double, {toxic} boolean, {keep} boolean")
