"""Prediction by partial matching over bytes, trained on the corpus, with a word-count base score beside it.

The model is a trie of byte contexts up to ``order`` bytes, held as one table for each length: a context with the bytes seen
after it. A byte is predicted from the longest known context; a byte that context never saw is reached by an escape (method C:
as many chances for the escape as different bytes were seen) to the next shorter one, where the bytes of the longer
context are excluded. Below the empty context all bytes not seen there are equally likely. Texts begin after a
row of marks and end with one, so the probabilities of all texts sum to 1.

All n-grams of all training documents are kept, so the model grows with the corpus. It lies in the shared folder; neither the
driver nor a task holds it. Documents are dealt into groups of about ``PART_BYTES``. Each group asks for the n-grams in its
texts, each once, and gets their probabilities by joins with the tables. Only the most frequent n-grams are also broadcast, in a table of
bounded size, so that most places need no join.

Rules. Null text is empty. Rows are documents; rows that repeat count each. ``train`` is a boolean column; null there
counts as false. Without training documents every byte has probability 1/256. Words are told apart by 64-bit
hashes. A word's count is looked up in its document group, so no vocabulary is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, chunks, lower, partitions, signed, stored, word_hashes, word_spans

MARK = 0xFF
#: Distinct n-grams or words that a counting task gathers before it hands them on.
FLUSH = 250_000
#: Bytes of text in a document group, about.
PART_BYTES = 32 << 20
#: Marks a free place; no n-gram of up to seven bytes.
NO_GRAM = np.iinfo(np.uint64).max


def _codes(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The (order + 1)-gram that ends at each byte and at the end mark of each text; how many come before each text."""
    sizes = np.diff(offsets)
    n = len(sizes)
    padded = np.full(len(data) + n * (order + 1), MARK, np.uint8)
    place = np.arange(len(data)) + np.repeat(np.arange(n) * (order + 1) + order, sizes)
    padded[place] = data
    told = np.zeros(len(padded), bool)
    told[place] = True
    told[offsets[1:] + (np.arange(n) + 1) * (order + 1) - 1] = True
    code = np.zeros(len(padded), np.uint64)
    for back in range(order, -1, -1):
        code[back:] |= padded[: len(padded) - back].astype(np.uint64) << np.uint64(8 * back)
    return code[told], np.r_[0, np.cumsum(sizes + 1)]


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


class _Counter:
    """Counts of 64-bit keys; small sorted pieces are merged now and then."""

    def __init__(self) -> None:
        self.keys, self.counts, self.size, self.merged = [], [], 0, 0

    def add(self, keys: np.ndarray, weights: np.ndarray | None = None) -> None:
        if weights is None:
            keys = np.sort(keys)
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
            self.keys.append(keys[first])
            self.counts.append(np.diff(np.r_[first, len(keys)]))
        else:
            keys, weights = _summed([keys], [weights])
            self.keys.append(keys)
            self.counts.append(weights)
        self.size += len(self.keys[-1])
        if self.size > 2 * self.merged + FLUSH // 2:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, counts = _summed(self.keys, self.counts)
        self.keys, self.counts, self.size, self.merged = [keys], [counts], len(keys), len(keys)
        return keys, counts


def _gram_counter(order: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter()
        for _, data, offsets in chunks(batches):
            counter.add(_codes(data, offsets, order)[0])
            if counter.merged > 2 * FLUSH:
                yield from _rows(counter)
                counter = _Counter()
        yield from _rows(counter)

    def _rows(counter: _Counter) -> Iterator[pa.RecordBatch]:
        keys, counts = counter.merge()
        if len(keys):
            yield pa.RecordBatch.from_pydict({"gram": signed(keys), "n": counts})

    return count


class Known:
    """log10 probabilities of the most frequent n-grams, in a table with open addresses."""

    def __init__(self, code: np.ndarray, value: np.ndarray) -> None:
        self.bits = max(4, int(np.ceil(np.log2(2 * max(1, len(code))))))
        size = 1 << self.bits
        self.keys, self.values = np.full(size, NO_GRAM, np.uint64), np.zeros(size)
        place, left = self._place(code), np.arange(len(code))
        while len(left):
            free = self.keys[place[left]] == NO_GRAM
            self.keys[place[left[free]]] = code[left[free]]
            done = self.keys[place[left]] == code[left]
            self.values[place[left[done]]] = value[left[done]]
            left = left[~done]
            place[left] = (place[left] + 1) & (size - 1)

    def _place(self, code: np.ndarray) -> np.ndarray:
        return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the n-grams that are here, 0 for others, and where the others are."""
        place = self._place(code)
        hit = self.keys[place] == code
        out = np.where(hit, self.values[place], 0.0)
        left = np.flatnonzero(~hit)
        missing = [left[:0]]
        while len(left):
            key = self.keys[place[left]]
            end, hit = key == NO_GRAM, key == code[left]
            missing.append(left[end])
            out[left[hit]] = self.values[place[left[hit]]]
            left = left[~end & ~hit]
            place[left] = (place[left] + 1) & (len(self.keys) - 1)
        return out, np.concatenate(missing)


def _by_context(grams: DataFrame) -> DataFrame:
    """One row for each context with the bytes seen after it, 256 at most, and how often."""
    counts = grams.groupBy("context", "byte").agg(F.sum("n").alias("n"))
    return counts.groupBy("context").agg(F.collect_list(F.struct("byte", "n")).alias("next"))


def train_model(docs: DataFrame, order: int = 5) -> list[DataFrame]:
    """The contexts of all texts of ``docs`` with what follows them, a table for each length: 0 to ``order`` bytes."""
    if not 0 <= order <= 6:
        raise ValueError("contexts have 0 to 6 bytes")
    grams = arrow_map(docs.select("text"), _gram_counter(order), "gram long, n long")
    grams = grams.select(F.shiftrightunsigned("gram", 8).alias("context"), F.col("gram").bitwiseAND(F.lit(255)).cast("int").alias("byte"), "n")
    model = [stored(_by_context(grams.repartition("context")), f"contexts-{order}")]
    for length in range(order - 1, -1, -1):
        shorter = F.col("context").bitwiseAND(F.lit((1 << 8 * length) - 1)).alias("context")
        model.append(stored(_by_context(model[-1].select(shorter, F.explode("next").alias("it")).select("context", "it.byte", "it.n")), f"contexts-{length}"))
    return model[::-1]


def frequent(model: list[DataFrame], most: int) -> Known:
    """Up to ``most`` of the longest n-grams, by classes of frequency, with their probabilities.

    It only saves looking them up in the tables: scores are the same with ``most`` 0.
    """
    held = F.aggregate("next", F.lit(0).cast("long"), lambda a, x: a + x["n"]) + F.size("next")
    grams = model[-1].select("context", held.alias("whole"), F.explode("next").alias("it"))
    grams = grams.select(F.shiftleft("context", 8).bitwiseOR(F.col("it.byte").cast("long")).alias("gram"), F.floor(8 * F.log2("it.n")).alias("class"), F.log10(F.col("it.n") / F.col("whole")).alias("log10"))
    total, least = 0, None
    for row in sorted(grams.groupBy("class").count().collect(), key=lambda r: -r["class"]):
        total += row["count"]
        if total > most:
            break
        least = row["class"]
    if least is None:
        return Known(np.zeros(0, np.uint64), np.zeros(0))
    kept = grams.where(F.col("class") >= least).select("gram", "log10").toArrow()
    return Known(kept.column("gram").to_numpy().view(np.uint64), kept.column("log10").to_numpy())


def gram_scores(asked: DataFrame, model: list[DataFrame]) -> DataFrame:
    """log10 of the probability of the last byte of each n-gram (column ``gram``, each once) after the bytes before it.

    Columns: gram, log10. Contexts are joined from the longest to the empty one. A row carries the bytes of the context
    it escaped from, which the next one leaves out.
    """
    none = F.array().cast("array<int>")
    byte = F.col("gram").bitwiseAND(F.lit(255)).cast("int")
    rows = asked.select("gram", F.lit(0.0).alias("log10"), F.lit(False).alias("found"), none.alias("left_out"))
    for length in range(len(model) - 1, -1, -1):
        context = F.shiftrightunsigned("gram", 8).bitwiseAND(F.lit((1 << 8 * length) - 1))
        # at most 256 contexts have less than two bytes, and they would be hot keys
        table = F.broadcast(model[length]) if length < 2 else model[length]
        rows = rows.withColumn("context", context).join(table, "context", "left")
        open_ = ~F.col("found") & F.col("next").isNotNull()
        rows = rows.withColumn("fresh", F.when(open_, F.filter("next", lambda x: ~F.array_contains("left_out", x["byte"]))))
        rows = rows.select(
            "gram", "log10", "found", "left_out", "next", F.size("fresh").alias("kinds"),
            F.aggregate("fresh", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("total"),
            F.aggregate(F.filter("fresh", lambda x: x["byte"] == byte), F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("n"),
        )
        whole = F.col("total") + F.col("kinds")
        # a context with no byte that the longer one has not seen says nothing
        gain = F.when(F.col("n") > 0, F.log10(F.col("n") / whole)).when(F.col("kinds") > 0, F.log10(F.col("kinds") / whole)).otherwise(F.lit(0.0))
        still_open = ~F.col("found") & F.col("next").isNotNull()
        rows = rows.select(
            "gram", (F.col("log10") + gain).alias("log10"), (F.col("found") | F.coalesce(F.col("n") > 0, F.lit(False))).alias("found"),
            F.when(still_open, F.col("next.byte")).otherwise(F.col("left_out")).alias("left_out"),
        )
    bottom = F.when(F.col("found"), F.lit(0.0)).otherwise(F.log10(F.lit(256) - F.size("left_out")))
    return rows.select("gram", (F.col("log10") - bottom).alias("log10"))


def _asker(held, order: int):
    """For each document group: its words with their training counts, and the n-grams that are not among the frequent ones."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known.__new__(Known)
        vars(known).update(held.value)
        counters: dict[tuple[int, bool], _Counter] = {}
        for rows, data, offsets in chunks(batches):
            start, end, before = word_spans(data, offsets)
            word = word_hashes(lower(data), start, end)
            part, train = rows.column("part").to_numpy(), rows.column("train").to_numpy(zero_copy_only=False)
            code, own = _codes(data, offsets, order)
            counts = np.repeat(train, np.diff(before)).astype(np.int64)
            word_part, gram_part = np.repeat(part, np.diff(before)), np.repeat(part, np.diff(own))
            for g in np.unique(part):
                at = word_part == g
                counters.setdefault((int(g), False), _Counter()).add(word[at], counts[at])
                grams = np.sort(code[gram_part == g])
                grams = grams[np.r_[True, grams[1:] != grams[:-1]]]
                counters.setdefault((int(g), True), _Counter()).add(grams[known.look(grams)[1]])
            if sum(c.merged for c in counters.values()) > 8 * FLUSH:
                for key in list(counters):
                    yield _group_rows(*key, counters.pop(key))
        for key, counter in counters.items():
            yield _group_rows(*key, counter)

    return ask


def _group_rows(g: int, gram: bool, counter: _Counter) -> pa.RecordBatch:
    keys, counts = counter.merge()
    return pa.RecordBatch.from_pydict({"part": np.full(len(keys), g, np.int32), "is_gram": np.full(len(keys), gram), "key": signed(keys), "n": np.zeros_like(counts) if gram else counts})


def _sorted(table: pa.Table, gram: bool) -> tuple[np.ndarray, np.ndarray]:
    """Keys of one kind with their values; a group handed on in pieces may hold a key twice, with equal values."""
    at = table.column("is_gram").to_numpy() == gram
    keys, values = table.column("key").to_numpy().view(np.uint64)[at], table.column("value").to_numpy()[at]
    order = np.argsort(keys)
    return keys[order], values[order]


def _scorer(held, order: int, n_train: int, n_docs: int, n_kinds: int):
    def score(key, docs: pa.Table, facts: pa.Table) -> pa.Table:
        known = Known.__new__(Known)
        vars(known).update(held.value)
        (word, count), (gram, value) = _sorted(facts, False), _sorted(facts, True)
        below = np.log10(n_train + 0.5 * (n_kinds + 1))
        end_score = np.log10(n_docs + 0.5) - below
        tokens, hits_, base, model = [], [], [], []
        for _, data, offsets in chunks(docs.to_batches()):
            start, end, before = word_spans(data, offsets)
            c = np.zeros(len(start))
            if len(word) and len(start):
                h = word_hashes(lower(data), start, end)
                i = np.minimum(np.searchsorted(word, h), len(word) - 1)
                c = np.where(word[i] == h, count[i], 0)
            sums = np.r_[0, np.cumsum(np.log10(c + 0.5) - below)]
            hits = np.r_[0, np.cumsum(c > 0)]
            tokens.append(np.diff(before) + 1)
            hits_.append(hits[before[1:]] - hits[before[:-1]] + (n_docs > 0))
            base.append(sums[before[1:]] - sums[before[:-1]] + end_score)
            code, own = _codes(data, offsets, order)
            logs, rest = known.look(code)
            logs[rest] = value[np.searchsorted(gram, code[rest])]
            model.append(np.add.reduceat(logs, own[:-1]))
        columns = {c: docs.column(c) for c in ("doc_id", "train")}
        made = {"n_tokens": (tokens, pa.int64()), "n_known": (hits_, pa.int64()), "base_score": (base, pa.float64()), "score": (model, pa.float64())}
        return pa.table(columns | {c: pa.array(np.concatenate(v) if v else [], kind) for c, (v, kind) in made.items()})

    return score


def score_documents(docs: DataFrame, order: int = 5, cached: int = 500_000) -> DataFrame:
    """One row for each of ``docs`` (doc_id, text, boolean train): doc_id, train, n_tokens, n_known, train_tokens, base_score and score.

    ``cached`` bounds the n-grams whose probabilities are broadcast; all others are joined. It changes no score.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", F.coalesce("train", F.lit(False)).alias("train"))
    size = docs.agg(F.count(F.when(F.col("train"), 1)).alias("train"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    groups, n_docs = max(partitions(spark), -(-size["bytes"] // PART_BYTES)), size["train"]
    model = train_model(docs.where("train"), order)
    known = spark.sparkContext.broadcast(vars(frequent(model, cached)))
    dealt = docs.withColumn("part", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int")).repartition(groups, "part")
    asked = arrow_map(dealt.select("part", "text", "train"), _asker(known, order), "part int, is_gram boolean, key long, n long")
    facts = stored(asked.selectExpr("part", "is_gram", "key", "n as own", "sum(n) over (partition by key, is_gram) as n").where("is_gram or n > 0"), "asked")
    words, grams = facts.where("not is_gram"), facts.where("is_gram").select("part", F.col("key").alias("gram"))
    seen = words.agg(F.coalesce(F.sum("own"), F.lit(0)).alias("tokens")).first()
    kinds = words.select("key").distinct().count() if seen["tokens"] else 0
    n_train = seen["tokens"] + n_docs
    values = grams.join(gram_scores(grams.select("gram").distinct(), model), "gram").select("part", F.lit(True).alias("is_gram"), F.col("gram").alias("key"), F.col("log10").alias("value"))
    looked_up = words.select("part", "is_gram", "key", F.col("n").cast("double").alias("value")).unionByName(values)
    scored = dealt.groupBy("part").cogroup(looked_up.groupBy("part")).applyInArrow(
        _scorer(known, order, n_train, n_docs, kinds + (n_docs > 0)),
        f"doc_id {dict(docs.dtypes)['doc_id']}, train boolean, n_tokens long, n_known long, base_score double, score double",
    )
    return scored.withColumn("train_tokens", F.lit(n_train).cast("long"))
