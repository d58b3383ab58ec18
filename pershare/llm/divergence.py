"""Which sources differ from which in their words: exact sums of differences of smoothed shares over a k2-tree.

Terms and documents are counted for each language and source in one pass and one shuffle. A language keeps the terms of at least
``least_docs`` of its documents. Its counts are a matrix of sources by kept terms, mostly zeros. Sources and terms are
numbered by size, which brings the zeros together, and the matrix is cut into pieces of at most ``ROWS`` sources by ``COLUMNS`` terms.

In a task a piece becomes a k2-tree: of a square its four quadrants are kept if they hold a count that is not zero, down to leaves
of ``LEAF`` by ``LEAF`` cells. Pairs of sources are compared by walking the trees of both sides at once: where both quadrants are
nothing but zeros the difference of any pair is that of the shares of a zero count, times the number of columns, and nothing is
read; where one holds counts the walk goes down; two leaves are compared cell by cell. The sums of the pieces are added up.

A count's share in parts per thousand million is ``1 + floor(10**9 * (count + 5) / (N + 5 * V))`` with N, the sum of kept counts of the
source (or language), and V, the number of the language's kept terms. All arithmetic is in integers.

Rules. Null text, language and source count as ''. Each row is a document, repeated ones too; other columns are left out. A source of a
language without kept terms is compared as well, all counts 0; without any kept term all values are 0. Ties go to the item that is
smaller in UTF-8. An empty table gives no rows. Pairs of sources of one language are the result; so there the work grows
with the square of the sources, in pieces of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, chunks, lower, partitions, stored
from .ordered import numbered

#: Sources and terms in a piece of the matrix, and the side of a leaf of its tree.
ROWS = 256
COLUMNS = 4096
LEAF = 32
#: What is added to a count, and the whole of all shares.
ADDED = 5
WHOLE = 1_000_000_000
#: Counts from which their product with the whole may not fit in a long.
LONG = 9_000_000_000
#: (language, source, term) that a task gathers before it adds up equal ones; if half as many are left, they are handed on.
HELD = 3_000_000
#: Bytes of terms; A-Z have been lower-cased.
_TERM = np.ones(256, bool)
_TERM[0x00:0x41] = _TERM[0x5B:0x61] = _TERM[0x7B:0x80] = False


def term_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every term of all texts, and the text it is in."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _TERM[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    return start, end, np.searchsorted(offsets, start, "right") - 1


def _spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes of the spans as texts."""
    length = end - start
    border = np.r_[0, np.cumsum(length)].astype(np.int64)
    at = np.arange(border[-1]) + np.repeat(start - border[:-1], length)
    return pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(border), pa.py_buffer(data[at])])


class Counts:
    """Occurrences and documents of terms of a task, by numbers of groups and terms."""

    def __init__(self):
        self.groups: dict[tuple, int] = {}
        self.terms: dict[str, int] = {}
        self.key, self.n, self.docs = [], [], []

    def add(self, part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> None:
        """The texts of a chunk; the first number of a term stands for the document itself."""
        start, end, text = term_spans(data, offsets)
        found = _spans(data, start, end).dictionary_encode()
        number = np.array([0, *(self.terms.setdefault(t, len(self.terms) + 1) for t in found.dictionary.to_pylist())], np.int64)
        group = np.array([self.groups.setdefault(g, len(self.groups)) for g in zip(part.column("lang").to_pylist(), part.column("source").to_pylist())], np.int64)
        own = np.r_[text * len(number) + found.indices.to_numpy() + 1, np.arange(len(group)) * len(number)]
        own, n = np.unique(own, return_counts=True)
        self.key.append(group[own // len(number)] << 40 | number[own % len(number)])
        self.n.append(n)
        self.docs.append(np.ones(len(n), np.int64))
        if sum(map(len, self.key)) > HELD:
            self.combine()

    def combine(self) -> int:
        key = np.concatenate(self.key)
        order = np.argsort(key)
        key, first = np.unique(key[order], return_index=True)
        self.key = [key]
        self.n, self.docs = ([np.add.reduceat(np.concatenate(x)[order], first)] for x in (self.n, self.docs))
        return len(key)

    def rows(self) -> Iterator[pa.RecordBatch]:
        """All that has been counted; a row without a term for each group."""
        terms = pa.array([None, *self.terms], pa.string())
        lang, source = (pa.array(side, pa.string()) for side in zip(*self.groups))
        for i in range(0, len(self.key[0]), 100_000):
            key, n, docs = (x[0][i : i + 100_000] for x in (self.key, self.n, self.docs))
            group = pa.array(key >> 40)
            made = {"lang": lang.take(group), "source": source.take(group), "term": terms.take(pa.array(key & (1 << 40) - 1)), "n": n, "docs": docs}
            yield pa.RecordBatch.from_pydict(made)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = Counts()
    for part, data, offsets in chunks(batches):
        counts.add(part, lower(data), offsets)
        if len(counts.key) == 1 and len(counts.key[0]) > HELD // 2:
            yield from counts.rows()
            counts = Counts()
    if counts.key:
        counts.combine()
        yield from counts.rows()


def share(count: Column, n: Column, v: Column) -> Column:
    """Smoothed share of a count; decimals where the product is too large for a long."""
    total = n + ADDED * v
    plain = F.call_function("div", F.lit(WHOLE).cast("long") * (count + ADDED), total)
    wide = F.call_function("div", F.lit(WHOLE).cast("decimal(10,0)") * (count + ADDED).cast("decimal(20,0)"), total.cast("decimal(20,0)"))
    return F.when(total > 0, F.when(count < LONG, plain).otherwise(wide) + 1)


class CountTree:
    """Shares of some sources (rows) for the terms of a piece (columns) as a k2-tree over the counts that are not zero."""

    def __init__(self, row: np.ndarray, column: np.ndarray, value: np.ndarray, zero: np.ndarray, columns: int):
        self.zero, self.columns = zero, columns
        self.top = max(0, int(np.ceil(np.log2(max(len(zero), columns, 1) / LEAF))))
        # a quadrant of level h is LEAF * 2**h wide; those with counts are held as sorted codes, those of level 0 with their cells
        self.levels = [np.unique(self._code(row // LEAF >> h, column // LEAF >> h)) for h in range(self.top + 1)]
        leaf = self._code(row // LEAF, column // LEAF)
        order = np.argsort(leaf, kind="stable")
        self.row, self.column, self.value = row[order] % LEAF, column[order] % LEAF, value[order]
        self.border = np.searchsorted(leaf[order], np.r_[self.levels[0], np.iinfo(np.int64).max])
        self.cells: dict[tuple[int, int], np.ndarray] = {}

    @staticmethod
    def _code(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return i.astype(np.int64) << 32 | j

    def holds(self, h: int, i: int, j: int) -> bool:
        """Whether a quadrant has a count that is not zero."""
        code, level = i << 32 | j, self.levels[h]
        at = np.searchsorted(level, code)
        return at < len(level) and level[at] == code

    def leaf(self, i: int, j: int) -> np.ndarray:
        """The shares of a leaf, those of zero counts filled in."""
        if (i, j) not in self.cells:
            zero = self.zero[i * LEAF : (i + 1) * LEAF]
            out = np.repeat(zero[:, None], min(LEAF, self.columns - j * LEAF), 1)
            at = np.searchsorted(self.levels[0], i << 32 | j)
            if at < len(self.levels[0]) and self.levels[0][at] == i << 32 | j:
                own = slice(self.border[at], self.border[at + 1])
                out[self.row[own], self.column[own]] = self.value[own]
            self.cells[i, j] = out
        return self.cells[i, j]


def differences(a: CountTree, b: CountTree) -> np.ndarray:
    """The sums of differences over all columns between each row of one tree and each of the other, by walking both."""
    total = np.zeros((len(a.zero), len(b.zero)), np.int64)
    empty = np.zeros((-(-len(a.zero) // LEAF), -(-len(b.zero) // LEAF)), np.int64)
    top = max(a.top, b.top)

    def holds(tree: CountTree, h: int, i: int, j: int) -> bool:
        if h <= tree.top:
            return tree.holds(h, i, j)
        return i == 0 and j == 0 and len(tree.value) > 0

    stack = [(top, 0, 0, 0)]
    while stack:
        h, i, k, j = stack.pop()  # rows i of a, rows k of b, columns j, in quadrants of level h
        width = min(LEAF << h, a.columns - j * (LEAF << h))
        if i * (LEAF << h) >= len(a.zero) or k * (LEAF << h) >= len(b.zero) or width <= 0 or (a is b and k < i):
            continue
        if not holds(a, h, i, j) and not holds(b, h, k, j):
            empty[i << h : i + 1 << h, k << h : k + 1 << h] += width  # all zeros: priced below
        elif h:
            stack += [(h - 1, 2 * i + x, 2 * k + y, 2 * j + z) for x in (0, 1) for y in (0, 1) for z in (0, 1)]
        else:
            x, y = a.leaf(i, j), b.leaf(k, j)
            total[i * LEAF : i * LEAF + len(x), k * LEAF : k * LEAF + len(y)] += np.abs(x[:, None, :] - y[None, :, :]).sum(2)
    of = np.repeat(np.repeat(empty, LEAF, 0), LEAF, 1)[: len(a.zero), : len(b.zero)]
    return total + of * np.abs(a.zero[:, None] - b.zero[None, :])


def _compare(key, table):
    """The differences of all pairs of sources of two blocks, in one piece of the terms."""
    _, _, i, j = (k.as_py() for k in key)
    held = {c: table.column(c).to_numpy() for c in ("block_of", "row", "column", "value", "id")}
    columns = int(table.column("columns")[0].as_py())

    def side(block: int) -> tuple[np.ndarray, CountTree]:
        own = {c: x[held["block_of"] == block] for c, x in held.items()}
        head, cell = own["column"] < 0, own["column"] >= 0
        order = np.argsort(own["row"][head])
        tree = CountTree(own["row"][cell], own["column"][cell], own["value"][cell], own["value"][head][order], columns)
        return own["id"][head][order], tree

    names, left = side(i)
    others, right = (names, left) if i == j else side(j)
    found = differences(left, right)
    x, y = np.indices(found.shape)
    keep = np.ones(found.shape, bool) if i != j else x < y
    return pa.table({"a": names[x[keep]], "b": others[y[keep]], "value": found[keep]})


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50, rows: int = ROWS, columns: int = COLUMNS) -> DataFrame:
    """(lang, source, part, item, value, rank) of ``docs`` (text, lang, source): ``pair`` with other sources, ``term`` with the words used most above the language's share."""
    named = docs.select("text", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")))
    counted = arrow_map(named, _count, "lang string, source string, term string, n long, docs long")
    # by language and term: tasks have added up what they can, so rows go straight to where they are summed
    counted = counted.repartition(partitions(docs.sparkSession), "lang", "term")
    counted = stored(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    terms = counted.where("term is not null")

    kept = terms.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= least_docs)
    kept = numbered(kept, [F.asc("lang"), F.desc("docs"), F.asc("term")], "id")
    kept = stored(kept.select("lang", "term", "lang_n", (F.col("id") - 1).alias("id")), "kept")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("n_lang"), F.min("id").alias("first"))
    cells = stored(terms.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "cells")

    groups = counted.where("term is null").select("lang", "source").join(cells.groupBy("lang", "source").agg(F.sum("n").alias("n_group")), ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_group", "v", "n_lang", "first")))
    groups = numbered(groups, [F.asc("lang"), F.desc("n_group"), F.asc("source")], "id")
    low = groups.groupBy("lang").agg(F.min("id").alias("low"))
    groups = groups.join(low, "lang").withColumn("place", F.col("id") - F.col("low")).withColumn("zero", share(F.lit(0).cast("long"), F.col("n_group"), F.col("v")))
    groups = stored(groups.select("lang", "source", "n_group", "v", "n_lang", "first", "id", "zero", F.floor(F.col("place") / rows).alias("block"), (F.col("place") % rows).cast("long").alias("row")), "groups")

    shares = cells.join(groups.select("lang", "source", "n_group", "v", "n_lang", "first", "block", "row"), ["lang", "source"])
    shares = shares.select("*", share(F.col("n"), F.col("n_group"), F.col("v")).alias("p"), (F.col("id") - F.col("first")).alias("at"))
    return _pairs(groups, shares, columns).unionByName(_terms(shares, top))


def _ranked(found: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return found.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _terms(shares: DataFrame, top: int) -> DataFrame:
    over = shares.select("lang", "source", F.col("term").alias("item"), (F.col("p") - share(F.col("lang_n"), F.col("n_lang"), F.col("v"))).alias("value"))
    return _ranked(over.where("value > 0"), "term").where(F.col("rank") <= top)


def _pairs(groups: DataFrame, shares: DataFrame, columns: int) -> DataFrame:
    """Every two sources of a language, with a row for each of both."""
    last = groups.groupBy("lang").agg(F.max("block").alias("last"))
    piece = F.floor(F.col("at") / columns)
    width = F.least(F.lit(columns).cast("long"), F.col("v") - piece * columns)
    cells = shares.select("lang", piece.alias("piece"), width.alias("columns"), F.col("block").alias("block_of"), "row", (F.col("at") % columns).alias("column"), F.col("p").alias("value"), F.lit(0).cast("long").alias("id"))
    # every source is in every piece, with its id and the share of a zero count, whether it has counts there or not
    pieces = groups.groupBy("lang").agg(F.max("v").alias("v")).where("v > 0")
    pieces = pieces.withColumn("at", F.explode(F.expr(f"sequence(0L, v - 1, {columns}L)"))).select("lang", piece.alias("piece"), width.alias("columns"))
    heads = groups.join(pieces, "lang").select("lang", "piece", "columns", F.col("block").alias("block_of"), "row", F.lit(-1).cast("long").alias("column"), F.col("zero").alias("value"), "id")
    # a block of sources meets every block of its language, itself included
    dealt = heads.unionByName(cells).join(last, "lang").withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
    dealt = dealt.withColumns({"i": F.least("block_of", "with"), "j": F.greatest("block_of", "with")}).drop("with", "last")
    found = dealt.groupBy("lang", "piece", "i", "j").applyInArrow(_compare, "a long, b long, value long")
    sums = found.groupBy("a", "b").agg(F.sum("value").alias("value"))
    both = sums.unionByName(sums.select(F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    one, two = groups.select("lang", "source", F.col("id").alias("a")), groups.select("lang", F.col("source").alias("item"), F.col("id").alias("b"))
    pairs = one.join(two, "lang").where("a <> b").join(both, ["a", "b"], "left")
    return _ranked(pairs.select("lang", "source", "item", F.coalesce("value", F.lit(0).cast("long")).alias("value")), "pair")
