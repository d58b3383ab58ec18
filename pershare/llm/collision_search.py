"""Nearest neighbours by inner product with collision-counting hashing.

Vectors get one more component that brings all of a block to its largest length, queries a zero; then the largest inner product
is the smallest distance. Each of ``projections`` random directions gives one sorted array of projected vectors. A
window around the query's own projection is widened by the factor ``growth`` again and again (virtual rehashing: no
hash table is built anew), and the windows that hold a vector are counted. A vector in at least ``threshold`` of the
windows is verified on the original vectors, in double precision. A query stops when ``share`` of the block has been
verified besides 6 k, or the windows hold everything.

Vectors lie in blocks of about ``block`` rows whose lengths differ by less than the factor ``CLASS``, queries in blocks of ``query_block``; each pair of blocks is a task of fixed
size, its best k go on, and the best k of all blocks win. All rows are indexed, nothing is sampled.

Rules. A vector that is null, all zero or holds a null or a component that is not finite takes no part; nor does one whose
length is not the most frequent one (the smallest of ties). Of rows with the same id the smallest vector counts.
Components may have any finite size: a score that a double cannot hold is infinite. Ties in score go to the smaller id. Fewer than k candidates give fewer rows; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pershare.functions.vectors import let

#: Queries counted at once.
TOGETHER = 256
#: Lengths of a block's vectors lie between two powers of this next to each other, so that a few long vectors flatten no differences.
CLASS = 1.05
#: Half the first window, in units of the projected length of the longest vector: about where the first candidates pass.
START = 1.25


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def search_block(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, longest: float, k: int, projections: int = 96, threshold: float = 0.7, growth: float = 1.08, share: float = 0.16) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query's place, vector's place, inner product) of all verified pairs. Windows end on 256ths of the sorted arrays."""
    scaled, sizes = vectors / longest, np.abs(queries).max(1)[:, None]
    unit = queries / sizes
    rest = np.sqrt(np.maximum(1 - (scaled**2).sum(1), 0))
    directions = np.random.default_rng(7).standard_normal((vectors.shape[1] + 1, projections))
    hashed = (np.c_[scaled, rest] @ directions).T
    asked = (unit / np.sqrt((unit**2).sum(1))[:, None]) @ directions[:-1]
    order = np.argsort(hashed, 1)
    ordered = np.take_along_axis(hashed, order, 1)
    n = len(vectors)
    bins = np.empty((projections, n), np.uint8)
    np.put_along_axis(bins, order, (np.arange(n) * 256 // n).astype(np.uint8)[None, :], 1)
    enough = min(n, 6 * k + int(np.ceil(share * n)))
    least = max(1, int(np.ceil(threshold * projections)))
    found = []
    for first in range(0, len(queries), TOGETHER):
        own = slice(first, first + TOGETHER)
        verified = np.zeros((len(asked[own]), n), bool)
        active, width = np.arange(len(verified)), START
        while len(active):
            counts = np.zeros((len(active), n), np.uint8)
            everything = np.ones(len(active), bool)
            for p in range(projections):
                at = asked[own][active, p]
                low, high = np.searchsorted(ordered[p], at - width, "left"), np.searchsorted(ordered[p], at + width, "right")
                begin = np.minimum(low, n - 1) * 256 // n
                size = np.maximum(np.maximum(high - 1, 0) * 256 // n - begin, 0)
                counts += (bins[p] - begin.astype(np.uint8)[:, None]) <= size.astype(np.uint8)[:, None]
                everything &= high - low == n
            q, v = np.nonzero((counts >= least) & ~verified[active])
            q = active[q]
            verified[q, v] = True
            border = np.flatnonzero(np.r_[True, q[1:] != q[:-1], True]) if len(q) else []
            for a, b in zip(border[:-1], border[1:]):
                i, j = q[a] + first, v[a:b]
                j = j[ids[j] != query_ids[i]]
                score = products(vectors[j], queries[i], lambda: scaled[j] @ unit[i] * sizes[i, 0] * longest)
                found.append((np.full(len(j), i), j, score))
            active = active[(verified[active].sum(1) < enough) & ~everything]
            width *= growth
    return tuple(map(np.concatenate, zip(*found))) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def products(vectors: np.ndarray, query: np.ndarray, scaled) -> np.ndarray:
    """Inner products in double precision; where a sum of too large terms is no number, the product of the scaled vectors."""
    with np.errstate(over="ignore", invalid="ignore"):
        score = vectors @ query
        return np.where(np.isnan(score), scaled(), score) if np.isnan(score).any() else score


def lengths(x: np.ndarray) -> np.ndarray:
    """Lengths of vectors of any finite size; infinite only where a double cannot hold the length."""
    most = np.abs(x).max(1)
    with np.errstate(over="ignore"):
        return most * np.sqrt(((x / most[:, None]) ** 2).sum(1))


def leading(q: np.ndarray, v: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query's pairs those that score no less than its k-th best."""
    order = np.argsort(q, kind="stable")
    q, v, score = q[order], v[order], score[order]
    border = np.flatnonzero(np.r_[True, q[1:] != q[:-1], True]) if len(q) else []
    keep = np.ones(len(q), bool)
    for a, b in zip(border[:-1], border[1:]):
        if b - a > k:
            keep[a:b] = score[a:b] >= np.partition(score[a:b], b - a - k)[b - a - k]
    return q[keep], v[keep], score[keep]


def _searcher(k: int):
    def search(key, queries: pa.Table, vectors: pa.Table) -> pa.Table:
        empty = {"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())}
        if not len(queries) or not len(vectors):
            return pa.table(empty)
        query_ids, ids = queries.column("id").to_numpy(), vectors.column("id").to_numpy()
        x = _matrix(vectors.column("vector"))
        q, v, score = search_block(_matrix(queries.column("vector")), query_ids, x, ids, float(min(lengths(x).max(), np.finfo(float).max)), k)
        q, v, score = leading(q, v, score, k)
        order = np.lexsort((ids[v], -score, q))
        q, v, score = q[order], v[order], score[order]
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else q
        place = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        best = place < k
        return pa.table({"query_id": query_ids[q[best]], "vec_id": ids[v[best]], "score": score[best]})

    return search


def nearest(embeddings: DataFrame, queries: DataFrame, k: int = 20, block: int = 4096, query_block: int = 1024) -> DataFrame:
    """The k nearest of ``embeddings`` for each of ``queries`` (both vec_id, embedding), without the query's own id."""

    def usable(df: DataFrame) -> DataFrame:
        good = df.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
        fine = "id is not null and size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) <= 1.7976931348623157e308) and exists(vector, x -> x <> 0)"
        return good.where(fine).groupBy("id").agg(F.min("vector").alias("vector"))

    vectors = usable(embeddings)
    facts = vectors.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    spark = embeddings.sparkSession
    if facts is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    vectors = vectors.where(F.size("vector") == facts["size"])
    asked = usable(queries).where(F.size("vector") == facts["size"])
    n_asked = max(1, -(-asked.count() // query_block))
    # by the largest component, so that no square is too large or too small
    most = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    squares = lambda m: F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x / m) * (x / m))
    length = let(most, lambda m: F.log(m) + F.log(squares(m)) / 2)
    # half a step aside, so that lengths of about 1 are one class
    vectors = vectors.withColumn("class", F.floor(length / float(np.log(CLASS)) + 0.5))
    classes, n_blocks = [], 0
    for row in vectors.groupBy("class").count().orderBy("class").collect():
        own = -(-row["count"] // block)
        classes.append((row["class"], n_blocks, own))
        n_blocks += own

    def dealt(df: DataFrame, own: str, place: Column, other: str, m: int) -> DataFrame:
        return df.select("id", "vector", place.cast("int").alias(own)).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))

    place = F.xxhash64("id")
    known = spark.createDataFrame(classes, "class long, first int, blocks int")
    left = dealt(asked, "q", F.pmod(place, F.lit(n_asked)), "b", n_blocks)
    right = dealt(vectors.join(known, "class"), "b", F.col("first") + F.pmod(place, F.col("blocks")), "q", n_asked)
    found = left.groupBy("q", "b").cogroup(right.groupBy("q", "b")).applyInArrow(_searcher(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
