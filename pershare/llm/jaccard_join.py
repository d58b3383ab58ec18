"""Size-aware heavy-light join of documents by the Jaccard similarity of their word-shingle sets.

Equal sets are one class from the start. The shingles of a set are put in one order for all sets: by how often they
occur (as a sketch of fixed size over all documents has it), rare ones first, then by hash. Two sets of
similarity 0.8 or more share one of the first ``n - ceil(0.8 n) + 1`` shingles, and two of the first ``n - ceil(0.8 n) + 2``.

*Light* sets, up to a boundary size, are found by all subsets of two of the latter; *heavy* ones by inverted lists of the
former. Light sets large enough to have heavy partners are in the lists as well. The boundary is where the rows for
subsets and the rows to scan in lists cost least, worked out from the sizes of all sets.

Lists are read several times. First each set is compared with its next few neighbours of fitting size, which links
most of a group of near copies in linear time. Every further reading goes farther and only compares sets that are not
connected yet; the last goes to the end, so no link between components is lost. Of the candidate pairs those go whose sets
must differ in too much: the parities of the shingles at 256 places differ in no more places than the sets do in shingles, and
similar sets do in at most a ninth of their added sizes. Every other pair is checked on the whole sets.

That gives the components. The links of a set are counted afterwards: similar sets are in one component, so the sets of each
component are dealt into blocks, and every pair of blocks is a piece of work of fixed size that compares all its pairs of sets.
``n_links`` is the number of other sets (not documents) that are similar to a document's.

Rules. Rows are documents. A set has the different 5-word shingles of the text with A-Z lower-cased; with fewer words the
whole text is one shingle; null or empty text and text without words has an empty set and is linked with nothing.
Sets are told apart by a 64-bit hash and their size, shingles by 64-bit hashes. Ties: the smallest doc_id names
the component; if all are null, it is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, chunks, filter_place, free_name, mixed, partitions, passes, row_filter, row_keys, signed, stored
from .components import components
from .shingles import common, set_key, shingle_sets

#: Cells of the sketch of shingle counts, as a power of two, and the pieces in which they are summed.
CELL_BITS = 22
PIECES = 64
#: What scanning an entry of an inverted list costs, in rows of subsets.
SCAN_COST = 4
#: Distances between the places of two sets in a list that each reading of the lists compares; the last has no end.
READINGS = ((1, 4), (5, 64), (65, 1 << 62))
#: Entries of a list that are compared in one piece; longer lists are cut, and pairs of pieces compared as well.
BLOCK = 1 << 16
#: Sets of a component in a block in which links are counted, about; shingles that are counted at once.
TOGETHER = 256
COLUMNS = 1 << 13
#: Words of 64 places each that hold the parities of a set.
PARITIES = ("p0", "p1", "p2", "p3")
#: Entries gathered before they are handed on, by bucket.
FLUSH = 500_000
ENTRY = np.dtype([("token", "<u4"), ("rest", "<u4"), ("n", "<u4"), ("sid", "<i8")])


def least_overlap(n: np.ndarray) -> np.ndarray:
    """ceil(0.8 n): what a set of n shingles has in common with any set similar enough."""
    return (4 * n + 4) // 5


def _count(cells: np.ndarray, held: list[np.ndarray]) -> None:
    place, n = np.unique(np.concatenate(held), return_counts=True)
    cells[place] += n.astype(np.uint32)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document, and the summed cells of all shingles (each class once a task)."""
    cells, held, seen = np.zeros(1 << CELL_BITS, np.uint32), [], set()
    for rows, data, offsets in chunks(batches):
        sids, sizes = [], []
        for s in shingle_sets(data, offsets):
            key = set_key(s)
            sids.append(key[0])
            sizes.append(len(s))
            if len(s) and key not in seen:
                seen.add(key)
                held.append((s >> np.uint64(64 - CELL_BITS)).astype(np.int64))
        if sum(map(len, held)) > FLUSH:
            _count(cells, held)
            held = []
        made = {c: rows.column(c) for c in ("doc_id", "r1", "r2")}
        yield pa.RecordBatch.from_pydict(made | {"sid": pa.array(sids, pa.int64()), "n": pa.array(sizes, pa.int64()), "piece": pa.nulls(len(sids), pa.int32()), "cells": pa.nulls(len(sids), pa.binary())})
    if held:
        _count(cells, held)
    if cells.any():
        none = pa.nulls(PIECES, pa.int64())
        squeeze = zstandard.ZstdCompressor(1).compress
        parts = [squeeze(part.tobytes()) for part in cells.reshape(PIECES, -1)]
        yield pa.RecordBatch.from_pydict({"doc_id": none, "r1": none, "r2": none, "sid": none, "n": none, "piece": pa.array(range(PIECES), pa.int32()), "cells": pa.array(parts, pa.binary())})


def _sum_cells(key, table):
    total = np.zeros((1 << CELL_BITS) // PIECES, np.int64)
    for part in table.column("cells").to_pylist():
        total += np.frombuffer(zstandard.ZstdDecompressor().decompress(part), np.uint32)
    steps = np.clip(8 + 8 * np.log2(np.maximum(total, 0.5)), 0, 255).astype(np.uint8)
    return pa.table({"piece": pa.array([key[0].as_py()], pa.int32()), "steps": pa.array([steps.tobytes()], pa.binary())})


def rarity(pieces: DataFrame) -> np.ndarray:
    """Eight steps for each doubling of a cell's count; the array has a fixed size, one byte a cell."""
    steps = np.zeros((PIECES, (1 << CELL_BITS) // PIECES), np.uint8)
    for row in pieces.groupBy("piece").applyInArrow(_sum_cells, "piece int, steps binary").collect():
        steps[row["piece"]] = np.frombuffer(row["steps"], np.uint8)
    return steps.ravel()


def boundary(sizes: dict[int, int]) -> int:
    """The largest size of a light set, where subsets and lists together cost least."""
    best, cost_of = 3, None
    for b in range(3, 200):
        cost = 0
        for n, m in sizes.items():
            p = n - (4 * n + 4) // 5 + 1
            cost += m * (p + 1) * p // 2 if 3 < n <= b else 0
            cost += m * p * SCAN_COST if n > b or 5 * n >= 4 * b else 0
        if cost_of is None or cost < cost_of:
            best, cost_of = b, cost
    return best


def _signer(steps, light: int, buckets: int):
    def entries(s: np.ndarray, sid: int) -> np.ndarray:
        n = len(s)
        order = (steps.value[(s >> np.uint64(64 - CELL_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (s >> np.uint64(8))
        p = n - (4 * n + 4) // 5 + 1
        first = np.sort(order)[: p + 1]
        tokens, rest = [], []
        if n > light or 5 * n >= 4 * light:
            tokens.append(mixed(first[:p]))
            rest.append(n - np.arange(p))
        if n <= light:
            i, j = np.triu_indices(len(first), 1)
            tokens.append(mixed(mixed(first[i]) + first[j]))
            rest.append(n - i)
        token = np.concatenate(tokens)
        out = np.empty(len(token), np.dtype([("bucket", "<i4"), *((c, ENTRY[c]) for c in ENTRY.names)]))
        out["bucket"], out["token"], out["rest"], out["n"], out["sid"] = token % np.uint64(buckets), token >> np.uint64(32), np.concatenate(rest), n, sid
        return out

    def rows(held: list[np.ndarray]) -> pa.RecordBatch:
        all_ = np.concatenate(held)
        all_ = all_[np.argsort(all_["bucket"], kind="stable")]
        border = np.flatnonzero(np.r_[True, all_["bucket"][1:] != all_["bucket"][:-1]])
        packed = np.empty(len(all_), ENTRY)
        for c in ENTRY.names:
            packed[c] = all_[c]
        parts = [packed[a:b].tobytes() for a, b in zip(border, [*border[1:], len(packed)])]
        return pa.RecordBatch.from_pydict({"bucket": pa.array(all_["bucket"][border], pa.int32()), "entries": pa.array(parts, pa.binary())})

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()
        for _, data, offsets in chunks(batches):
            for s in shingle_sets(data, offsets):
                if len(s) > 3 and (key := set_key(s)) not in seen:  # smaller sets have no partner but equal ones
                    seen.add(key)
                    held.append(entries(s, key[0]))
                    size += len(held[-1])
            if size > FLUSH:
                yield rows(held)
                held, size = [], 0
        if held:
            yield rows(held)

    return sign


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different inverted lists with two sets or more, a row for each entry."""
    bucket, held = None, []
    for batch in batches:
        for b, part in zip(batch.column("bucket").to_pylist(), batch.column("entries")):
            if b != bucket and held:
                yield from _list_rows(held)
                held = []
            bucket = b
            held.append(np.frombuffer(part.as_buffer(), ENTRY).copy())
    if held:
        yield from _list_rows(held)


def _list_rows(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    x = np.concatenate(held)
    x = x[np.lexsort((x["rest"], x["sid"], x["n"], x["token"]))]
    same = (x["token"][1:] == x["token"][:-1]) & (x["sid"][1:] == x["sid"][:-1]) & (x["n"][1:] == x["n"][:-1])
    x = x[np.r_[~same, True]]  # of a set's equal tokens the one with most behind it
    border = np.flatnonzero(np.r_[True, x["token"][1:] != x["token"][:-1]])
    sizes = np.diff(np.r_[border, len(x)])
    names = np.add.reduceat(mixed(x["sid"].astype(np.int64).view(np.uint64)) * (x["rest"].astype(np.uint64) + np.uint64(1)), border)
    several = np.flatnonzero(sizes > 1)
    several = several[np.unique(names[several], return_index=True)[1]]
    short = several[sizes[several] <= BLOCK]
    # lists that are not cut, so many together that they are about a block
    for together in np.split(short, np.flatnonzero(np.diff(np.cumsum(sizes[short]) // BLOCK)) + 1) if len(short) else ():
        length = sizes[together]
        at = np.arange(length.sum()) + np.repeat(border[together] - np.r_[0, np.cumsum(length)[:-1]], length)
        yield _entry_rows(np.repeat(names[together], length), x[at], np.zeros(len(at), np.int8))
    for one in several[sizes[several] > BLOCK]:
        name, own = names[one], x[border[one] : border[one] + sizes[one]]
        for i in range(0, len(own), BLOCK):
            left = own[i : i + BLOCK]
            yield _entry_rows(np.repeat(mixed(np.array([name + np.uint64(i)])), len(left)), left, np.zeros(len(left), np.int8))
            reach = (9 * left["rest"].astype(np.int64) // 4 - left["n"]).max()
            for j in range(i + BLOCK, len(own), BLOCK):
                right = own[j : j + BLOCK]
                if right["n"][0] > reach:
                    break
                both = np.concatenate([left, right])
                of = mixed(np.array([name + np.uint64(i) + np.uint64(j << 1)]))
                yield _entry_rows(np.repeat(of, len(both)), both, np.r_[np.ones(len(left), np.int8), np.full(len(right), 2, np.int8)])


def _entry_rows(names: np.ndarray, e: np.ndarray, side: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"list": signed(names), "side": side, "sid": e["sid"].astype(np.int64), "n": e["n"].astype(np.int64), "rest": e["rest"].astype(np.int64)})


def _pairer(first: int, last: int):
    """Pairs of a list, so far apart, that are not connected yet and whose sizes and places allow enough in common."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("list", "side", "sid", "n", "rest", "root")}
            if held is not None:
                rows = {c: np.concatenate([held[c], rows[c]]) for c in rows}
            border = np.flatnonzero(np.r_[True, rows["list"][1:] != rows["list"][:-1]])
            held = {c: rows[c][border[-1] :] for c in rows}
            yield from found(rows, border[:-1], border[1:])
        if held is not None:
            yield from found(held, [0], [len(held["list"])])

    def found(rows: dict, starts, ends) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for a, b in zip(starts, ends):
            one = {c: rows[c][a:b] for c in rows}
            n, rest, side, root = one["n"], one["rest"], one["side"], one["root"]
            if (root == root[0]).all():
                continue
            reach, places = 9 * rest // 4 - n, np.arange(b - a)
            for step in range(first, min(last + 1, b - a)):
                i, j = places[:-step], places[step:]
                near = n[j] <= reach[i]
                if not near.any():
                    if side[0] == 0:
                        break  # sizes only grow
                    continue
                ok = near & (9 * rest[j] >= 4 * (n[i] + n[j])) & ((side[i] == 0) | (side[i] != side[j])) & (root[i] != root[j])
                if ok.any():
                    out.append((one["sid"][i[ok]], one["sid"][j[ok]]))
                    size += len(out[-1][0])
                if size > 100_000:
                    yield rows_of(out)
                    out, size = [], 0
        if out:
            yield rows_of(out)

    def rows_of(out: list) -> pa.RecordBatch:
        x, y = (np.concatenate(side) for side in zip(*out))
        pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], 1), axis=0)
        return pa.RecordBatch.from_pydict({"a": pairs[:, 0].copy(), "b": pairs[:, 1].copy()})

    return pairs


def parities(shingles: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls on each of 256 places, as four 64-bit words."""
    odd = np.bincount((shingles & np.uint64(255)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def may_be_similar() -> Column:
    """Of pairs with sizes n_a and n_b and both sets' parities; true for all pairs with similarity 0.8 or more."""
    differ = sum(F.bit_count(F.col(f"{p}_a").bitwiseXOR(F.col(f"{p}_b"))) for p in PARITIES)
    return 9 * differ <= F.col("n_a") + F.col("n_b")


def _packer(held):
    """Texts of rows that the filter lets through, compressed, with sizes and parities of their sets."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(held.value, np.uint8)
        squeeze = zstandard.ZstdCompressor(3).compress
        for batch in batches:
            keep = batch.filter(pa.array(passes(bits, batch.column("place").to_numpy())))
            for part, data, offsets in chunks(iter([keep])):
                packed = [squeeze(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
                sets = shingle_sets(data, offsets)
                words = np.stack([parities(s) for s in sets], 1)
                made = {"r1": part.column("r1"), "r2": part.column("r2"), "text": pa.array(packed, pa.binary()), "n": pa.array(map(len, sets), pa.int64())}
                yield pa.RecordBatch.from_pydict(made | dict(zip(PARITIES, words)))

    return pack


def _chooser(held):
    """Texts that the filter lets through."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(held.value, np.uint8)
        for batch in batches:
            yield batch.select(["sid", "text"]).filter(pa.array(passes(bits, batch.column("place").to_numpy())))

    return choose


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that are similar; rows come sorted by the first of the pair."""
    last, own = None, None
    for batch in batches:
        for first in range(0, batch.num_rows, 200):
            part = batch.slice(first, 200)
            keep = []
            for a, x, y in zip(part.column("a").to_pylist(), part.column("left"), part.column("right")):
                if a != last:
                    last, own = a, _one_set(x)
                other = _one_set(y)
                both = common(own, other)
                keep.append(100 * both >= 80 * (len(own) + len(other) - both))
            if any(keep):
                yield part.select(["a", "b"]).filter(pa.array(keep))


def _one_set(text: pa.BinaryScalar) -> np.ndarray:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(text.as_buffer()), np.uint8)
    return shingle_sets(data, np.array([0, len(data)]))[0]


def similar_pairs(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Which sets of shingles on the left are similar to which on the right."""
    sizes = [np.array([len(s) for s in side], np.int64) for side in (left, right)]
    value, place = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    border = int(sizes[0].sum())
    both = np.zeros(len(value), bool)
    both[place[:border]] = True
    shared = np.zeros(len(value), bool)
    shared[place[border:]] = both[place[border:]]
    column = np.cumsum(shared) - 1
    rows = [np.repeat(np.arange(len(n)), n) for n in sizes]
    kept = [shared[x] for x in (place[:border], place[border:])]
    rows = [r[k] for r, k in zip(rows, kept)]
    columns = [column[x[k]] for x, k in zip((place[:border], place[border:]), kept)]
    order = [np.argsort(c, kind="stable") for c in columns]
    rows, columns = [r[o] for r, o in zip(rows, order)], [c[o] for c, o in zip(columns, order)]
    common_ = np.zeros((len(left), len(right)), np.int64)
    for first in range(0, int(shared.sum()), COLUMNS):
        parts = []
        for n, r, c in zip(sizes, rows, columns):
            a, b = np.searchsorted(c, [first, first + COLUMNS])
            part = np.zeros((len(n), COLUMNS), np.float32)
            part[r[a:b], c[a:b] - first] = 1
            parts.append(part)
        common_ += (parts[0] @ parts[1].T).astype(np.int64)
    return 100 * common_ >= 80 * (sizes[0][:, None] + sizes[1][None, :] - common_)


def _link_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each set in a pair of blocks its links there; rows come sorted by component and pair of blocks."""

    def counted(own: list[tuple]) -> pa.RecordBatch:
        i, j = own[0][1:3]
        first = [(sid, _one_set(text)) for *_, block, sid, text in own if block == i]
        second = [(sid, _one_set(text)) for *_, block, sid, text in own if block == j] if j != i else first
        sids, n = [sid for sid, _ in first], np.zeros(len(first), np.int64)
        if first and second:
            near = similar_pairs([s for _, s in first], [s for _, s in second])
            n = near.sum(1) - (j == i)  # each set is similar to itself
            if j != i:
                sids, n = sids + [sid for sid, _ in second], np.r_[n, near.sum(0)]
        return pa.RecordBatch.from_pydict({"sid": pa.array(sids, pa.int64()), "links": pa.array(n[: len(sids)], pa.int64())})

    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("root", "i", "j", "block", "sid")), batch.column("text")):
            if held and held[0][:3] != row[:3]:
                yield counted(held)
                held = []
            held.append(row)
    if held:
        yield counted(held)


def link_counts(sets: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """(sid, n_links) for the ``sets`` (sid, text) that have links, whose components are ``labels`` (id, root)."""
    members = labels.toDF("sid", "root")
    many = members.groupBy("root").agg(F.count("*").alias("m"))
    members = stored(members.join(many, "root").where("m > 1"), "members")
    two = members.where("m = 2").select("sid", F.lit(1).cast("long").alias("n_links"))
    last = F.ceil(F.col("m") / TOGETHER).cast("int") - 1
    dealt = members.where("m > 2").withColumn("last", last).withColumn("block", F.pmod(F.xxhash64("sid"), F.col("last") + 1).cast("int"))
    dealt = dealt.join(sets.select("sid", "text"), "sid").withColumn("other", F.explode(F.sequence(F.lit(0), "last")))
    dealt = dealt.select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "sid", "text")
    made = arrow_map(dealt.repartition(size, "root", "i", "j").sortWithinPartitions("root", "i", "j"), _link_counts, "sid long, links long")
    return two.unionByName(made.groupBy("sid").agg(F.sum("links").alias("n_links")))


def near_components(docs: DataFrame, links: bool = True) -> DataFrame:
    """A row for each of ``docs`` (doc_id integer, text): doc_id, r1 and r2 (its row key), n_shingles, component_id, n_links (null if not asked for), and root, a key of the component (null: empty set)."""
    spark, size = docs.sparkSession, partitions(docs.sparkSession)
    r1, r2 = row_keys("doc_id", "text")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), r1.alias("r1"), r2.alias("r2"), "text")
    sketched = stored(arrow_map(texts, _sketch, "doc_id long, r1 long, r2 long, sid long, n long, piece int, cells binary"), "sketch")
    known = sketched.where("piece is null").select("doc_id", "r1", "r2", "sid", "n")
    steps = spark.sparkContext.broadcast(rarity(sketched.where("piece is not null").select("piece", "cells")))
    sizes = {r["n"]: r["count"] for r in known.where("n < 1000").groupBy("n").count().collect()}
    signed_ = arrow_map(docs.select("text"), _signer(steps, boundary(sizes), size), "bucket int, entries binary")
    lists = arrow_map(signed_.repartition(size, "bucket").sortWithinPartitions("bucket"), _lists, "list long, side byte, sid long, n long, rest long")
    lists = stored(lists.dropDuplicates(["list", "side", "sid"]), "lists")

    def ordered(entries: DataFrame) -> DataFrame:
        return entries.repartition(size, "list").sortWithinPartitions("list", "side", "n", "sid")

    whole = lists.select("sid").distinct().join(known.groupBy("sid").agg(F.min(F.struct("r1", "r2")).alias("r")), "sid")
    whole = stored(whole.select("sid", "r.r1", "r.r2"), "wanted")
    held = spark.sparkContext.broadcast(row_filter(whole, "r1"))
    packed = arrow_map(texts.select("r1", "r2", filter_place("r1").alias("place"), "text"), _packer(held), "r1 long, r2 long, text binary, n long, " + ", ".join(f"{p} long" for p in PARITIES))
    whole = stored(packed.join(whole, ["r1", "r2"]).dropDuplicates(["r1", "r2", "sid"]).select("sid", "text", "n", *PARITIES), "sets")

    def marks(side: str) -> DataFrame:
        return whole.select(F.col("sid").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in ("n", *PARITIES)))

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs, "candidates")
        near = stored(pairs.join(marks("a"), "a").join(marks("b"), "b").where(may_be_similar()).select("a", "b"), "near")
        asked = spark.sparkContext.broadcast(row_filter(near.selectExpr("explode(array(a, b)) as sid"), "sid"))
        texts = arrow_map(whole.select("sid", filter_place("sid").alias("place"), "text"), _chooser(asked), "sid long, text binary")
        joined = near.join(texts.toDF("b", "right"), "b").join(texts.toDF("a", "left"), "a")
        return stored(arrow_map(joined.sortWithinPartitions("a"), _similar, "a long, b long"), "links")

    labels = None
    for reading in READINGS:
        if labels is None:
            asked = lists.withColumn("root", F.col("sid"))
        else:
            asked = lists.join(labels.toDF("sid", "root"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
            open_ = asked.groupBy("list").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("m")).where((F.col("x") != F.col("y")) & (F.col("m") > reading[0])).select("list")
            asked = asked.join(open_, "list", "left_semi")
        found = verified(arrow_map(ordered(asked), _pairer(*reading), "a long, b long").distinct())
        labels = stored(components(found if labels is None else labels.selectExpr("id as a", "root as b").unionByName(found)), "labels")

    if links:
        degree, none = link_counts(whole, labels, size), F.lit(0).cast("long")
    else:
        degree, none = spark.createDataFrame([], "sid long, n_links long"), F.lit(None).cast("long")
    classes = known.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("least")).join(labels.toDF("sid", "root"), "sid", "left").join(degree, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    classes = stored(classes, "classes")
    named = classes.join(classes.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("sid", "component_id", "n_links", "root")
    out = known.where("n > 0").join(named, "sid").select("doc_id", "r1", "r2", F.col("n").alias("n_shingles"), "component_id", F.coalesce("n_links", none).alias("n_links"), "root")
    return out.unionByName(known.where("n = 0").select("doc_id", "r1", "r2", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), none.alias("n_links"), F.lit(None).cast("long").alias("root")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest doc_id; empty sets all stay."""
    r1, r2, one, copy = (free_name(docs, c) for c in ("r1", "r2", "one", "copy"))
    k1, k2 = row_keys("doc_id", "text")
    found = near_components(docs, links=False)
    chosen = found.where("n_shingles > 0").groupBy("root").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "r1", "r2")).alias("m"))
    keys = chosen.select("m.r1", "m.r2", F.lit(True).alias("one")).unionByName(found.where("n_shingles = 0").select("r1", "r2", F.lit(False).alias("one")).distinct()).toDF(r1, r2, one)
    keys = stored(keys, "keys")
    kept = docs.withColumns({r1: k1, r2: k2}).join(keys, [r1, r2])
    # rows that repeat have one key: of those chosen one stays
    return kept.withColumn(copy, F.when(F.col(one), F.lit(0)).otherwise(F.monotonically_increasing_id())).dropDuplicates([r1, r2, copy]).drop(r1, r2, one, copy)
