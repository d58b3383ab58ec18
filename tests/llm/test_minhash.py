"""Near copies by one-permutation hashing against a comparison of all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pershare.llm import minhash
from pershare.llm.minhash import BAND_ROWS, BANDS, band_keys, least_size, near_copies, parities, signature
from pershare.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows, percent):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").encode().lower())
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = {s: s for s in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    different = [s for s in parent if s]
    for i, a in enumerate(different):
        for b in different[:i]:
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                parent[root(a)] = root(b)
    least = {}
    for (d, _), s in zip(rows, sets):
        if s and d is not None:
            least[root(s)] = min(least.get(root(s), d), d)
    named = [(d, len(s), least.get(root(s)) if s else d) for (d, _), s in zip(rows, sets)]
    return sorted([(*x, x[0] == x[2]) for x in named], key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def given(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


def odd_rows():
    return [(900, None), (901, ""), (902, " \t\n "), (903, "One"), (904, "one"), (905, "x" * 1200), (905, "x" * 1200), (None, "no id here at all, none"), (None, None), (906, "no id HERE at all, none"), (907, "w " * 9000), (908, "w " * 70)]


def edited(rng, words, share):
    return " ".join(w if rng.random() > share else f"e{rng.randrange(10**6)}" for w in words)


def near_rows(seed=4):
    """Groups about the threshold, chains of small steps, small sets, and a large group that shares a bucket but not enough."""
    rng = random.Random(seed)
    rows = []
    for base in range(12):
        words = [f"b{base}w{rng.randrange(400)}" for _ in range(rng.choice([7, 11, 12, 30, 120]))]
        rows += [edited(rng, words, share) for share in (0.0, 0.005, 0.01, 0.02, 0.03, 0.04)]
        rows += [" ".join(words[k:] + [f"t{base}"] * k) for k in range(4)]
    chain = [f"c{i}" for i in range(150)]
    for k in range(25):
        rows.append(" ".join(chain[4 * k :] + [f"d{i}" for i in range(4 * k)]))
    common = [f"s{i}" for i in range(90)]
    for k in range(60):
        rows.append(" ".join(common + [f"own{k}x{i}" for i in range(rng.randrange(6, 16))]))
    rng.shuffle(rows)
    return list(enumerate(rows, 2000))


@pytest.mark.parametrize("percent", [85, 70])
def test_against_all_pairs(spark, percent):
    rows = given(spark) + odd_rows() + near_rows() + [(5000 + i, "copies of one text that many rows hold " * 3) for i in range(300)]
    frame = spark.createDataFrame([(*r, i, "k") for i, r in enumerate(rows)], SCHEMA + ", sid long, kept string")
    assert got(near_copies(frame, percent)) == brute(rows, percent)


def test_blocks_of_open_buckets(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 7)
    rows = near_rows(9)
    assert got(near_copies(spark.createDataFrame(rows, SCHEMA))) == brute(rows, 85)


def test_query(spark):
    assert got(QUERIES["op13_minhash_dedup"](spark, SF_DIR)) == brute(given(spark), 85)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (2, "")], [(1, "a b"), (2, "a c")]])
def test_nothing_to_link(spark, rows):
    assert got(near_copies(spark.createDataFrame(rows, SCHEMA))) == brute(rows, 85)


@pytest.mark.parametrize("size", [6, 17, 60, 900])
def test_signatures_agree_as_sets_do(size):
    """Also where nearly all bins are borrowed the share of equal bins is the similarity, and similar sets meet in a band."""
    rng = np.random.default_rng(size)
    shares, met = [], 0
    for _ in range(200):
        union = rng.integers(0, 1 << 63, size * 7 // 6 if size > 6 else 7).astype(np.uint64) * np.uint64(2)
        a, b = np.sort(union[: -1 - len(union) // 14]), np.sort(union[len(union) // 14 :])
        x, y = (signature(s, BANDS * BAND_ROWS) for s in (a, b))
        shares.append((x == y).mean() - len(np.intersect1d(a, b)) / len(union))
        met += (band_keys(x, BANDS) == band_keys(y, BANDS)).any()
    assert abs(np.mean(shares)) < 0.02 and met == 200


def test_least_size():
    for percent in (50, 80, 85, 90, 99):
        n = least_size(percent)
        assert 100 * n >= percent * (n + 1) and 100 * (n - 1) < percent * n


def test_parities_bound_the_difference():
    rng = np.random.default_rng(8)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 300)).astype(np.uint64))
        b = np.unique(np.r_[a[rng.random(len(a)) < 0.9], rng.integers(0, 1 << 63, rng.integers(0, 20)).astype(np.uint64)])
        differ = np.bitwise_count((parities(a) ^ parities(b)).view(np.uint64)).sum()
        assert differ <= len(np.setxor1d(a, b))


def test_stars_stay_linear(spark):
    """A large group of near copies makes one candidate for each set and bucket, not one for each pair."""
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(400):
        own = list(words)
        own[rng.randrange(300)] = f"own{i}"
        rows.append((i, " ".join(own)))
    folder = minhash.near_copies(spark.createDataFrame(rows, SCHEMA))
    assert {r.component_id for r in folder.collect()} == {0}
    assert folder.where(F.col("kept")).count() == 1
