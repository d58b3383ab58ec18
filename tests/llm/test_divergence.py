"""The audit of sources against the rules taken literally."""

import collections
import random
import re

import numpy as np
import pytest

from pershare.llm import divergence
from pershare.llm.divergence import CountTree, audit, differences
from pershare.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least, top=50):
    docs = [(la or "", so or "", TERM.findall((t or "").encode().lower().decode())) for _, t, la, so in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = collections.Counter(w for *_, words in own for w in set(words))
        kept = [w for w, n in held.items() if n >= least]
        counts = {s: collections.Counter() for s in {d[1] for d in own}}
        whole = collections.Counter()
        for _, s, words in own:
            counts[s].update(w for w in words if held[w] >= least)
            whole.update(w for w in words if held[w] >= least)
        share = lambda c: {w: 1 + 10**9 * (c[w] + 5) // (sum(c.values()) + 5 * len(kept)) for w in kept}
        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s in p:
            pairs = [(-sum(abs(p[s][w] - p[o][w]) for w in kept), o.encode(), o) for o in p if o != s]
            terms = [(q[w] - p[s][w], w.encode(), w) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -value, i) for i, (value, _, item) in enumerate(found, 1)]
    return sorted(out)


def got(frame):
    return sorted(tuple(r) for r in frame.select("lang", "source", "part", "item", "value", "rank").collect())


def given(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]


def odd_rows():
    rows = [(900 + i, t, la, so) for i, (t, la, so) in enumerate([(None, None, None), ("", "en", "empty"), (" 12 .\n", "fr", None), ("Ünï Élan ÉLAN", None, "a"), ("only one here", "xx", "lone"), (None, "yy", "x"), (None, "yy", "Z"), (None, "yy", "é")])]
    return rows + [(950, "Same words\nagain And again", "en", "copies")] * 40 + [(960, "long " * 60_000, "de", "long")]


@pytest.mark.parametrize("cut", [{}, {"rows": 3, "columns": 40}])
def test_against_brute_force(spark, cut):
    rows = given(spark) + odd_rows()
    frame = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA + ", value long")
    assert got(audit(frame, 8, 5, **cut)) == brute(rows, 8, 5)


def test_query(spark):
    assert got(QUERIES["op12_source_divergence"](spark, SF_DIR)) == brute(given(spark), 30)


def test_no_documents_and_no_kept_terms(spark):
    assert got(audit(spark.createDataFrame([], SCHEMA))) == []
    rows = [(1, "a b", "en", "s"), (2, "a c", "en", "t"), (3, None, "en", "u")]
    assert got(audit(spark.createDataFrame(rows, SCHEMA), 3)) == brute(rows, 3)


@pytest.mark.parametrize("shape", [(1, 1), (5, 700), (70, 33), (130, 5)])
@pytest.mark.parametrize("dense", [0.0, 0.002, 0.3])
def test_walk_of_two_trees(shape, dense):
    rng = np.random.default_rng(5)
    sides = []
    for rows in (shape[0], max(1, shape[0] // 2)):
        zero = rng.integers(1, 50, rows)
        full = np.repeat(zero[:, None], shape[1], 1)
        row, column = np.nonzero(rng.random((rows, shape[1])) < dense)
        full[row, column] += rng.integers(1, 10**9, len(row))
        sides.append((full, CountTree(row, column, full[row, column], zero, shape[1])))
    (x, a), (y, b) = sides
    want = lambda x, y: np.abs(x[:, None, :] - y[None, :, :]).sum(2)
    assert (differences(a, b) == want(x, y)).all()
    above = np.triu(np.ones((len(x), len(x)), bool), 1)
    assert (differences(a, a)[above] == want(x, x)[above]).all()


def test_empty_quadrants_are_not_read():
    zero = np.arange(1, 513)
    tree = CountTree(np.array([0]), np.array([0]), np.array([99]), zero, 4096)
    differences(tree, tree)
    assert len(tree.cells) <= 512 // 32


def test_random_documents(spark):
    rng = random.Random(2)
    words = ["Alpha", "beta", "ÄGAMMA", "delta9eps", "zeta-eta"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(30))), rng.choice(["en", "fr", None]), f"s{rng.randrange(9)}") for i in range(300)]
    assert got(audit(spark.createDataFrame(rows, SCHEMA), 12, 4, rows=4, columns=7)) == brute(rows, 12, 4)


def test_counts_handed_on_early_and_large_counts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 50)
    rows = given(spark) + odd_rows()
    assert got(audit(spark.createDataFrame(rows, SCHEMA), 8, 5)) == brute(rows, 8, 5)
    monkeypatch.setattr(divergence, "LONG", 2)
    assert got(audit(spark.createDataFrame(rows, SCHEMA), 8, 5)) == brute(rows, 8, 5)
