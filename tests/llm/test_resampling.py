"""Importance resampling against the rules taken literally."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pershare.llm.common import shared_folder
from pershare.llm.ordered import numbered
from pershare.llm.queries import QUERIES
from pershare.llm.resampling import PIECE, Features, _shift_tables, appended, pieces, resample

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return (text or "").encode().lower().decode()


def brute(docs, target, percent=25, least=20):
    def features(text):
        w = WORD.findall(ascii_lower(text))
        return len(w), collections.Counter(zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])])

    s, t = collections.Counter(), collections.Counter()
    found = [(d, *features(x)) for d, x in docs]
    for *_, f in found:
        s.update(f)
    for x in target:
        t.update(features(x)[1])
    a, b = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[i] + 1) * (a + 10000) / ((s[i] + 1) * (b + 10000)))) for i in range(10000)]
    scored = []
    for d, words, f in found:
        n = sum(f.values())
        weight = sum(gain[i] * c for i, c in f.items()) // n if n else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        scored.append((d, n, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words >= least))
    order = sorted((x for x in scored if x[4]), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    drawn = len(order) * percent // 100
    ranks = [(*x[:4], i if i <= drawn else None) for i, x in enumerate(order, 1)]
    return sorted(ranks + [(*x[:4], None) for x in scored if not x[4]], key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_against_brute_force(spark):
    long = " ".join(f"word{i % 977}Ä{i % 13}" for i in range(20_000)) + " " + "x" * (3 * PIECE) + "-END of it"
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(900, None), (901, ""), (902, " \t--\n "), (903, long), (904, "É è ß ÀB"), (905, "same words " * 15), (905, "same words " * 15), (None, "no id " * 12), (None, None)]
    target = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()] + [None, ""]
    frame = spark.createDataFrame([(x, d, x) for d, x in docs], "rank string, doc_id long, text string")
    assert got(resample(frame, spark.createDataFrame([(x,) for x in target], "text string"))) == brute(docs, target)


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert got(QUERIES["op11_importance_resampling"](spark, SF_DIR)) == brute(docs, target)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (2, "")]])
def test_nothing_to_draw(spark, rows):
    empty = spark.createDataFrame([], "text string")
    assert got(resample(spark.createDataFrame(rows, SCHEMA), empty)) == brute(rows, [])


def test_checksums_of_windows():
    rng = np.random.default_rng(3)
    texts = [rng.bytes(int(n)) for n in (0, 1, 2, 3, 7, 64, 1000, 70_000)]
    pairs = [(a, b) for a in texts for b in texts]
    crc = lambda side: np.array([zlib.crc32(p[side]) for p in pairs], np.uint32)
    found = appended(_shift_tables(), crc(0), crc(1), np.array([len(b) for _, b in pairs]))
    assert found.tolist() == [zlib.crc32(a + b) for a, b in pairs]


def test_longer_windows():
    text = b"a bc def gh a bc"
    n, doc, bucket, count = Features(3, 1 << 20).histograms(np.frombuffer(text + b"zz", np.uint8), np.array([0, len(text), len(text) + 2]))
    w = text.decode().split()
    want = collections.Counter((0, zlib.crc32(" ".join(w[i : i + k]).encode()) % (1 << 20)) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    want[1, zlib.crc32(b"zz") % (1 << 20)] += 1
    assert n.tolist() == [6, 1] and dict(zip(zip(doc, bucket), count)) == want


def test_pieces_end_between_words():
    text = ("wörd " * PIECE).encode()
    assert "".join(pieces(text)).encode() == text and all(p.strip(" ").count("wörd") * 5 - 1 == len(p.strip(" ")) for p in pieces(text))


def test_numbers_in_order(spark):
    rows = spark.range(5000).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"), F.lit(1).alias("at"))
    out = numbered(rows, [F.desc("a"), F.asc("b")], "n").orderBy("n").collect()
    assert [r.n for r in out] == list(range(1, 5001))
    assert [(r.a, r.b) for r in out] == sorted(((i % 7, i) for i in range(5000)), key=lambda x: (-x[0], x[1]))


def test_no_machine_local_folder_on_a_cluster():
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.master": "yarn"}.get(key, default))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())
