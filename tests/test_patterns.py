"""Java patterns against the same rules in Python's regular expressions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from pershare.functions import cells, labels
from pershare.functions import patterns as p

ALPHABET = ["eps", "EPS", "s", "e.p.s", "income", "Earnings", "loss", "per", "share", "shares"]
ALPHABET += ["adjusted", "un", "non", "gaap", "G.A.A.P.", "basic", "Diluted", "net", "-", " ", " "]
ALPHABET += ["²", "é", "ſ", " ", " ", "\x1c", "\n", "\r", " ", "_", ":", "(", "$", ")"]
ALPHABET += ["1", "2.5", ".", "٣", "３", "0.05", "-", "ı", "İ", ","]

VALUE = r"\s*[$]?\s*[\(\-]?\s*[$]?\s*\d+\.\d+"


@pytest.fixture(scope="module")
def strings():
    rng = random.Random(3)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(1, 9))) for _ in range(20000)]


def python_phrases():
    return [
        r"\b" + r".*?".join(re.escape(word) + "s?" for word in phrase.split()) + r"[\s:]*\b"
        for phrase in p.PHRASES
    ]


def test_context_tests(spark, strings):
    text = F.lower("s")
    df = spark.createDataFrame([(s,) for s in strings], "s string").select(
        "s",
        text.alias("lowered"),
        labels.mentions_eps(text).alias("eps"),
        text.rlike(p.ADJUSTED_PATTERN).alias("adjusted"),
        text.rlike(p.GAAP_PATTERN).alias("gaap"),
        text.rlike("(?iu)" + p.EPS_FRAGMENT).alias("fragment"),
        labels.is_basic(text).alias("basic"),
        labels.type_labels(text).alias("labels"),
    )
    phrases = python_phrases()
    hits = 0
    for row in df.collect():
        s = row.lowered
        eps = any(re.search(v, s, re.IGNORECASE) for v in phrases)
        hits += eps
        adjusted = bool(re.search(rf"\b({p.NON_GAAP})\b", s, re.IGNORECASE))
        gaap = bool(re.search(rf"\b({p.GAAP})\b", s, re.IGNORECASE))
        assert (row.eps, row.adjusted, row.gaap) == (eps, adjusted, gaap), repr(s)
        assert row.fragment or not eps, repr(s)
        assert row.basic == bool(re.search("basic", s, re.IGNORECASE)), repr(s)
        assert ("gaap" in row.labels) == (gaap and not adjusted), repr(s)
    assert hits > 1000


def test_cells(spark, strings):
    cell = F.col("s")
    token = F.regexp_extract(cell, p.VALUE, 0)
    df = spark.createDataFrame([(s,) for s in strings], "s string").select(
        "s",
        cells.strip(cell).alias("stripped"),
        cells.is_header(F.array(cell)).alias("header"),
        F.when(token != "", cells.parse_value(token)).alias("value"),
    )
    hits = 0
    for row in df.collect():
        assert row.stripped == row.s.strip(), repr(row.s)
        assert row.header == (not re.search(r"[+-]?\d*\.\d+", row.s)), repr(row.s)
        found = re.search(VALUE, row.s)
        expected = None
        if found:
            try:
                bare = re.sub(r"[(),$]", "", found[0])
                expected = float(bare) * (-1 if "(" in found[0] else 1)
            except ValueError:
                pass
        hits += expected is not None
        if "\x1c" in row.s:
            continue  # Python's float takes this separator beside some characters only.
        assert row.value == expected, repr(row.s)
    assert hits > 1000


def test_foreign_digits_pair_up():
    assert len(p.FOREIGN_DIGITS) == len(p.ASCII_DIGITS)
    assert set(p.ASCII_DIGITS) == set("0123456789")
