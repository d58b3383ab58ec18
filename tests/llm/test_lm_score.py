"""Prediction by partial matching held against a version that walks dictionaries byte by byte."""

import collections
import math

import pytest
from pershare.llm import lm_score
from pyspark.sql import functions as F

TEXTS = ["the cat sat on the mat", "the rat sat too", "", None, "thé çat ✓", "a" * 400, "the cat sat on the mat", "zebra \x00 quiz", "b", "abcabcabd " * 30]


def literal(train, asked, order):
    """log10 probability of each asked text: contexts and counts as plain dictionaries."""
    after = collections.defaultdict(collections.Counter)
    for text in train:
        line = b"\xff" * order + (text or "").encode() + b"\xff"
        for at in range(order, len(line)):
            for length in range(order + 1):
                after[line[at - length : at]][line[at]] += 1
    scores = []
    for text in asked:
        line, score = b"\xff" * order + (text or "").encode() + b"\xff", 0.0
        for at in range(order, len(line)):
            excluded = set()
            for length in range(order, -1, -1):
                seen = after.get(line[at - length : at], {})
                new = {b: n for b, n in seen.items() if b not in excluded}
                if not new:
                    continue
                whole = sum(new.values()) + len(new)
                if line[at] in new:
                    score += math.log10(new[line[at]] / whole)
                    break
                score += math.log10(len(new) / whole)
                excluded |= set(seen)
            else:
                score -= math.log10(256 - len(excluded))
        scores.append(score)
    return scores


@pytest.mark.parametrize(("order", "cached"), [(5, 500_000), (5, 0), (5, 20), (2, 10), (0, 5)])
def test_scores_are_those_of_the_literal_model(spark, order, cached):
    rows = [(n, text, n % 3 != 1) for n, text in enumerate(TEXTS + ["the mat sat on a cat ✓", "quite another thing: ÿ"])]
    got = lm_score.score_documents(spark.createDataFrame(rows, "doc_id long, text string, train boolean"), order, cached).collect()
    want = literal([t for _, t, train in rows if train], [t for _, t, _ in rows], order)
    assert {r.doc_id: pytest.approx(r.score, abs=1e-9) for r in got} == dict(enumerate(want))


def test_no_n_gram_is_left_out(spark):
    """Texts of which each holds n-grams of its own: the model holds every one of them."""
    df = spark.range(3000).select(F.concat(F.lit("x"), F.sha2(F.col("id").cast("string"), 256)).alias("text"))
    model = lm_score.train_model(df, 5)
    held = model[-1].select(F.explode("next")).count()
    texts = [b"\xff" * 5 + r.text.encode() + b"\xff" for r in df.collect()]
    assert held == len({t[at : at + 6] for t in texts for at in range(len(t) - 5)})


def test_without_training_all_bytes_are_alike(spark):
    rows = [(1, "abc", False), (2, None, None)]
    got = {r.doc_id: r.score for r in lm_score.score_documents(spark.createDataFrame(rows, "doc_id long, text string, train boolean")).collect()}
    assert got == pytest.approx({1: -4 * math.log10(256), 2: -math.log10(256)})


def test_probabilities_after_a_context_sum_to_one(spark):
    df = spark.createDataFrame([("the cat sat on the mat and the rat sat too. " * 20,)], "text string")
    for order in (2, 5):
        model = lm_score.train_model(df, order)
        for context in (b"\xff" * order, b"the cat"[-order:], b"zqzqzqz"[-order:], b" the ma"[-order:]):
            first = int.from_bytes(context, "big") << 8
            asked = spark.range(first, first + 256).withColumnRenamed("id", "gram")
            assert lm_score.gram_scores(asked, model).agg(F.sum(F.pow(F.lit(10.0), "log10"))).first()[0] == pytest.approx(1)
