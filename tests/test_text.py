"""Sentences, numbers and their nearness to a phrase."""

import math
import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pershare import extract_eps
from pershare.operators import rank, text

# The encoder below travels with the task: this module is not on the workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = (
    "Full Year Fiscal 2020 Adjusted EPS of $2.71, up 38% over prior year, with reported EPS of $1.84\n"
    "Annual Revenues of $1.06 billion, up 14.5% over prior"
)


@pytest.mark.parametrize(
    "paragraph, expected",
    [
        (SAMPLE, [SAMPLE]),
        ("One. Two! Three?", ["One.", "Two!", "Three?"]),
        ("Up 2.71 points.  Down\n3.5.\n", ["Up 2.71 points.", "Down\n3.5."]),
        ("The e.p.s. of $0.31 rose. It did.", ["The e.p.s. of $0.31 rose.", "It did."]),
        ("Acme Inc. and Bolt Co. merged. Done", ["Acme Inc. and Bolt Co. merged.", "Done"]),
        ("He said “no.” Then (all of it.) went.", ["He said “no.”", "Then (all of it.)", "went."]),
        ("Wait... what?! Yes", ["Wait...", "what?!", "Yes"]),
        (" \n ", []),
        ("casino. Next", ["casino.", "Next"]),
    ],
)
def test_sentences(spark, paragraph, expected):
    found = text.sentences(spark.createDataFrame([(1, paragraph)], "id int, text string"))
    assert [r.sentence for r in found.orderBy("sent_idx").collect()] == expected


def test_sentence_of_many_words_and_points(spark):
    long = "1.5 " * 20000 + "word " * 20000
    found = text.sentences(spark.createDataFrame([(long,)], "text string"))
    assert [len(r.sentence) for r in found.collect()] == [len(long.strip())]


def test_variants(spark):
    sents = spark.createDataFrame(
        [("EPS, earnings and income per share",), ("Losses per shares",), ("steps",)],
        "sentence string",
    )
    found = text.sentence_variants(sents).collect()
    assert {(r.sentence[:6], r.variant_idx, r.phrase) for r in found} == {
        ("EPS, e", 0, "eps"),
        ("EPS, e", 2, "income per share"),
        ("EPS, e", 3, "earnings per share"),
        ("Losses", 4, "loss per share"),
    }
    kept = text.sentence_variants(sents, outer=True)
    assert [r.sentence for r in kept.filter("phrase is null").collect()] == ["steps"]


TOKENS = ["$", "$", "1", "2.5", ".", ",", ".5", "5.", "a", "²", "##7", "1.2.3", "", "eps"]


def expected_numbers(tokens):
    """By definition: for each dollar sign, the longest run of number parts after it."""

    def is_part(token):
        return token in (".", ",") or token.replace(".", "", 1).isdigit()

    found = []
    for i, token in enumerate(tokens):
        if token == "$":
            end = next((j for j in range(i + 1, len(tokens)) if not is_part(tokens[j])), len(tokens))
            number = "".join(tokens[i + 1 : end]).replace(",", "")
            if "." in number:
                found.append((number, i))
    return found


def test_dollar_numbers_against_definition(spark):
    rng = random.Random(7)
    rows = [[rng.choice(TOKENS) for _ in range(rng.randrange(12))] for _ in range(2000)]
    tokens = F.transform("t", lambda t: F.struct(t.alias("tok"), F.array().cast("array<float>").alias("vec")))
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t array<string>")
    found = df.select("i", text.dollar_numbers(tokens).alias("n")).collect()
    for row in found:
        assert [(n.num, n.tok_idx) for n in row.n] == expected_numbers(rows[row.i]), rows[row.i]


VARIANT_SCHEMA = (
    "filename string, elem_seq int, sent_idx int, variant_idx int, phrase string, "
    "sentence string, tokens array<struct<tok:string,vec:array<float>>>"
)


def nearest(spark, tokens, phrase="eps", threshold=0.5):
    rows = [("f", 0, 0, 0, phrase, "Basic EPS", tokens)]
    found = text.nearest_numbers(spark.createDataFrame(rows, VARIANT_SCHEMA), threshold)
    return [(r.num, r.tok_idx, round(r.sim, 6)) for r in found.collect()]


def number(whole, vec):
    return [("$", vec), (whole, [9.0, 9.0]), (".", [9.0, 9.0]), ("5", [9.0, 9.0])]


def test_nearest_number(spark):
    eps = [("EPS", [1.0, 0.0]), ("reps", [1.0, 0.0])]
    near, far, along = [1.0, 0.1], [1.0, 1.0], [3.0, 0.0]
    assert nearest(spark, [*eps, *number("1", far), *number("2", near)]) == [
        ("2.5", 6, round(1 / math.sqrt(1.01), 6))
    ]
    # Equally near: the first. The length of a vector does not count.
    assert nearest(spark, [*eps, *number("1", along), *number("2", [1.0, 0.0])]) == [("1.5", 2, 1.0)]
    # Exactly on the threshold is not above it.
    half = [1.0, 0.0]
    anchor = [("eps", [0.5, math.sqrt(0.75)])]
    assert nearest(spark, [*anchor, *number("1", half)], threshold=0.500001) == []
    assert nearest(spark, [*eps, *number("1", [0.0, 0.0])]) == []
    assert nearest(spark, [*eps, *number("1", [0.0, 0.0])], threshold=-1.0) == [("1.5", 2, 0.0)]


def test_nothing_to_compare(spark):
    nan = float("nan")
    eps = ("eps", [1.0, 0.0])
    assert nearest(spark, [eps, ("$", [1.0, 0.0]), ("5", [1.0, 0.0])]) == []
    assert nearest(spark, number("1", [1.0, 0.0])) == []
    assert nearest(spark, [eps, *number("1", [1.0, nan]), *number("2", [1.0, 0.0])]) == []
    assert nearest(spark, [("eps", [nan, 0.0]), *number("1", [1.0, 0.0])]) == []
    # The dotted phrase finds no anchor in tokens that are split at points.
    dotted = [("e", [1.0, 0.0]), (".", [1.0, 0.0]), ("p", [1.0, 0.0]), *number("1", [1.0, 0.0])]
    assert nearest(spark, dotted, "e.p.s") == []


def test_unreadable_number_is_no_candidate(spark):
    tokens = [("eps", [1.0]), ("$", [1.0]), ("1", [1.0]), (".", [1.0]), (".", [1.0])]
    rows = [("f", 0, 0, 0, "eps", "EPS", tokens)]
    found = text.nearest_numbers(spark.createDataFrame(rows, VARIANT_SCHEMA))
    assert found.count() == 1
    assert text.text_candidates(found).count() == 0


def test_candidates_are_ranked_by_score_then_place(spark):
    eps = [("eps", [1.0])]
    rows = [
        ("f", 1, 0, 0, "eps", "Adjusted basic EPS", [*eps, *number("1", [1.0])]),
        ("f", 2, 1, 0, "eps", "EPS", [*eps, *number("2", [1.0])]),
        ("f", 2, 0, 1, "eps", "EPS", [*eps, *number("3", [1.0])]),
        ("f", 2, 0, 0, "eps", "EPS, adjusted", [*eps, *number("4", [1.0])]),
        ("g", 1, 0, 0, "eps", "Net adjusted EPS", [*eps, *number("5", [1.0])]),
    ]
    rows = [(*r[:6], [(tok, vec[:1]) for tok, vec in r[6]]) for r in rows]
    found = text.text_candidates(text.nearest_numbers(spark.createDataFrame(rows, VARIANT_SCHEMA)))
    winners = found.transform(rank.scores).transform(rank.top_candidate, rank.TEXT_ORDER)
    # In f the adjusted basic and the plain values all score 100; the first of them wins.
    assert {tuple(r) for r in winners.collect()} == {("f", 1.5), ("g", 5.5)}


def one_word_encoder():
    import re

    def encode(sentences):
        split = [re.findall(r"[a-z]+|\d+|\S", s.lower()) for s in sentences]
        return [(tokens, [[1.0, 0.0] for _ in tokens]) for tokens in split]

    return encode


def test_text_fallback(spark):
    row = "<table><tr><td>{}<td>0.40<tr><td>End</table>"
    prose = "<p>The loss per share was $0.25, after $0.30. </p><p>Basic EPS of $0.70 in all.</p>"
    filings = spark.createDataFrame(
        [
            ("table", row.format("Diluted EPS") + prose),
            ("text", row.format("Revenue") + prose),
            # The point that ends the sentence joins the number, which then cannot be read.
            ("last word", "<p>EPS of $0.70.</p>"),
            ("neither", row.format("Revenue") + "<p>EPS of 5.</p><p>Paid $3.50.</p>"),
            ("empty", ""),
            ("undecodable", None),
        ],
        "filename string, html string",
    )
    found = extract_eps(filings, 2020, one_word_encoder)
    assert {tuple(r) for r in found.collect()} == {
        ("table", 0.4),
        ("text", 0.7),
        ("last word", 0.0),
        ("neither", 0.0),
        ("empty", 0.0),
    }
