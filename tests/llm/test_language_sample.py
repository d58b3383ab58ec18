"""The sample that languages are learned from: copies fill no place in it, and no language is lost."""

import random

import pytest

from pershare.llm import language

SCHEMA = "text string, lang string"


def words(rng, letters, n=40):
    return " ".join("".join(rng.choices(letters, k=rng.randrange(3, 8))) for _ in range(n))


def test_copies_push_out_no_language(spark):
    rng = random.Random(4)
    alphabets = {"aa": "abcde", "bb": "fghij", "cc": "klmno"}
    rows = [(words(rng, letters), lang) for lang, letters in alphabets.items() for _ in range(300)]
    copies = [words(rng, "pqrst") for _ in range(5)]
    rows += [(copy, "dd") for copy in copies for _ in range(4000)]
    model = language.fit(spark.createDataFrame(rows, SCHEMA), per_lang=40)
    assert model.langs == ["aa", "bb", "cc", "dd"]
    asked = spark.createDataFrame([(words(rng, letters), lang) for lang, letters in [*alphabets.items(), ("dd", "pqrst")] for _ in range(10)], SCHEMA)
    assert all(r.lang_pred == r.lang for r in language.predict(asked, model).collect())


def test_many_languages(spark):
    rng = random.Random(5)
    rows = [(words(rng, "abcdefghijklmnopqrstuvwxyz"), f"l{k:03}") for k in range(300) for _ in range(2)]
    assert len(language.fit(spark.createDataFrame(rows, SCHEMA), per_lang=2).langs) == 300


@pytest.mark.parametrize("rows", [[], [(None, "aa")], [(" 12 ", "aa")], [("text", None)]])
def test_nothing_to_learn(spark, rows):
    model = language.fit(spark.createDataFrame(rows, SCHEMA))
    assert model.langs == []
    asked = spark.createDataFrame([("some text", 1, "x"), (None, 2, "y")], "text string, doc_id long, lang_pred string")
    assert {(r._lang_pred, r.score) for r in language.predict(asked, model).collect()} == {("und", 0.0)}
    assert language.predict(asked.where("false"), model).count() == 0


def test_repeated_rows_are_predicted_alike(spark):
    rng = random.Random(6)
    rows = [(words(rng, letters), lang) for lang, letters in (("aa", "abcd"), ("bb", "wxyz")) for _ in range(20)]
    model = language.fit(spark.createDataFrame(rows, SCHEMA))
    asked = spark.createDataFrame([rows[0]] * 50, SCHEMA)
    assert {r.lang_pred for r in language.predict(asked, model).collect()} == {"aa"}
