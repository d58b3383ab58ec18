"""Input that was lost once: rows without cells, cells behind odd tags, sentence ends behind many marks."""

import time

from pyspark.sql import functions as F

from pershare.functions import markup
from pershare.operators.grid import drop_empty_columns
from pershare.operators.text import split_sentences


def test_rows_without_cells_stay(spark):
    rows = [("f", 0, 0, ["a", "", "1"]), ("f", 0, 1, []), ("f", 0, 2, None), ("g", 0, 0, [])]
    grid = spark.createDataFrame(rows, "filename string, table_seq int, row_idx int, cells array<string>")
    for block_rows in (1, 2, 65_536):
        got = drop_empty_columns(grid, block_rows).orderBy("filename", "row_idx").collect()
        assert [(r.filename, r.row_idx, r.cells) for r in got] == [("f", 0, ["a", "1"]), ("f", 1, []), ("f", 2, None), ("g", 0, [])]


def test_any_number_of_closing_marks(spark):
    df = spark.createDataFrame([("He left.”’)) Then EPS rose. Done",)], "text string")
    assert df.select(split_sentences(F.col("text")).alias("s")).first().s == ["He left.”’))", "Then EPS rose.", "Done"]


def test_tags_with_odd_quotes():
    assert markup._MARKUP.split('<td width="50%>EPS')[1::3] == ["td"]
    assert markup._MARKUP.split("<td title=it's>EPS")[3] == "EPS"
    assert markup._MARKUP.split('<td a="x>y">Z')[3] == "Z"


def test_unclosed_tags_take_linear_time():
    started = time.perf_counter()
    for piece in ("<a ", "<script ", '<a "'):
        markup._MARKUP.split(piece * 100_000)
    assert time.perf_counter() - started < 3


def test_spans():
    cols, rows = markup._COLSPAN, markup._ROWSPAN
    assert markup._span(cols, ' data-colspan="3"', 1000) == 1
    assert markup._span(cols, ' colspan="3"', 1000) == 3
    assert markup._span(rows, " rowspan=0", 65_534) == 65_534
    assert markup._span(cols, " colspan=0", 1000) == 1
    assert markup._span(cols, " colspan=" + "9" * 5000, 1000) == 1000
