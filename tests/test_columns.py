"""Types of whole columns against a table reader that types its columns."""

import io
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pershare import eps_from_grid, extract_eps
from pershare.functions import columns
from pershare.operators import grid

GRID = "filename string, table_seq int, row_idx int, cells array<string>"


def read(rows):
    """The cells as a reader of tables gives them, each column on its own."""
    out = []
    for column in zip(*rows):
        typed = pd.read_csv(io.StringIO("\n".join(f'"{c}"' for c in ("x", *column))), skip_blank_lines=False, engine="python")["x"]
        typed = typed.astype(object) if typed.isna().all() else typed
        out.append(["" if pd.isna(v) else str(v) for v in typed])
    return [list(r) for r in zip(*out)]


def long_form(rows, name="f"):
    return [(name, 0, i, list(r)) for i, r in enumerate(rows)]


def cells(frame):
    return [r.cells for r in frame.orderBy("row_idx").collect()]


CASES = [
    [["1000", "1000", "1", "true", "x"], ["2.50", "7", "", "FALSE", "1"], ["", "007", "30", "true", ""]],
    [["1e5", "1e16", "0.00001", "-.5", "inf"], ["12.", "123456789.5", "0.00012", "+3", "1"], ["-0", "12345678", "100000000000000000000.0", "5", "2"]],
    [["true", "9223372036854775807", "99999999999999999999", ""], ["1", "-5", "1", ""], ["0", "0", "2", ""]],
    [["1.2.3", "(1.25)", "$ 1.25", "2020"], ["1.5", "2", "3", "1.25"], ["", "", "", ""]],
]


@pytest.mark.parametrize("rows", CASES)
def test_against_a_table_reader(spark, rows):
    frame = spark.createDataFrame(long_form(rows), GRID)
    assert cells(grid.retype_columns(frame)) == read(rows)
    assert cells(grid.retype_columns(frame, block_rows=2)) == read(rows)


def test_random_columns(spark):
    rng = random.Random(6)
    pool = ["", "", "1", "20", "-3", "4.50", "1e3", ".25", "0.1", "1234567.0", "x", "True", "false", "10000000", "12345678901234.5"]
    rows = [list(r) for r in zip(*([rng.choice(own) for _ in range(6)] for own in [rng.sample(pool, rng.randrange(1, 4)) for _ in range(60)]))]
    frame = spark.createDataFrame(long_form(rows), GRID)
    assert cells(grid.retype_columns(frame, block_rows=4)) == read(rows)


def test_shown_decimals(spark):
    rng = random.Random(2)
    numbers = [rng.choice([1, -1]) * rng.randrange(1, 10 ** rng.randrange(1, 15)) * 10.0 ** rng.randrange(-20, 25) for _ in range(400)]
    numbers += [0.0, -0.0, 1e15, 1e16, 123456789012345.6, 0.001, 0.0001, 0.00099, 9999999.0, 1e7, 1e22]
    frame = spark.createDataFrame([(repr(x),) for x in numbers], "x string").select("x", columns.decimal_text(F.col("x")).alias("y"))
    wrong = [(r.x, r.y) for r in frame.collect() if float(r.y) != float(r.x) or (len(r.y) <= len(r.x) and r.x != r.y)]
    assert wrong == []


def test_rows_of_unequal_width_and_no_cells(spark):
    rows = [("f", 0, 0, ["1", "2"]), ("f", 0, 1, []), ("f", 0, 2, ["1.5"]), ("g", 0, 0, ["1"])]
    found = grid.retype_columns(spark.createDataFrame(rows, GRID)).orderBy("filename", "row_idx").collect()
    assert [r.cells for r in found] == [["1.0", "2"], [], ["1.5"], ["1"]]


def test_whole_numbers_among_gaps_are_values(spark):
    table = "<table><tr><td>Basic EPS<td>1,000<td>7</tr><tr><td>Sales<td>2.5<td>8</tr><tr><td>Cost<td><td>9</tr></table>"
    filings = spark.createDataFrame([("a.html", table)], "filename string, html string")
    assert extract_eps(filings).first().EPS == 2.5
    assert extract_eps(filings, typed_columns=True).first().EPS == 1000.0
    rows = [["Basic EPS", "1000", "7"], ["Sales", "2.5", "8"], ["Cost", "", "9"]]
    by_grid = spark.createDataFrame(long_form(rows, "a.html"), GRID)
    assert eps_from_grid(by_grid).first().EPS == 2.5
    assert eps_from_grid(by_grid, typed_columns=True).first().EPS == 1000.0
