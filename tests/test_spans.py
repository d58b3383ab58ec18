"""Spanned cells: runs of slots against the rules taken slot by slot, and spans of any length."""

import random
import tracemalloc

import pytest

from pershare import extract_eps
from pershare.functions.markup import parse_elements


def by_slot(table, fill):
    """Rows of (text, cols, rows) cells, slot by slot."""
    above, out = {}, []
    for cells in table:
        row, below = [], {}

        def from_above(row=row, below=below):
            while len(row) in above:
                left, text = above[len(row)]
                if left > 1:
                    below[len(row)] = (left - 1, text)
                row.append(text)

        for text, cols, rows in cells:
            from_above()
            for slot in range(cols):
                if rows > 1:
                    below[len(row)] = (rows - 1, text if fill else "")
                row.append(text if fill or slot == 0 else "")
        from_above()
        above = below
        out.append(row)
    width = max(map(len, out))
    return [row + [""] * (width - len(row)) for row in out]


def html(table):
    cell = lambda c: f"<td colspan={c[1]} rowspan='{c[2]}'>{c[0]}"
    return "<table>" + "".join("<tr>" + "".join(map(cell, row)) for row in table) + "</table>"


@pytest.mark.parametrize("fill", [False, True])
def test_random_spans(fill):
    rng = random.Random(4)
    for _ in range(3000):
        size = lambda: rng.choice([1, 1, 1, 2, 3, 5])
        table = [
            [(rng.choice("abc"), size(), size()) for _ in range(rng.randrange(1, 5))]
            for _ in range(rng.randrange(1, 6))
        ]
        assert parse_elements(html(table), fill_spans=fill)[0]["rows"] == by_slot(table, fill), table


def test_huge_spans_cost_nothing_and_keep_columns_apart():
    table = [[("wide", 10**9, 1), ("last", 1, 1)], [("a", 1, 10**9), ("b", 1, 1)], [("c", 10**9 - 1, 1), ("end", 1, 1)]]
    tracemalloc.start()
    rows = parse_elements(html(table))[0]["rows"]
    assert tracemalloc.get_traced_memory()[1] < 2_000_000
    tracemalloc.stop()
    assert {len(row) for row in rows} == {1003}
    # the two cells behind the wide ones are in the same column
    assert [row.index(text) for row, text in zip(rows, ("last", "b", "end"))] == [1002, 1, 1002]
    assert rows[2][:2] == ["", "c"]


def test_odd_spans():
    cell = "<table><tr><td {}>a<td>b<tr><td>c<tr><td>d</table>"
    rows = lambda attrs: parse_elements(cell.format(attrs))[0]["rows"]
    assert rows("rowspan=0") == [["a", "b"], ["", "c"], ["", "d"]]
    assert rows("colspan=0") == rows("colspan=x") == rows("") == [["a", "b"], ["c", ""], ["d", ""]]
    assert rows("rowspan=" + "9" * 5000) == rows("rowspan=0")
    # the slot of the text, a thousand of those it spans, and the cell behind
    assert len(rows("colspan=" + "9" * 5000)[0]) == 1002


def test_value_beside_a_huge_span(spark):
    page = "<table><tr><td colspan=1000000000>Basic EPS<tr><td rowspan=99999999>of the year<td>1.25<tr><td>2.5</table>"
    filings = spark.createDataFrame([("a", page)], "filename string, html string")
    assert extract_eps(filings).first().EPS == 1.25
