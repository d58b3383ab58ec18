"""Tables within cells, and tables that lack their closing tag."""

import pytest

from pershare import extract_eps
from pershare.functions.markup import parse_elements

STATEMENT = "<table><tr><td>Basic EPS<td>1.25</tr><tr><td>Sales<td>9</tr></table>"
LAYOUT = f"<table><tr><td>Menu 7.5</td><td>a{STATEMENT}b</td><td>c</td></tr><tr><td>Foot</td></tr></table><p>after</p>"


def rows(document, **how):
    return [e.get("rows", e.get("text")) for e in parse_elements(document, with_text=True, **how)]


def test_each_table_has_its_own_rows():
    inner = [["Basic EPS", "1.25"], ["Sales", "9"]]
    assert rows(LAYOUT, nested=True) == [[["Menu 7.5", "ab", "c"], ["Foot", "", ""]], inner, "after"]
    deep = f"<p>x</p><table><tr><td>{LAYOUT}</td></tr></table>y<table><tr><td>z</table>"
    assert rows(deep, nested=True) == ["x", [["after"]], [["Menu 7.5", "ab", "c"], ["Foot", "", ""]], inner, "y", [["z"]]]
    assert [e["elem_seq"] for e in parse_elements(deep, with_text=True, nested=True)] == list(range(6))


def test_outermost_tables_alone_count_otherwise():
    assert rows(LAYOUT) == [[["Menu 7.5", "aBasic EPS1.25Sales9b", "c"], ["Foot", "", ""]], "after"]


@pytest.mark.parametrize("nested", [False, True])
def test_a_missing_closing_tag_hides_no_later_table(nested):
    for end in ("</td></tr>", "</tr>", "</td>", "</tr></tbody>"):
        document = f"<table><tr><td>one{end}<p>between</p>{STATEMENT}last"
        assert rows(document, nested=nested) == [[["one"]], "between", [["Basic EPS", "1.25"], ["Sales", "9"]], "last"]
    assert rows(f"<table>{STATEMENT}", nested=nested) == [[], [["Basic EPS", "1.25"], ["Sales", "9"]]]


def test_missing_closing_tags_within_a_cell():
    inner = "<table><tr><td>x</td></tr>"
    document = f"<table><tr><td>{inner}{STATEMENT}</td><td>d</td></tr></table>"
    assert rows(document, nested=True) == [[["", "d"]], [["x"]], [["Basic EPS", "1.25"], ["Sales", "9"]]]
    assert rows(document) == [[["xBasic EPS1.25Sales9", "d"]]]


def test_stray_closing_tags_and_open_documents():
    assert rows("</table></td><table><tr><td>a", nested=True) == [[["a"]]]
    assert rows("<table><tr><td>a<table><tr><td>b", nested=True) == [[["a"]], [["b"]]]


def test_filter_looks_at_the_own_text_of_a_table():
    import re

    found = parse_elements(LAYOUT, table_filter=re.compile("EPS"), nested=True)
    assert [e["elem_seq"] for e in found] == [1]


def test_many_levels_and_many_tables_in_linear_time():
    deep = "<table><tr><td>" * 400 + STATEMENT + "</td></tr></table>" * 400
    assert rows(deep, nested=True)[-1] == [["Basic EPS", "1.25"], ["Sales", "9"]]
    wide = "<table><tr><td>" + STATEMENT * 20_000 + "</table>"
    assert len(rows(wide, nested=True)) == 20_001


def test_layout_filing_gives_its_value(spark):
    filings = spark.createDataFrame([("a.html", LAYOUT), ("b.html", None)], "filename string, html string")
    assert [tuple(r) for r in extract_eps(filings, nested_tables=True).collect()] == [("a.html", 1.25)]
