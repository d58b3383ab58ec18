"""HTML to elements and grids."""

import re
import sys

import pyarrow as pa
import pytest

from pershare import extract_eps
from pershare.functions import markup
from pershare.functions.markup import parse_elements
from pershare.functions.patterns import EPS_FRAGMENT
from pershare.operators import elements


def tables(document, **options):
    return [e for e in parse_elements(document, **options) if e["tag"] == "table"]


def texts(document):
    return [e["text"] for e in parse_elements(document, with_text=True) if e["tag"] == "text"]


def test_spans_leave_empty_slots_or_repeat():
    document = (
        "<table><tr><td colspan=2>a<td rowspan='2'>b</tr><tr><td>c</td><td>d</td></tr>"
        "<tr><td>e</table>"
    )
    assert tables(document)[0]["rows"] == [["a", "", "b"], ["c", "d", ""], ["e", "", ""]]
    filled = tables(document, fill_spans=True)[0]["rows"]
    assert filled == [["a", "a", "b"], ["c", "d", "b"], ["e", "", ""]]


def test_rowspan_in_front_moves_cells():
    document = "<table><tr><td rowspan=3>a<td>b<tr><td>c<tr><td>d<tr><td>e<td>f</table>"
    assert tables(document)[0]["rows"] == [["a", "b"], ["", "c"], ["", "d"], ["e", "f"]]


@pytest.mark.parametrize(
    "head",
    [
        "<thead><tr><td>&nbsp;<td>2020<td>2019</thead>",
        "<tr><th></th><th>2020</th><th>2019</th></tr>",
    ],
)
def test_head_rows_are_labels(head):
    table = tables(f"<table>{head}<tbody><tr><td>EPS<td>1.0<td>2.0</table>")[0]
    assert table["col_labels"] == ["", "2020", "2019"]
    assert table["rows"] == [["EPS", "1.0", "2.0"]]
    assert table["n_rows"] == 2


def test_two_head_rows_are_joined_and_later_th_rows_stay():
    document = (
        "<table><thead><tr><th>Months<th>Three<tr><th><th>2020</thead>"
        "<tr><td>a<td>b<tr><th>c<th>d</table>"
    )
    table = tables(document)[0]
    assert table["col_labels"] == ["Months", "Three 2020"]
    assert table["rows"] == [["a", "b"], ["c", "d"]]


def test_cell_text():
    document = (
        "<TABLE><TR><TD>Net\n  loss<br>per <b>sha</b>re<!-- <td>x --></TD>"
        "<td title='a>b'> $&nbsp;&#40;0.05&#x29; <script>if (a<td) '</td>'</script></td></TR>"
        "</TABLE>"
    )
    assert tables(document)[0]["rows"] == [["Net loss per share", "$ (0.05)"]]


def test_nested_table_is_text_of_its_cell():
    document = (
        "<table><tr><td>a<table><tr><td>b</td></tr><tr><td>c</td></tr></table></td><td>d</td></tr>"
        "<tr><td>e</td></tr></table><p>after</p>"
    )
    found = parse_elements(document, with_text=True)
    assert found[0]["rows"] == [["abc", "d"], ["e", ""]]
    assert [e["tag"] for e in found] == ["table", "text"]


def test_text_around_and_between_tables_keeps_its_order():
    document = (
        "<title>no</title><div>one <i>run</i><table><tr><td>1</table>two<br>lines"
        "<table><tr><td>2</table></div>three &amp; <p>four<style>p{}</style><!-- five"
    )
    found = parse_elements(document, with_text=True)
    assert [e["tag"] for e in found] == ["text", "table", "text", "table", "text", "text"]
    assert [e["elem_seq"] for e in found] == list(range(6))
    assert texts(document) == ["one run", "two lines", "three &", "four"]


@pytest.mark.parametrize(
    "document",
    ["", "<", "<table", "<table>", "</table>", "<table><tr>", "<td>x", "<table></tr></td>x</table>"],
)
def test_broken_markup_does_not_raise(document):
    assert all(e["rows"] == [] for e in tables(document))


def test_filtered_tables_keep_the_numbers_of_the_others():
    import re

    document = "<table><tr><td>a</table><table><tr><td>E<b>P</b>S&#49;</table>"
    found = tables(document, table_filter=re.compile("eps1", re.IGNORECASE))
    assert [(e["elem_seq"], e["rows"]) for e in found] == [(1, [["EPS1"]])]


def test_one_row_table_is_text(spark):
    html = "<table><tr><td>Basic EPS<td>0.5</table><table><tr><td>a<td>N/A<tr><td>1,234<td>b,1</table>"
    filings = spark.createDataFrame([("f", html)], "filename string, html string")
    parsed = elements.elements(filings)
    assert [(r.kind, r.text) for r in parsed.orderBy("elem_seq").collect()] == [
        ("text", "Basic EPS 0.5"),
        ("table", None),
    ]
    rows = elements.grid_rows(parsed).orderBy("row_idx").collect()
    assert [(r.table_seq, r.row_idx, r.cells) for r in rows] == [
        (1, 0, ["a", ""]),
        (1, 1, ["1234", "b,1"]),
    ]
    assert [r.EPS for r in extract_eps(filings).collect()] == [0.0]


def test_year_in_column_label_reverses_every_row(spark):
    html = (
        "<table><thead><tr><td><td>2019<td>2020</thead>"
        "<tr><td>Basic EPS<td>0.40<td>0.43<tr><td>End<td></table>"
    )
    filings = spark.createDataFrame([("f", html), ("g", None)], "filename string, html string")
    assert [tuple(r) for r in extract_eps(filings, 2020).collect()] == [("f", 0.43)]
    assert [tuple(r) for r in extract_eps(filings, 2021).collect()] == [("f", 0.40)]


def test_force_loss_negative(spark):
    html = "<table><tr><td>{}<td>0.40<tr><td>End</table>"
    filings = spark.createDataFrame(
        [("loss", html.format("Loss per share")), ("both", html.format("Income (loss) per share"))],
        "filename string, html string",
    )
    assert {tuple(r) for r in extract_eps(filings).collect()} == {("loss", 0.4), ("both", 0.4)}
    forced = extract_eps(filings, force_loss_negative=True)
    assert {tuple(r) for r in forced.collect()} == {("loss", -0.4), ("both", 0.4)}


def test_small_filing_takes_few_calls():
    row = "<tr class='a>b'><td><font size=\"1\">Diluted</font></td><td>$1.23<TD align=right> ($2&#46;34)</tr>\n"
    page = (
        "<html><head><title>8-K</title></head><body><p>Report &amp; results<table><tr><td>Contents<td>1.00</td></tr>"
        "<tr><td>EPS</td></tr><p>Our year</p><TABLE><tr><td>Menu</td><td>Results<table>" + row + "</table>as filed</td></tr>"
        "<tr><td>Foot<td>Page 2</table><div>End</div></body></html>"
    )
    wanted = re.compile(EPS_FRAGMENT, re.IGNORECASE)
    markup.parse_elements(page, table_filter=wanted, nested=True)
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event in ("call", "c_call") else None)
    try:
        found = markup.parse_elements(page, table_filter=wanted, nested=True)
    finally:
        sys.setprofile(None)
    assert [e["rows"] for e in found] == [[["Contents", "1.00"], ["EPS", ""]]]
    assert len(calls) < 190


def test_elements_become_arrow_by_column():
    pages = ["<p>a<table><tr><th>H<td colspan=2>1<tr><td>2</table>b", "", "<table><thead><tr><th>x<th>y</thead><tr><td><td>1.5</table>"]
    parsed = [None, *(markup.parse_elements(p, True) for p in pages), [], None]
    for some in (parsed, [], [None], [[]]):
        assert markup._arrow(some).equals(pa.array(some, markup._ARROW_TYPE))
