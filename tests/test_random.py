"""Random grids: windows, blocks and array expressions against the rules taken literally."""

import random
import re

import pytest

from fixtures import GRID_SCHEMA
from pershare import eps_from_grid
from pershare.functions.patterns import PHRASES
from pershare.operators import grid
from pershare.plans.extract import filing_candidates

YEAR = 2020
LABELS = ["Basic EPS", "Diluted", "Net loss per share", "Earnings per share:", "Adjusted", "Total"]
LABELS += ["Sales", "income", "per", "share", "EPS²", "Non-GAAP E.P.S", "step", ""]
VALUES = ["", "", "$", "0.5", "(1.25)", "( 2.5", "-0.75", "- 0.5", "7", "1,234.5", ".5", "2019"]
VALUES += ["2020", "FY2019 to 2020", "$(0.05)", "3.", "a 1.5 b"]


def random_table(rng):
    return [
        [rng.choice(LABELS), *(rng.choice(VALUES) for _ in range(3))]
        if rng.random() > 0.15
        else [""] * 4
        for _ in range(rng.randrange(1, 14))
    ]


def phrase_regex():
    joined = [r".*?".join(re.escape(w) + "s?" for w in p.split()) for p in PHRASES]
    return re.compile("|".join(rf"\b(?:{j})[\s:]*\b" for j in joined), re.IGNORECASE)


EPS = phrase_regex()


def expected_candidates(table):
    """(row, context, value) of each row by definition: look back for what is in force there."""
    is_header = lambda i: any(table[i]) and not any(re.search(r"\.\d", c) for c in table[i])
    label = lambda i: next(c for c in table[i] if c)
    found = []
    for i, cells in enumerate(table):
        if not any(cells) or is_header(i):
            continue
        last = max((h for h in range(i) if is_header(h)), default=None)
        words = [label(i)]
        if last is not None:
            first = last
            while first > 0 and is_header(first - 1):
                first -= 1
            words = [*(label(h) for h in range(first, last + 1)), *words]
        context = " ".join(words).lower()
        rows_so_far = [" ".join(t for c in table[h] for t in ("", c)) for h in range(i + 1) if any(table[h])]
        ascending = any(
            str(YEAR - 1) in text and str(YEAR) in text.split(str(YEAR - 1), 1)[1]
            and str(YEAR) not in text.split(str(YEAR - 1), 1)[0]
            for text in rows_so_far
        )
        scan = cells[::-1] if ascending else cells
        hits = [m for m in (re.search(r"([(-]?)\s*\$?\s*(\d+\.\d+)", c) for c in scan) if m]
        if EPS.search(context) and hits:
            sign, digits = hits[0][1], hits[0][2]
            parted = sign == "-" and not hits[0][0].replace("$", "").startswith("-" + digits[0])
            value = None if parted else float(digits) * (-1 if sign else 1)
            found.append((i, context, value))
    return found


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(11)
    return {f"t{i}": random_table(rng) for i in range(1500)}


def expected(tables):
    return {
        (name, row, context, value)
        for name, table in tables.items()
        for row, context, value in expected_candidates(table)
    }


@pytest.mark.parametrize("block_rows", [None, 1, 3])
def test_long_form(spark, tables, block_rows):
    from pershare.operators import match

    rows = [(n, 0, i, [], c) for n, table in tables.items() for i, c in enumerate(table)]
    df = spark.createDataFrame(rows, GRID_SCHEMA).transform(grid.drop_empty_rows)
    found = df.transform(grid.row_context, YEAR, block_rows).transform(match.candidates, True)
    assert {
        (r.filename, r.row_idx, r.context, r.value) for r in found.collect()
    } == expected(tables)


def test_in_row(spark, tables):
    def html(table):
        rows = "".join("<tr>" + "".join(f"<td>{c}" for c in cells) for cells in table)
        return f"<table>{rows}<tr><td>End</table>"

    # Without spaces at the edges and separators in numbers, cells come through HTML unchanged.
    plain = {
        n: [[c.replace("1,234.5", "9.5").strip() for c in cells] for cells in table]
        for n, table in tables.items()
    }
    df = spark.createDataFrame([(n, html(t)) for n, t in plain.items()], "filename string, html string")
    found = filing_candidates(df, YEAR).selectExpr("filename", "inline(candidates)")
    assert {
        (r.filename, r.row_idx, r.context, r.value) for r in found.collect()
    } == expected(plain)


def test_blocks_do_not_change_results(spark):
    """Long tables with long runs of headers, across many block borders."""
    rng = random.Random(5)
    rows = []
    for t in range(6):
        share = [0.02, 0.3, 0.6, 0.9, 0.98, 1.0][t]
        for i in range(400):
            if rng.random() > 0.1:
                head = rng.random() < share
                cells = [f"h{i} EPS" if rng.random() < 0.3 else f"h{i}", "" if head else f"{i}.5"]
                if rng.random() < 0.01:
                    cells[1] += " 2019 2020"
                rows.append((f"f{t % 2}", t, i, [], cells))
    df = spark.createDataFrame(rows, GRID_SCHEMA)
    columns = ["filename", "table_seq", "row_idx", "context", "reverse"]

    def contexts(block_rows):
        return {tuple(r) for r in grid.row_context(df, YEAR, block_rows).select(*columns).collect()}

    def starts(block_rows):
        found = grid.header_groups(df, block_rows)
        return {tuple(r) for r in found.select(*columns[:3], "group_start").collect()}

    whole, whole_starts = contexts(None), starts(None)
    assert len(whole) > 500
    for block_rows in (1, 7, 64, 10_000):
        assert contexts(block_rows) == whole
        assert starts(block_rows) == whole_starts
    results = {b: set(map(tuple, eps_from_grid(df, YEAR, b).collect())) for b in (None, 7)}
    assert results[None] == results[7]


def test_drop_empty_columns_in_blocks(spark):
    rows = [("f", t, i, ["a", "b", "c"], [str(i), "", "x" if i == t * 9 else ""]) for t in range(3) for i in range(9)]
    df = spark.createDataFrame(rows, GRID_SCHEMA)
    for block_rows in (2, 65536):
        found = {(r.table_seq, r.row_idx): (r.col_labels, r.cells) for r in grid.drop_empty_columns(df, block_rows).collect()}
        assert len(found) == 27
        assert found[0, 3] == (["a", "c"], ["3", ""])
        assert found[1, 8] == (["a"], ["8"])
