"""The hand-made grids, through the window operators and through the array expressions."""

import pytest
from pyspark.sql import functions as F

from fixtures import GRID_SCHEMA, GRIDS, grid_rows, to_html
from pershare import eps_from_grid, extract_eps
from pershare.operators import grid, match, rank


def expected():
    return {name: value for name, (_, value) in GRIDS.items()}


@pytest.mark.parametrize("block_rows", [None, 65536, 2, 1])
def test_grids_in_long_form(spark, block_rows):
    rows = spark.createDataFrame(grid_rows(), GRID_SCHEMA)
    result = {r.filename: r.EPS for r in eps_from_grid(rows, 2020, block_rows).collect()}
    assert result == expected()


@pytest.mark.parametrize("block_rows", [None, 2])
def test_composed_operators(spark, block_rows):
    rows = spark.createDataFrame(grid_rows(), GRID_SCHEMA)
    winners = (
        rows.transform(grid.clean_cells)
        .transform(grid.drop_empty_rows)
        .transform(grid.drop_empty_columns, 2)
        .transform(grid.row_context, 2020, block_rows)
        .transform(match.candidates)
        .transform(rank.scores)
        .transform(rank.top_candidate)
    )
    result = rank.default_zero(rows.select("filename").distinct(), winners)
    assert {r.filename: r.EPS for r in result.collect()} == expected()


@pytest.mark.parametrize("open_cells", [False, True])
def test_grids_as_html(spark, open_cells):
    # One more row, so that no table is too short to count as one.
    filings = spark.createDataFrame(
        [(name, to_html([*rows, "End/of/table"], open_cells)) for name, (rows, _) in GRIDS.items()],
        "filename string, html string",
    )
    result = {r.filename: r.EPS for r in extract_eps(filings, 2020).collect()}
    # A table reader drops the separator of a purely numeric cell.
    assert result == expected() | {"F17": 1234.56}


def test_rejected_numbers_are_counted(spark):
    filings = spark.createDataFrame(
        [("a", to_html(["Basic EPS/- 0.05", "EPS/0.10"])), ("b", to_html(["EPS/0.1", "x/1"]))],
        "filename string, html string",
    )
    rows = extract_eps(filings, audit=True).collect()
    assert {(r.filename, r.EPS, r.n_unreadable) for r in rows} == {("a", 0.1, 1), ("b", 0.1, 0)}


def test_rejected_numbers_are_counted_with_an_encoder(spark):
    from checks.inputs import near_first_encoder

    bad = to_html(["Basic EPS/- 0.05", "x/1"])
    pages = {
        "a": bad + "<p>Our EPS was $0.25. The EPS of $ 3.50 rose</p>",
        "b": to_html(["Basic EPS/- 0.05", "EPS/0.10"]) + "<p>Our EPS was $0.25.</p>",
        "c": "<p>Our EPS was $0.25.</p>",
        "d": "<p>nothing</p>",
    }
    filings = spark.createDataFrame(list(pages.items()), "filename string, html string")
    rows = extract_eps(filings, make_encoder=near_first_encoder, audit=True).collect()
    assert {(r.filename, r.EPS, r.n_unreadable, r.n_unreadable_text) for r in rows} == {
        ("a", 3.5, 1, 1), ("b", 0.1, 1, 0), ("c", 0.0, 0, 1), ("d", 0.0, 0, 0),
    }
    assert "n_unreadable" not in extract_eps(filings, make_encoder=near_first_encoder).columns


def test_used_columns_are_words_of_bits(spark):
    wide = ["" if i % 3 else "x" for i in range(130)]
    rows = [("f", 0, 0, wide), ("f", 0, 1, ["y"]), ("f", 0, 2, []), ("f", 0, 3, None), ("f", 0, 9, [None, "", "z"]), ("g", 0, 0, ["", None])]
    df = spark.createDataFrame(rows, "filename string, table_seq int, row_idx int, cells array<string>")
    words = df.select("filename", "row_idx", grid._used_words(F.col("cells")).alias("w")).collect()
    assert [None if r.w is None else len(r.w) for r in sorted(words)] == [3, 1, None, None, 1, 1]
    for block_rows in (1, 2, 100):
        found = {(r.filename, r.row_idx): r.cells for r in grid.drop_empty_columns(df, block_rows).collect()}
        kept = [c for i, c in enumerate(wide) if i % 3 == 0 or i == 2]
        assert found == {("f", 0): kept, ("f", 1): ["y"], ("f", 2): [], ("f", 3): None, ("f", 9): [None, "z"], ("g", 0): []}
