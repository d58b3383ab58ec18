"""Expressions over one grid row: its cells, label, header test, year order and value."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pershare.functions.patterns import (
    ASCII_DIGITS,
    DECIMAL,
    EDGE_SPACE,
    FOREIGN_DIGITS,
    MISSING_MARKS,
    PLAIN_NUMBER,
    VALUE,
)
from pershare.functions.vectors import let


def strip(text: Column) -> Column:
    return F.regexp_replace(text, EDGE_SPACE, "")


def clean_cells(cells: Column) -> Column:
    """Missing cells become empty text, the others lose white space at both ends."""
    return F.transform(cells, lambda c: strip(F.coalesce(c, F.lit(""))))


def typed_cells(cells: Column) -> Column:
    """Cells as a table reader gives them that knows thousands separators and missing marks."""
    return F.transform(
        cells,
        lambda c: F.when(c.isin(*MISSING_MARKS), "")
        .when(c.rlike(PLAIN_NUMBER), F.translate(c, ",", ""))
        .otherwise(c),
    )


def row_label(cells: Column) -> Column:
    """The leftmost cell that is not empty; null when there is none."""
    return F.get(F.filter(cells, lambda c: c != ""), F.lit(0))


def is_header(cells: Column) -> Column:
    """A row without any decimal number."""
    return ~F.exists(cells, lambda c: _has_point(c) & c.rlike(DECIMAL))


def _has_point(text: Column) -> Column:
    """Cheap to find out, and without a point there is no decimal number."""
    return F.contains(text, F.lit("."))


def years_ascend(col_labels: Column, cells: Column, timeframe: int) -> Column:
    """Both the year before ``timeframe`` and ``timeframe`` occur in the row, the earlier one first.

    The row is read as label and cell in turn, in full.
    """
    pairs = F.zip_with(
        F.coalesce(col_labels, F.array().cast("array<string>")),
        cells,
        lambda label, cell: F.array(F.coalesce(label, F.lit("")), F.coalesce(cell, F.lit(""))),
    )
    before = lambda text: F.instr(text, str(timeframe - 1))
    return let(
        F.array_join(F.flatten(pairs), " "),
        lambda text: (before(text) > 0) & (before(text) < F.instr(text, str(timeframe))),
    )


def value_token(cells: Column, from_right: Column) -> Column:
    """The signed number of the first cell that holds one, in scan direction; null without one."""
    tokens = F.filter(
        F.transform(cells, lambda c: F.when(_has_point(c), F.regexp_extract(c, VALUE, 0))),
        lambda token: token != "",
    )
    return F.try_element_at(tokens, F.when(from_right, -1).otherwise(1))


def parse_value(token: Column) -> Column:
    """The number of a token, negative after an open bracket or a dash.

    A dash parted from its number gives null, as does everything else that is no number.
    """
    bare = strip(F.regexp_replace(token, r"[(),$]", ""))
    number = F.translate(bare, FOREIGN_DIGITS, ASCII_DIGITS).try_cast("double")
    return number * F.when(F.contains(token, F.lit("(")), -1.0).otherwise(1.0)
