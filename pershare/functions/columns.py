"""Types of whole columns, and cells as a reader gives them that types its columns.

Each cell has a kind, one bit; the bits of a column's cells joined by ``or`` say all that its type needs, so they are combined in any
order, in parts and without the cells. A column of numbers with any decimal, or with any gap, holds decimals: ``1000`` in it reads
``1000.0``. A column of whole numbers without a gap stays whole, one with any other text stays text.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pershare.functions.vectors import let

MISSING, WHOLE, DECIMAL, TRUTH, TEXT = 1, 2, 4, 8, 16

# What reads as a number or a truth value; a cell has lost white space and thousands separators.
_WHOLE = r"^[+-]?[0-9]+\z"
_DECIMAL = r"^[+-]?(?:[0-9]+\.[0-9]*|\.[0-9]+|[0-9]+(?=[eE]))(?:[eE][+-]?[0-9]+)?\z|^(?i:[+-]?inf(?:inity)?)\z"
_TRUTH = ("True", "TRUE", "true", "False", "FALSE", "false")


def cell_kind(cell: Column) -> Column:
    """The kind of a typed cell as a bit; whole numbers that no 64 bits hold are text."""
    whole = cell.try_cast("decimal(38,0)")
    fits = whole.between(F.lit("-9223372036854775808").cast("decimal(38,0)"), F.lit("18446744073709551615").cast("decimal(38,0)"))
    return (
        F.when(F.coalesce(cell, F.lit("")) == "", MISSING)
        .when(cell.rlike(_WHOLE), F.when(F.coalesce(fits, F.lit(False)), WHOLE).otherwise(TEXT))
        .when(cell.rlike(_DECIMAL), DECIMAL)
        .when(cell.isin(*_TRUTH), TRUTH)
        .otherwise(TEXT)
    )


def column_type(kinds: Column) -> Column:
    """``empty``, ``whole``, ``decimal``, ``truth`` or ``text``, from the joined kinds of a column's cells."""
    has = lambda bits: kinds.bitwiseAND(F.lit(bits)) != 0
    return (
        F.when(has(TEXT) | (has(TRUTH) & has(WHOLE | DECIMAL)), "text")
        .when(has(TRUTH), "truth")
        .when(has(DECIMAL) | (has(WHOLE) & has(MISSING)), "decimal")
        .when(has(WHOLE), "whole")
        .otherwise("empty")
    )


def retyped(cell: Column, type_: Column) -> Column:
    """The text of a cell's value in a column of that type."""
    return (
        F.when(cell == "", cell)
        .when(type_ == "decimal", decimal_text(cell))
        .when(type_ == "whole", cell.try_cast("decimal(38,0)").cast("string"))
        .when(type_ == "truth", F.initcap(cell))
        .otherwise(cell)
    )


def decimal_text(cell: Column) -> Column:
    """A number as the shortest decimal that reads the same: with a point up to 16 digits before and from 0.0001, else with an exponent."""
    return let(cell.try_cast("double"), lambda x: let(x.cast("string"), lambda s: _plain(x, s)))


def _plain(x: Column, shown: Column) -> Column:
    sign = F.when(F.startswith(shown, F.lit("-")), "-").otherwise("")
    digits = F.regexp_replace(F.regexp_extract(shown, r"([0-9.]+)E", 1), r"\.0\z|\.", "")
    power = F.regexp_extract(shown, r"E(-?[0-9]+)\z", 1).try_cast("int")
    before = F.rpad(digits, F.greatest(power + 1, F.length(digits)), "0")
    large = F.concat(sign, F.substr(before, F.lit(1), power + 1), F.lit("."), F.coalesce(F.nullif(F.substr(before, power + 2), F.lit("")), F.lit("0")))
    small = F.concat(sign, F.lit("0.000"), digits)
    mantissa = F.concat(F.substr(digits, F.lit(1), F.lit(1)), F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2)))).otherwise(""))
    exponent = F.concat(F.when(power < 0, "-").otherwise("+"), F.lpad(F.abs(power).cast("string"), F.greatest(F.length(F.abs(power).cast("string")), F.lit(2)), "0"))
    return (
        F.when(F.isnan(x) | F.abs(x).isin(float("inf")), F.when(x > 0, "inf").otherwise("-inf"))
        .when(power.isNull(), shown)
        .when(power.between(0, 15), large)
        .when(power == -4, small)
        .otherwise(F.concat(sign, mantissa, F.lit("e"), exponent))
    )


def typed_columns(rows: Column, cells_of, with_cells) -> Column:
    """An array of rows of one table with the cells of each column by its type; ``cells_of`` and ``with_cells`` read and replace them."""
    width = F.coalesce(F.array_max(F.transform(rows, lambda r: F.size(cells_of(r)))), F.lit(0))
    none = F.array_repeat(F.lit(0), width)
    joined = lambda kinds, r: F.zip_with(kinds, cells_of(r), lambda k, c: k.bitwiseOR(cell_kind(c)))
    types = F.transform(F.aggregate(rows, none, joined), column_type)
    return let(types, lambda t: F.transform(rows, lambda r: with_cells(r, F.zip_with(cells_of(r), t, retyped))))
