"""Filings to elements, and elements to grids in long form."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pershare.functions import cells as cell
from pershare.functions.markup import elements_of

# A table needs more rows than this to count as one.
ROW_THRESHOLD = 1


def elements(
    filings: DataFrame, with_text: bool = True, fill_spans: bool = False, nested: bool = False
) -> DataFrame:
    """One row per element of a filing, in the order of ``elem_seq``.

    Tables of a single row are text. With ``nested`` a table within a cell is an element of its own. A filing leaves the plan here: only its elements go on.
    """
    parsed = filings.select(
        "filename",
        elements_of(_worth_parsing(with_text), with_text, fill_spans, nested=nested).alias("parsed"),
    )
    element = F.col("element")
    is_table = (element.tag == "table") & (element.n_rows > ROW_THRESHOLD)
    return parsed.select("filename", F.explode("parsed").alias("element")).select(
        "filename",
        element.elem_seq.alias("elem_seq"),
        F.when(is_table, "table").otherwise("text").alias("kind"),
        element.n_rows.alias("n_rows"),
        element_text(element).alias("text"),
        element.col_labels.alias("col_labels"),
        element.rows.alias("rows"),
    )


def of_kind(elements_: DataFrame, kind: str) -> DataFrame:
    return elements_.filter(F.col("kind") == kind)


def grid_rows(elements_: DataFrame, typed_cells: bool = True) -> DataFrame:
    """Rows of the table elements, numbered from 0 within each table."""
    rows = of_kind(elements_, "table").select(
        "filename",
        F.col("elem_seq").alias("table_seq"),
        "col_labels",
        F.posexplode("rows").alias("row_idx", "cells"),
    )
    if typed_cells:
        rows = rows.withColumn("cells", cell.typed_cells(F.col("cells")))
    return rows.select("filename", "table_seq", "row_idx", "col_labels", "cells")


def element_text(element: Column) -> Column:
    """The text of a text element, or of a table too short to be one."""
    short_table = F.array_join(
        F.filter(
            F.concat(element.col_labels, F.flatten(element.rows)), lambda text: text != ""
        ),
        " ",
    )
    return F.when(element.tag == "text", element.text).when(
        element.n_rows <= ROW_THRESHOLD, short_table
    )


def _worth_parsing(with_text: bool) -> Column:
    """Documents without a table tag cannot give a table; they skip Python if only tables count."""
    html = F.col("html")
    return html if with_text else F.when(html.rlike("(?i)<table"), html)
