"""Candidates of a filing without leaving its row.

A filing is read as one value and its tables stay in that row as nested arrays, so the walk over
table rows needs neither shuffle nor sort: each table is cut into sections - a header group and the
value rows below it - and every value row takes its context from its own section. The result of
each step is the same as that of the window operators in ``grid``; use those where grids come as
rows of a table.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pershare.functions import cells as cell
from pershare.functions import columns, labels
from pershare.functions.patterns import EPS_FRAGMENT
from pershare.functions.vectors import let
from pershare.operators.elements import ROW_THRESHOLD


def with_candidates(
    parsed: DataFrame,
    timeframe: int,
    force_loss_negative: bool = False,
    typed_cells: bool = True,
    typed_columns: bool = False,
    short: bool = False,
) -> DataFrame:
    """Replace ``parsed`` (elements of a filing) by ``candidates``, in document order.

    ``value`` is null where the number could not be read. ``typed_columns`` types whole columns of a table, not only cells.
    With ``short`` the context of a very long header is a short text in which the same phrases and marks are found.
    """
    return (
        parsed.withColumn("tables", _tables(F.col("parsed"), timeframe, typed_cells, typed_columns))
        .drop("parsed")
        .withColumn("tables", F.filter("tables", _may_match))
        .withColumn("tables", F.transform("tables", _cut_into_sections))
        .withColumn("rows", F.flatten(F.transform("tables", lambda t: _value_rows(t, short))))
        .drop("tables")
        .withColumn("rows", F.filter("rows", _matches))
        .withColumn("rows", F.transform("rows", lambda r: _candidate(r, force_loss_negative)))
        .withColumn("candidates", F.transform("rows", _scored))
        .drop("rows")
    )


def best_value(candidates: Column) -> Column:
    """The value of the best candidate, the first among equals; null without candidates."""
    keyed = F.transform(
        F.filter(candidates, lambda c: c.value.isNotNull()),
        lambda c: F.struct(c.score, -c.table_seq, -c.row_idx, c.value.alias("value")),
    )
    return F.array_max(keyed).value


def count_unreadable(candidates: Column) -> Column:
    return F.size(F.filter(candidates, lambda c: c.value.isNull()))


def _tables(elements: Column, timeframe: int, typed_cells: bool, typed_columns: bool) -> Column:
    """Table elements, with the facts of each row that is not empty."""

    def facts(element: Column) -> Column:
        rows = F.transform(
            element.rows,
            lambda cells, i: F.struct(
                i.alias("row_idx"), (cell.typed_cells(cells) if typed_cells else cells).alias("cells")
            ),
        )
        if typed_columns:
            with_cells = lambda r, cells: F.struct(r.row_idx.alias("row_idx"), cells.alias("cells"))
            rows = columns.typed_columns(rows, lambda r: r.cells, with_cells)
        described = F.transform(
            rows,
            lambda r: F.struct(
                r.row_idx.alias("row_idx"),
                r.cells.alias("cells"),
                cell.row_label(r.cells).alias("label"),
                cell.is_header(r.cells).alias("is_header"),
                cell.years_ascend(element.col_labels, r.cells, timeframe).alias("years_ascend"),
            ),
        )
        return F.struct(
            element.elem_seq.alias("table_seq"),
            F.filter(described, lambda r: r.label.isNotNull()).alias("rows"),
        )

    is_table = lambda e: (e.tag == "table") & (e.n_rows > ROW_THRESHOLD)
    return F.transform(F.filter(elements, is_table), facts)


def _may_match(table: Column) -> Column:
    return F.exists(table.rows, lambda r: r.label.rlike("(?iu)" + EPS_FRAGMENT))


def _cut_into_sections(table: Column) -> Column:
    """Rows, positions at which sections begin, and the row index from which scans are reversed."""

    def start(row: Column, i: Column) -> Column:
        above = F.get(table.rows, i - 1)
        follows_header = F.coalesce(
            above.is_header & (above.row_idx == row.row_idx - 1), F.lit(False)
        )
        return F.when(row.is_header & ~follows_header, i)

    starts = F.array_compact(F.transform(table.rows, start))
    ascending = F.filter(table.rows, lambda r: r.years_ascend)
    return F.struct(
        table.table_seq.alias("table_seq"),
        table.rows.alias("rows"),
        F.array_union(F.array(F.lit(0)), starts).alias("starts"),
        F.get(ascending, F.lit(0)).row_idx.alias("reverse_from"),
    )


def _value_rows(table: Column, short: bool) -> Column:
    """Rows below the header of each section, with that header."""

    def section(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get(table.starts, k + 1), F.size(table.rows))
        rows = F.slice(table.rows, start + 1, end - start)
        header = F.array_join(F.transform(F.filter(rows, lambda r: r.is_header), lambda r: r.label), " ")
        wanted = lambda text: labels.short_header(text) if short else text
        return F.struct(
            let(header, lambda text: F.when(text != "", wanted(text))).alias("header"),
            F.filter(rows, lambda r: ~r.is_header).alias("rows"),
        )

    def value_row(header: Column, row: Column) -> Column:
        from_right = F.coalesce(row.row_idx >= table.reverse_from, F.lit(False))
        return F.struct(
            table.table_seq.alias("table_seq"),
            row.row_idx.alias("row_idx"),
            labels.join_context(header, row.label).alias("context"),
            cell.value_token(row.cells, from_right).alias("token"),
        )

    sections = F.transform(table.starts, section)
    return F.flatten(
        F.transform(sections, lambda s: F.transform(s.rows, lambda r: value_row(s.header, r)))
    )


def _matches(row: Column) -> Column:
    return row.token.isNotNull() & labels.mentions_eps(row.context)


def _candidate(row: Column, force_loss_negative: bool) -> Column:
    value = labels.signed(row.context, cell.parse_value(row.token), force_loss_negative)
    return F.struct(
        row.table_seq.alias("table_seq"),
        row.row_idx.alias("row_idx"),
        *labels.candidate_fields(row.context, value),
    )


def _scored(candidate: Column) -> Column:
    score = labels.score(
        candidate.type, candidate.is_adjusted, candidate.is_net, candidate.is_loss
    )
    return candidate.withField("score", score)
