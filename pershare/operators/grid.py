"""Operators over grids in long form: one row per table row, with document order in
``(table_seq, row_idx)``.

A table is walked with windows over ``(filename, table_seq)``. Where a table may be too long for one
task, ``block_rows`` cuts it into blocks of consecutive row indexes, each its own window group; what
a block hands on to the next (the header in force and the scan direction) is worked out on one
summary row per block and joined back per block, so no task ever sees more than a block of a table.

Rows name their header by the row at which it begins. Its text is kept once, in a table of header runs, and meets the rows
where they need it; where only what it says counts, a short text stands for it.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pershare.functions import cells as cell
from pershare.functions import columns
from pershare.functions.labels import join_context, short_header
from pershare.plans.shared import written_once

KEYS = ["filename", "table_seq"]
BLOCK = [*KEYS, "block"]
BLOCK_ROWS = 65_536
#: Columns whose bits are in one long.
WORD_BITS = 64


def clean_cells(grid: DataFrame) -> DataFrame:
    return grid.withColumn("cells", cell.clean_cells(F.col("cells")))


def drop_empty_rows(grid: DataFrame) -> DataFrame:
    """Rows with text in some cell; the others keep their row index, so gaps stay visible."""
    return grid.filter(F.exists("cells", lambda c: c != ""))


def drop_empty_columns(grid: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Keep the columns of a table that hold text in at least one of its rows.

    A row gives a word of bits for every ``WORD_BITS`` of its columns, which are joined before the shuffle. The words of a
    table are copied once per block of rows before they are joined back.
    """
    used = (
        grid.select(*KEYS, "row_idx", F.posexplode(_used_words(F.col("cells"))).alias("word", "bits"))
        .groupBy(*KEYS, "word")
        .agg(F.bit_or("bits").alias("bits"), F.max("row_idx").alias("last_row"))
    )
    kept = (
        used.groupBy(*KEYS)
        .agg(
            F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("kept"),
            F.max("last_row").alias("last_row"),
        )
        .select(
            *KEYS,
            F.col("kept.bits").alias("kept"),
            F.explode(F.sequence(F.lit(0), _block("last_row", block_rows))).alias("block"),
        )
    )
    keep_used = lambda values: F.filter(values, lambda _, i: _is_used(F.col("kept"), i))
    pruned = grid.withColumn("block", _block("row_idx", block_rows)).join(kept, [*KEYS, "block"], "left")
    # rows without cells have no columns to keep, but stay
    pruned = pruned.withColumn("kept", F.coalesce("kept", F.array().cast("array<bigint>")))
    pruned = pruned.withColumn("cells", keep_used(F.col("cells")))
    if "col_labels" in grid.columns:
        pruned = pruned.withColumn("col_labels", keep_used(F.col("col_labels")))
    return pruned.select(*grid.columns)


def _used_words(cells: Column) -> Column:
    """A bit for each column, set where the cell holds text; null without cells."""
    none = F.lit(0).cast("long")

    def word(k: Column) -> Column:
        own = F.slice(cells, k * WORD_BITS + 1, WORD_BITS)
        bits = F.transform(own, lambda c, i: F.when(c != "", _bit(i)).otherwise(none))
        return F.aggregate(bits, none, lambda all_, bit: all_.bitwiseOR(bit))

    last = F.floor((F.size(cells) - 1) / WORD_BITS).cast("int")
    return F.when(F.size(cells) > 0, F.transform(F.sequence(F.lit(0), last), word))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def _is_used(words: Column, column: Column) -> Column:
    word = F.get(words, F.floor(column / WORD_BITS).cast("int"))
    return F.coalesce(word.bitwiseAND(_bit(column % WORD_BITS)) != 0, F.lit(False))


def column_types(grid: DataFrame) -> DataFrame:
    """``type`` of every column (``col_idx``) of a table, from all its cells, with the last row that has the column.

    A row gives a bit for each of its columns, which are joined before the shuffle.
    """
    return (
        grid.select(*KEYS, "row_idx", F.posexplode("cells").alias("col_idx", "cell"))
        .groupBy(*KEYS, "col_idx")
        .agg(F.bit_or(columns.cell_kind(F.col("cell"))).alias("kinds"), F.max("row_idx").alias("last_row"))
        .select(*KEYS, "col_idx", columns.column_type(F.col("kinds")).alias("type"), "last_row")
    )


def retype_columns(grid: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Cells as a reader gives them that types whole columns; a row without cells has none.

    The types of a table are as many as it has columns; they are copied once per block of rows before they are joined back,
    so a long table is no hot key.
    """
    types = (
        column_types(grid)
        .groupBy(*KEYS)
        .agg(F.sort_array(F.collect_list(F.struct("col_idx", "type"))).alias("types"), F.max("last_row").alias("last_row"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), _block("last_row", block_rows))))
        .select(*KEYS, "block", F.col("types.type").alias("types"))
    )
    typed = grid.withColumn("block", _block("row_idx", block_rows)).join(types, [*KEYS, "block"], "left")
    types = F.coalesce("types", F.array().cast("array<string>"))
    short = F.slice(types, F.lit(1), F.size("cells"))
    return typed.withColumn("cells", F.zip_with("cells", short, columns.retyped)).select(*grid.columns)


def row_labels(grid: DataFrame) -> DataFrame:
    return grid.withColumn("label", cell.row_label(F.col("cells")))


def header_rows(grid: DataFrame) -> DataFrame:
    return grid.withColumn("is_header", cell.is_header(F.col("cells")))


def year_order(grid: DataFrame, timeframe: int, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """``reverse``: from the first row with the two years ascending, scan right to left."""
    framed = _framed(_facts(grid, timeframe), block_rows, F.lit(False))
    return framed.select(*grid.columns, "reverse")


def header_groups(grid: DataFrame, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """``group_start``: row index at which the header group in force begins; ``header``: its text.

    Header rows with consecutive row indexes form one group. Rows before the first have neither.
    On a header row the text is that of the whole group.
    """
    framed = _framed(_facts(grid, None), block_rows, F.col("label").isNotNull())
    return framed.select(*grid.columns, "label", "is_header", "group_start", "header")


def row_context(
    grid: DataFrame,
    timeframe: int,
    block_rows: int | None = BLOCK_ROWS,
    keep_all: bool = False,
    short: bool = False,
) -> DataFrame:
    """Value rows with their context in lower case and their scan direction.

    ``block_rows=None`` is for grids whose tables are known to be short: it skips the hand-over
    between blocks. ``keep_all`` leaves header rows and empty rows in, with a null context. With ``short`` the context of a
    very long header is a short text in which the same phrases and marks are found.
    """
    is_value = ~F.col("is_header") & F.col("label").isNotNull()
    context = F.when(is_value, join_context(F.col("header"), F.col("label")))
    rows = (
        _framed(_facts(grid, timeframe), block_rows, is_value, short)
        .withColumn("context", context)
        .select(*grid.columns, "context", "reverse")
    )
    return rows if keep_all else rows.filter(F.col("context").isNotNull())


def _block(row_idx: str, block_rows: int) -> Column:
    return F.floor(F.col(row_idx) / block_rows).cast("int")


def _facts(grid: DataFrame, timeframe: int | None) -> DataFrame:
    """What each row says on its own, before any row is seen beside another."""
    cells = F.col("cells")
    labels = F.col("col_labels") if "col_labels" in grid.columns else F.lit(None)
    ascend = F.lit(False) if timeframe is None else cell.years_ascend(labels, cells, timeframe)
    label = cell.row_label(cells)
    return grid.withColumns(
        {
            "label": label,
            "is_header": cell.is_header(cells) & label.isNotNull(),
            "years_ascend": ascend,
        }
    )


def _framed(
    facts: DataFrame, block_rows: int | None, needs_header: Column, short: bool = False
) -> DataFrame:
    """Add ``group_start`` and ``reverse`` to every row, and ``header`` to those that need it."""
    if block_rows is None:
        return _with_group_text(_within(facts, KEYS))
    blocked = facts.withColumn("block", _block("row_idx", block_rows))
    return _across_blocks(_within(blocked, BLOCK), needs_header, short).drop("block")


def _within(facts: DataFrame, keys: list[str]) -> DataFrame:
    ordered = Window.partitionBy(*keys).orderBy("row_idx")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    follows_header = F.coalesce(
        F.lag("is_header").over(ordered)
        & (F.lag("row_idx").over(ordered) == F.col("row_idx") - 1),
        F.lit(False),
    )
    return (
        facts.withColumns(
            {
                "starts": F.when(F.col("is_header") & ~follows_header, F.col("row_idx")),
                "reverse": F.max("years_ascend").over(so_far),
            }
        )
        .withColumn("group_start", F.max("starts").over(so_far))
        .drop("starts")
    )


def _with_group_text(framed: DataFrame) -> DataFrame:
    """The text of the group on each of its rows, in tables short enough for that."""
    group = (
        Window.partitionBy(*KEYS, "group_start")
        .orderBy("row_idx")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    header_labels = F.collect_list(F.when(F.col("is_header"), F.col("label"))).over(group)
    text = F.when(F.col("group_start").isNotNull(), F.array_join(header_labels, " "))
    return framed.withColumn("header", text)


def _across_blocks(framed: DataFrame, needs_header: Column, short: bool) -> DataFrame:
    """Complete the first rows of each block with what the blocks before it hand on, and look up headers.

    The rows are walked once and written. ``runs`` has a row for each group in a block; all that is handed on are row
    indexes. Each text is put together once, from its parts by block, and copied to the blocks with rows that need it.
    """
    framed = written_once(framed, "framed").withColumn("run", F.coalesce("group_start", F.lit(-1)))
    parts = F.sort_array(F.collect_list(F.when(F.col("is_header"), F.struct("row_idx", "label"))))
    text = F.array_join(F.transform(parts, lambda p: p.label), " ")
    runs = framed.groupBy(*BLOCK, "run").agg(
        F.max(F.when(F.col("is_header"), F.col("row_idx"))).alias("end"),
        F.bool_or("years_ascend").alias("ascend"),
        F.bool_or(needs_header).alias("needed"),
        (short_header(text) if short else text).alias("part"),
    )
    runs = (
        runs.join(_handed_on(runs), BLOCK, "left")
        .withColumn(
            "group_start",
            F.when((F.col("run") == -1) | (F.col("run") == F.col("open_end") + 1), F.col("open_start"))
            .otherwise(F.nullif("run", F.lit(-1))),
        )
        .drop("open_start", "open_end")
    )
    whole = F.sort_array(F.collect_list(F.struct("block", "part")))
    joined = F.array_join(F.transform(whole, lambda p: p.part), " ")
    texts = (
        runs.filter(F.col("end").isNotNull())
        .groupBy(*KEYS, "group_start")
        .agg((short_header(joined) if short else joined).alias("header"))
    )
    by_run = (
        runs.join(texts, [*KEYS, "group_start"], "left")
        .withColumn("header", F.when(F.col("needed"), F.col("header")))
        .select(*BLOCK, "run", "group_start", "header", "open_ascend")
    )
    return (
        framed.drop("group_start")
        .join(by_run, [*BLOCK, "run"], "left")
        .withColumn("reverse", F.col("reverse") | F.coalesce("open_ascend", F.lit(False)))
        .drop("run", "open_ascend")
    )


def _handed_on(runs: DataFrame) -> DataFrame:
    """For each block that is not the first of its table: the header run open at its start, by the rows at which it begins
    and ends, and whether the scan is reversed by then. Tables of a single block hand nothing on."""
    last_runs = (
        runs.groupBy(*BLOCK)
        .agg(
            F.max(F.nullif("run", F.lit(-1))).alias("start"),
            F.max("end").alias("end"),
            F.bool_or("ascend").alias("ascend"),
        )
        .withColumn("last_block", F.max("block").over(Window.partitionBy(*KEYS)))
        .filter(F.col("last_block") > 0)
        .drop("last_block")
    )
    by_block = Window.partitionBy(*KEYS).orderBy("block")
    so_far = by_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    continues = F.coalesce(F.col("start") == F.lag("end").over(by_block) + 1, F.lit(False))
    return (
        last_runs.withColumn("opens", F.when(F.col("start").isNotNull() & ~continues, F.col("start")))
        .withColumns(
            {
                "open_start": F.last("opens", ignorenulls=True).over(so_far),
                "open_end": F.last("end", ignorenulls=True).over(so_far),
                "open_ascend": F.max("ascend").over(so_far),
            }
        )
        .select(
            *BLOCK,
            *(F.lag(name).over(by_block).alias(name) for name in ("open_start", "open_end", "open_ascend")),
        )
        .filter(F.col("open_start").isNotNull() | F.col("open_ascend"))
    )
