"""The extraction plans: filings or grids in, one value per filing out."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pershare.functions import cells as cell
from pershare.functions import labels
from pershare.functions.markup import elements_of
from pershare.functions.patterns import DEFAULT_TIMEFRAME, EPS_FRAGMENT
from pershare.operators import grid, rank, sections, text
from pershare.operators.elements import ROW_THRESHOLD, element_text
from pershare.sources.filings import decodable


def extract_eps(
    filings: DataFrame,
    timeframe: int = DEFAULT_TIMEFRAME,
    make_encoder: Callable[[], text.Encoder] | None = None,
    force_loss_negative: bool = False,
    audit: bool = False,
    typed_columns: bool = False,
    nested_tables: bool = False,
    status: bool = False,
    long_headers: bool = False,
) -> DataFrame:
    """``filename`` and ``EPS`` for every readable filing; 0 where none is found.

    From tables alone the plan is one narrow stage: scan, HTML, array expressions. With an encoder,
    filings without a table candidate fall back on their text; only sentences that name the phrase
    and hold a dollar sign are encoded, and one aggregate per filing follows. ``audit`` adds
    ``n_unreadable``, the number of matching rows whose number could not be read, and with an encoder
    ``n_unreadable_text``, that of sentences and phrases whose nearest number could not be read, in filings whose text counts.
    ``typed_columns`` reads tables with a type for each column, so that whole numbers among decimals or gaps are values;
    ``nested_tables`` reads tables within cells as tables of their own, for filings laid out by tables. ``long_headers`` is for
    filings with thousands of headers in a row above thousands of values: a short text stands for each long header, which gives
    the same values in linear time by a larger plan.

    ``status`` gives every filing a row, from the same scan, with ``filing_id`` if the filings have one: ``table`` or ``text``
    where the value was found, ``none`` where it is 0 for want of any, ``undecodable`` with no value for bytes that are no UTF-8.
    Filings of one name are told apart by ``filing_id``, or else by what they hold; without ``status`` each has its row too.
    """
    if not status:
        filings = decodable(filings)
    if make_encoder is None:
        found = filing_candidates(
            filings, timeframe, force_loss_negative, typed_columns, nested_tables, short=long_headers
        )
        found = found.withColumn("table_value", sections.best_value(F.col("candidates")))
        extra = [sections.count_unreadable(F.col("candidates")).alias("n_unreadable")]
        return found.select(*_results(found, status), *(extra if audit else []))
    return _with_text_fallback(
        filings, timeframe, make_encoder, force_loss_negative, typed_columns, nested_tables, status, audit,
        long_headers,
    )


def _results(found: DataFrame, status: bool) -> list[Column]:
    """The name, the value and, if wanted, where it is from."""
    text_value = F.col("text_value") if "text_value" in found.columns else F.lit(None)
    eps = F.coalesce("table_value", text_value, F.lit(0.0))
    if not status:
        return [F.col("filename"), eps.alias("EPS")]
    where = (
        F.when(~F.col("readable"), "undecodable")
        .when(F.col("table_value").isNotNull(), "table")
        .when(text_value.isNotNull(), "text")
        .otherwise("none")
    )
    ids = [F.col("filing_id")] if "filing_id" in found.columns else []
    return [F.col("filename"), *ids, F.when(F.col("readable"), eps).alias("EPS"), where.alias("status")]


def _filing_columns(filings: DataFrame) -> list[Column]:
    """What goes along with a filing: its name, its id if it has one, and whether it can be read."""
    ids = [F.col("filing_id")] if "filing_id" in filings.columns else []
    return [F.col("filename"), *ids, F.col("html").isNotNull().alias("readable")]


def filing_candidates(
    filings: DataFrame,
    timeframe: int = DEFAULT_TIMEFRAME,
    force_loss_negative: bool = False,
    typed_columns: bool = False,
    nested_tables: bool = False,
    short: bool = False,
) -> DataFrame:
    """``filename``, ``candidates``, the array of table candidates in document order, and ``readable``, false for bytes that are no UTF-8.

    With ``short`` the context of a candidate below a very long header is a short text in its place."""
    html = F.col("html")
    parsed = filings.select(
        *_filing_columns(filings),
        elements_of(
            F.when(html.rlike("(?i)<table"), html), tables_with=EPS_FRAGMENT, nested=nested_tables
        ).alias("parsed"),
    )
    return sections.with_candidates(
        parsed, timeframe, force_loss_negative, typed_columns=typed_columns, short=short
    )


def eps_from_grid(
    grid_rows: DataFrame,
    timeframe: int = DEFAULT_TIMEFRAME,
    block_rows: int | None = grid.BLOCK_ROWS,
    force_loss_negative: bool = False,
    typed_columns: bool = False,
) -> DataFrame:
    """``filename`` and ``EPS`` for every filing with rows in a grid held in long form.

    All rows reach the aggregate, the ones without a candidate with a null key, so that filings
    without any need no join to come back as 0.
    """
    context, reverse = F.col("context"), F.col("reverse")
    value = labels.signed(
        context, cell.parse_value(cell.value_token(F.col("cells"), reverse)), force_loss_negative
    )
    cleaned = grid.clean_cells(grid_rows)
    if typed_columns:
        cleaned = grid.retype_columns(cleaned, block_rows or grid.BLOCK_ROWS)
    return (
        cleaned
        .transform(grid.row_context, timeframe, block_rows, keep_all=True, short=True)
        .withColumn("value", F.when(labels.mentions_eps(context), value))
        .withColumn("score", _score(context, F.col("value")))
        .groupBy("filename")
        .agg(_best(rank.TABLE_ORDER).alias("value"))
        .select("filename", F.coalesce("value", F.lit(0.0)).alias("EPS"))
    )


def _with_text_fallback(
    filings, timeframe, make_encoder, force_loss_negative, typed_columns, nested_tables, status, audit,
    long_headers,
) -> DataFrame:
    """One pass over the filings: a row for each filing, with its table value, and one more for
    each sentence to encode. A single aggregate brings them together again, so neither the HTML
    nor its parse is needed twice."""
    # two filings may have one name; without an id what they hold tells them apart
    key = F.col("filing_id") if "filing_id" in filings.columns else F.xxhash64("html")
    parsed = filings.select(
        *_filing_columns(filings),
        key.alias("own_key"),
        elements_of(
            F.col("html"), with_text=True, tables_with=EPS_FRAGMENT, nested=nested_tables
        ).alias("parsed"),
    )
    kept = [c for c in parsed.columns if c != "parsed"]
    from_tables = {"table_value": sections.best_value(F.col("candidates"))}
    if audit:
        from_tables["n_unreadable"] = sections.count_unreadable(F.col("candidates"))
    rows = (
        parsed.withColumn("sentences", _sentences_to_encode(F.col("parsed")))
        .transform(
            sections.with_candidates,
            timeframe,
            force_loss_negative,
            typed_columns=typed_columns,
            short=long_headers,
        )
        .withColumns(from_tables)
        .select(*kept, *from_tables, F.explode(_filing_and_sentences()).alias("s"))
        .select(*kept, *from_tables, "s.*")
    )
    nearest = text.nearest_number(F.col("tokens"), F.col("phrase"))
    found = (
        rows.transform(text.token_vectors, make_encoder)
        .transform(text.sentence_variants, outer=True)
        .withColumn("num", F.when(F.col("phrase").isNotNull(), nearest).num)
        .withColumn("value", F.col("num").try_cast("double"))
        .withColumn("score", _score(F.col("sentence"), F.col("value")))
        .groupBy(*kept)
        .agg(
            *(F.max(name).alias(name) for name in from_tables),
            _best(rank.TEXT_ORDER).alias("text_value"),
            F.count_if(F.col("num").isNotNull() & F.col("value").isNull()).alias("n_unreadable_text"),
        )
    )
    return found.select(
        *_results(found, status), *(["n_unreadable", "n_unreadable_text"] if audit else [])
    )


def _sentences_to_encode(elements: Column) -> Column:
    """Sentences of the text elements that name the phrase and hold a dollar sign."""
    is_text = lambda e: (e.tag == "text") | (e.n_rows <= ROW_THRESHOLD)
    split = F.transform(
        F.filter(elements, is_text),
        lambda e: F.transform(
            text.split_sentences(element_text(e)),
            lambda s, i: F.struct(
                e.elem_seq.alias("elem_seq"), i.alias("sent_idx"), cell.strip(s).alias("sentence")
            ),
        ),
    )
    return F.filter(
        F.flatten(split),
        lambda s: F.contains(s.sentence, F.lit("$")) & text.mentions_any(s.sentence),
    )


def _filing_and_sentences() -> Column:
    """A null for the filing itself, then its sentences where the tables gave nothing."""
    itself = F.lit(None).cast("struct<elem_seq:int,sent_idx:int,sentence:string>")
    needed = F.when(F.col("table_value").isNull(), F.col("sentences"))
    none = F.array().cast("array<struct<elem_seq:int,sent_idx:int,sentence:string>>")
    return F.concat(F.array(itself), F.coalesce(needed, none))


def _score(context: Column, value: Column) -> Column:
    """Null where there is no value."""
    score = labels.score(
        labels.share_type(context), labels.is_adjusted(context), labels.is_net(context), value < 0
    )
    return F.when(value.isNotNull(), score)


def _best(order: tuple[str, ...]) -> Column:
    key = F.when(F.col("score").isNotNull(), rank.rank_key(order))
    return F.max_by("value", key)
