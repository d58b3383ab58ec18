"""One query per operator. Arrays are shown as joined text and row numbers as long integers, so
that results compare by plain values; adding 0.0 turns a negative zero into zero."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs
from checks.inputs import TIMEFRAME
from pershare import eps_from_grid, extract_eps
from pershare.operators import elements, evaluate, grid, match, rank, text
from pershare.sources import filings, results
from pershare.streaming.arrivals import stream_eps

GRID_ROW = ["filename", "table_seq", "row_idx"]
PAGE_PHRASES = ("the", "of the", "is on")


def shown(df: DataFrame, *columns) -> DataFrame:
    """Selected columns, integers widened and arrays joined."""
    selected = df.select(*columns)
    kinds = dict(selected.dtypes)
    return selected.select(*(_plain(F.col(c), kinds[c]).alias(c) for c in selected.columns))


def _plain(column: Column, kind: str) -> Column:
    if kind == "int":
        return column.cast("long")
    if kind == "double":
        return F.round(column + 0.0, 4)
    if kind == "array<string>":
        return F.array_join(F.transform(column, lambda c: F.coalesce(c, F.lit("?"))), "|")
    return column


def _context(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Statement tables are short by construction, so no block hand-over is planned.
    return inputs.statement_grid(spark, sf_dir).transform(grid.row_context, TIMEFRAME, None)


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _context(spark, sf_dir).transform(match.candidates)


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir).transform(rank.scores)


def _filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = F.col("o_custkey").cast("string")
    return (
        inputs.table(spark, sf_dir, "orders")
        .select(F.concat(F.lit("cust-"), customer).alias("filename"))
        .distinct()
    )


def _eps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eps_from_grid(inputs.statement_grid(spark, sf_dir), TIMEFRAME, block_rows=None)


def eps_final(spark, sf_dir):
    return shown(_eps(spark, sf_dir), "filename", "EPS")


def eps_from_html(spark, sf_dir):
    return shown(extract_eps(inputs.documents(spark, sf_dir), TIMEFRAME), "filename", "EPS")


def eps_with_text(spark, sf_dir):
    news = inputs.news_filings(spark, sf_dir)
    return shown(extract_eps(news, TIMEFRAME, inputs.near_first_encoder), "filename", "EPS")


def eps_audit(spark, sf_dir):
    """Numbers that could not be read, by filing, from tables and from text."""
    order = F.regexp_extract("filename", r"\d+", 0).cast("long")
    news = inputs.news_filings(spark, sf_dir).withColumn("html", inputs.rejected_numbers(F.col("html"), order))
    found = extract_eps(news, TIMEFRAME, inputs.near_first_encoder, audit=True)
    return shown(found, "filename", "EPS", "n_unreadable", "n_unreadable_text")


def eps_status(spark, sf_dir):
    """Every filing once, bytes that are no UTF-8 included."""
    pages = inputs.documents(spark, sf_dir)
    customer = F.regexp_extract("filename", r"\d+", 0).cast("long")
    held = filings.packed_filings(pages, F.col("filename"), inputs.spoilt(F.col("html"), customer))
    return shown(extract_eps(held, TIMEFRAME, status=True), "filename", "EPS", "status")


def _same_names(spark, sf_dir):
    """The news under two names in all, told apart by where they are from."""
    news = inputs.news_filings(spark, sf_dir)
    order = F.regexp_extract("filename", r"\d+", 0).cast("long")
    name = F.concat(F.lit("q"), (order % 2).cast("string"), F.lit(".html"))
    held = inputs.spoilt(F.col("html"), order)
    return filings.packed_filings(news, name, held, F.concat(F.lit("in/"), F.col("filename")))


def eps_same_names(spark, sf_dir):
    found = extract_eps(_same_names(spark, sf_dir), TIMEFRAME, inputs.near_first_encoder, status=True)
    return shown(found, "filename", "EPS", "status")


def eps_same_names_tables(spark, sf_dir):
    return shown(extract_eps(_same_names(spark, sf_dir), TIMEFRAME, status=True), "filename", "EPS", "status")


def grid_from_html(spark, sf_dir):
    parsed = elements.elements(inputs.documents(spark, sf_dir), with_text=False)
    return shown(elements.grid_rows(parsed), "filename", "row_idx", "cells")


def table_elements(spark, sf_dir):
    parsed = elements.elements(inputs.documents(spark, sf_dir))
    return shown(elements.of_kind(parsed, "table"), "filename", "elem_seq", "n_rows")


def nested_grid(spark, sf_dir):
    """Rows of all tables of filings laid out by tables; the statement is the third."""
    parsed = elements.elements(inputs.layout_documents(spark, sf_dir), with_text=False, nested=True)
    return shown(elements.grid_rows(parsed), "filename", "table_seq", "row_idx", "cells")


def eps_from_layout(spark, sf_dir):
    pages = inputs.layout_documents(spark, sf_dir)
    return shown(extract_eps(pages, TIMEFRAME, nested_tables=True), "filename", "EPS")


def page_text_elements(spark, sf_dir):
    pages = filings.packed_filings(
        inputs.spread_table(spark, sf_dir, "pages", "page_id", "html"),
        F.col("page_id").cast("string"),
        F.col("html"),
    )
    parsed = elements.elements(pages)
    return shown(elements.of_kind(parsed, "text"), "filename", "elem_seq", "text")


def clean_cells(spark, sf_dir):
    cleaned = grid.clean_cells(inputs.padded_grid(spark, sf_dir))
    return shown(cleaned, *GRID_ROW, "cells")


def drop_empty_rows(spark, sf_dir):
    cleaned = grid.clean_cells(inputs.padded_grid(spark, sf_dir))
    return shown(grid.drop_empty_rows(cleaned), *GRID_ROW, "cells")


def drop_empty_columns(spark, sf_dir):
    cleaned = grid.clean_cells(inputs.padded_grid(spark, sf_dir))
    return shown(grid.drop_empty_columns(cleaned), *GRID_ROW, "cells")


def column_types(spark, sf_dir):
    found = grid.column_types(inputs.number_grid(spark, sf_dir))
    return shown(found, "filename", "table_seq", "col_idx", "type", "last_row")


def retyped_columns(spark, sf_dir):
    return shown(grid.retype_columns(inputs.number_grid(spark, sf_dir)), *GRID_ROW, "cells")


def eps_typed_columns(spark, sf_dir):
    """The values of statements whose first column is typed as a whole, blocks handing on what they know."""
    rows = inputs.number_grid(spark, sf_dir)
    return shown(eps_from_grid(rows, TIMEFRAME, block_rows=1024, typed_columns=True), "filename", "EPS")


def eps_typed_html(spark, sf_dir):
    pages = inputs.documents(spark, sf_dir, inputs.number_grid)
    return shown(extract_eps(pages, TIMEFRAME, typed_columns=True), "filename", "EPS")


def row_labels(spark, sf_dir):
    padded = grid.clean_cells(inputs.padded_grid(spark, sf_dir))
    return shown(grid.row_labels(padded), *GRID_ROW, "label")


def header_rows(spark, sf_dir):
    return shown(grid.header_rows(inputs.statement_grid(spark, sf_dir)), *GRID_ROW, "is_header")


def year_order(spark, sf_dir):
    ordered = grid.year_order(inputs.statement_grid(spark, sf_dir), TIMEFRAME, None)
    return shown(ordered, *GRID_ROW, "reverse")


def header_groups(spark, sf_dir):
    grouped = grid.header_groups(inputs.statement_grid(spark, sf_dir), None)
    return shown(grouped, *GRID_ROW, "is_header", "group_start", "header")


def row_context(spark, sf_dir):
    return shown(_context(spark, sf_dir), *GRID_ROW, "context", "reverse")


def long_table_context(spark, sf_dir):
    """All orders as one table, cut into blocks: the hottest table there can be."""
    rows = inputs.long_table(spark, sf_dir).transform(grid.row_context, TIMEFRAME, 1024)
    return shown(rows, *GRID_ROW, "context", "reverse")


def eps_rows(spark, sf_dir):
    return shown(match.eps_rows(_context(spark, sf_dir)), *GRID_ROW, "context")


def row_values(spark, sf_dir):
    return shown(match.row_values(_context(spark, sf_dir)), *GRID_ROW, "token")


def signed_values(spark, sf_dir):
    valued = _context(spark, sf_dir).transform(match.row_values).transform(match.signed_values)
    return shown(valued, *GRID_ROW, "value", "is_loss")


def eps_types(spark, sf_dir):
    return shown(match.type_labels(_context(spark, sf_dir)), *GRID_ROW, "labels")


def candidates(spark, sf_dir):
    fields = ["source", "value", "type", "is_adjusted", "is_loss", "is_net", "context"]
    return shown(_candidates(spark, sf_dir), *GRID_ROW, *fields)


def scores(spark, sf_dir):
    return shown(_scores(spark, sf_dir), *GRID_ROW, "score")


def top_candidate(spark, sf_dir):
    return shown(rank.top_candidate(_scores(spark, sf_dir)), "filename", "value")


def top_candidate_rows(spark, sf_dir):
    best = rank.top_candidate_rows(_scores(spark, sf_dir))
    return shown(best, *GRID_ROW, "value", "type", "score", "context")


def default_zero(spark, sf_dir):
    winners = rank.top_candidate(_scores(spark, sf_dir))
    return shown(rank.default_zero(_filings(spark, sf_dir), winners), "filename", "EPS")


def fallback(spark, sf_dir):
    """Table results of two customers in three, text results of two in five."""
    customer = F.regexp_extract("filename", r"\d+", 0).cast("long")
    by_table = rank.top_candidate(_scores(spark, sf_dir)).filter(customer % 3 != 0)
    key = F.col("o_orderkey")
    in_text = inputs.table(spark, sf_dir, "orders").filter(F.col("o_custkey") % 5 < 2)
    by_text = in_text.select(
        F.concat(F.lit("cust-"), F.col("o_custkey").cast("string")).alias("filename"),
        key.alias("elem_seq"),
        (key % 4).alias("sent_idx"),
        F.lit(0).alias("variant_idx"),
        F.col("o_totalprice").alias("value"),
        F.when(key % 2 == 0, "basic").otherwise("diluted").alias("type"),
        (key % 3 == 0).alias("is_adjusted"),
        F.lit(False).alias("is_loss"),
        (key % 5 == 0).alias("is_net"),
    )
    by_text = by_text.transform(rank.scores).transform(rank.top_candidate, rank.TEXT_ORDER)
    return shown(rank.fallback(_filings(spark, sf_dir), by_table, by_text), "filename", "EPS")


def _sentences(spark, sf_dir):
    return text.sentences(inputs.spread_table(spark, sf_dir, "documents", "doc_id", "text"))


def sentences(spark, sf_dir):
    return shown(_sentences(spark, sf_dir), "doc_id", "sent_idx", "sentence")


def sentence_variants(spark, sf_dir):
    found = text.sentence_variants(_sentences(spark, sf_dir), PAGE_PHRASES)
    return shown(found, "doc_id", "sent_idx", "variant_idx", "phrase")


def _word_tokens(words: Column) -> Column:
    no_vector = F.lit(None).cast("array<float>")
    return F.transform(words, lambda w: F.struct(w.alias("tok"), no_vector.alias("vec")))


def dollar_numbers(spark, sf_dir):
    tokens = inputs.price_tokens(spark, sf_dir).withColumn("tokens", _word_tokens(F.col("words")))
    found = tokens.select("k", F.inline(text.dollar_numbers(F.col("tokens"))))
    return shown(found, "k", "num", "tok_idx")


def anchor_tokens(spark, sf_dir):
    words = F.split("text", " ")
    anchors = text.anchor_tokens(_word_tokens(words), F.lit("loss per share the"))
    found = inputs.spread_table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", F.transform(anchors, lambda t: t.tok).alias("anchors")
    )
    return shown(found, "doc_id", "anchors")


def anchor_vectors(spark, sf_dir):
    vector = text.anchor_vector(F.col("tokens"), F.col("phrase"))
    means = inputs.vector_sentences(spark, sf_dir).select(
        "filename", F.posexplode(vector).alias("dim", "mean")
    )
    return shown(means, "filename", "dim", "mean")


def _nearest(spark, sf_dir):
    return text.nearest_numbers(inputs.vector_sentences(spark, sf_dir), threshold=0.0)


def nearest_number(spark, sf_dir):
    return shown(_nearest(spark, sf_dir), "filename", "num", "tok_idx", "sim")


def text_candidates(spark, sf_dir):
    found = text.text_candidates(_nearest(spark, sf_dir))
    fields = ["source", "value", "type", "is_adjusted", "is_loss", "is_net", "context"]
    return shown(found, "filename", *fields)


def accuracy(spark, sf_dir):
    """The results against themselves with one in ten changed, one in seven lost, some unknown."""
    eps = _eps(spark, sf_dir)
    customer = F.regexp_extract("filename", r"\d+", 0).cast("long")
    truth = (
        eps.filter(customer % 7 != 0)
        .withColumn("EPS", F.when(customer % 10 == 0, F.col("EPS") + 1).otherwise(F.col("EPS")))
        .withColumn(
            "filename",
            F.when(customer % 11 == 0, F.concat("filename", F.lit("-x"))).otherwise(
                F.col("filename")
            ),
        )
    )
    return shown(evaluate.accuracy(eps, truth), "*")


def scan_filings(spark, sf_dir):
    folder = inputs.work_folder(spark)
    page_files = inputs.table(spark, sf_dir, "pages").select(
        F.concat(F.lit("page "), F.col("page_id").cast("string"), F.lit(".html")).alias("filename"),
        "html",
    )
    inputs.write_files(page_files, folder)
    scanned = filings.read_filings(spark, folder)
    return shown(scanned.withColumn("n_chars", F.length("html")), "filename", "n_chars")


def write_results(spark, sf_dir):
    folder = inputs.work_folder(spark)
    results.write_results(_eps(spark, sf_dir), folder, "csv")
    return shown(results.read_results(spark, folder), "filename", "EPS")


def stream_filings(spark, sf_dir):
    """Packed filings read as a stream until all are done, then what the sink holds."""
    folder = inputs.work_folder(spark)
    inputs.documents(spark, sf_dir).write.parquet(f"{folder}/in")
    schema = spark.read.parquet(f"{folder}/in").schema
    arriving = spark.readStream.schema(schema).parquet(f"{folder}/in")
    arriving = filings.packed_filings(arriving, F.col("filename"), F.col("html"))
    query = stream_eps(arriving, f"{folder}/out", f"{folder}/state", TIMEFRAME)
    query.awaitTermination()
    return shown(results.read_results(spark, f"{folder}/out", "parquet"), "filename", "EPS")


QUERIES = {
    f.__name__: f
    for f in (
        eps_final, eps_from_html, eps_with_text, grid_from_html, table_elements,
        nested_grid, eps_from_layout, eps_audit, eps_status, eps_same_names, eps_same_names_tables,
        page_text_elements, clean_cells, drop_empty_rows, drop_empty_columns, column_types,
        retyped_columns, eps_typed_columns, eps_typed_html, row_labels,
        header_rows, year_order, header_groups, row_context, long_table_context, eps_rows,
        row_values, signed_values, eps_types, candidates, scores, top_candidate,
        top_candidate_rows, default_zero, fallback, sentences, sentence_variants, dollar_numbers,
        anchor_tokens, anchor_vectors, nearest_number, text_candidates, accuracy, scan_filings,
        write_results, stream_filings,
    )
}
