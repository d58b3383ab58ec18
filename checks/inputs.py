"""Inputs that the queries derive from the given tables: statements, documents, sentences.

Statements come from ``orders``: one row per order, a filing per customer, and a table for every
``TABLE_SPAN`` consecutive order keys, so no table is longer than that. Rows of finished orders are
headers, some of them with two years; the others carry a label and two amounts.
"""

import posixpath
import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pershare.plans.shared import shared_folder
from pershare.plans.spread import spread

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TABLE_SPAN = 8192
TIMEFRAME = 1998
SENTENCE_TOKENS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, *columns) -> DataFrame:
    """Columns of a table, dealt out if it is too small a file to keep all cores busy."""
    return spread(table(spark, sf_dir, name).select(*columns))


def amount(n: Column) -> Column:
    """``(n % 500) / 100`` with two places, in brackets for every fifth ``n``."""
    cents = n % 500
    text = F.concat(
        F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0")
    )
    return F.when(n % 5 == 0, F.concat(F.lit("("), text, F.lit(")"))).otherwise(
        F.concat(F.lit("$"), text)
    )


def statement_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a line: ``custkey``, ``k`` (the unique order key) and ``cells``."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderkey").alias("k"),
        (F.col("o_orderstatus") == "F").alias("head"),
        F.year("o_orderdate").alias("y"),
    )
    k, head, y = F.col("k"), F.col("head"), F.col("y")
    head_label = F.when(k % 2 == 0, "Earnings per share").otherwise("Balance sheet")
    label = (
        F.when(k % 3 == 0, "Basic, net")
        .when(k % 3 == 1, "Diluted")
        .otherwise("Adjusted EPS (non-GAAP)")
    )
    other_year = F.when(k % 8 == 0, y + 1).otherwise(y - 1)
    years = head & (k % 4 == 0)
    return orders.select(
        "custkey",
        "k",
        F.array(
            F.when(head, head_label).otherwise(label),
            F.when(years, y.cast("string")).when(head, "").otherwise(amount(k)),
            F.when(years, other_year.cast("string"))
            .when(head | (k % 7 == 0), "")
            .otherwise(amount(k * 3 + 11)),
        ).alias("cells"),
    )


def statement_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statements as grid rows, numbered from 1 within their table."""
    in_table = Window.partitionBy("filename", "table_seq").orderBy("k")
    return (
        statement_lines(spark, sf_dir)
        .select(
            F.concat(F.lit("cust-"), F.col("custkey").cast("string")).alias("filename"),
            F.floor(F.col("k") / TABLE_SPAN).cast("int").alias("table_seq"),
            "k",
            "cells",
        )
        .withColumn("row_idx", F.row_number().over(in_table))
        .select("filename", "table_seq", "row_idx", "cells")
    )


def number_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statements with a first column of bare numbers: by customer whole ones, with gaps, with decimals, with words, or truth values."""
    in_table = Window.partitionBy("filename", "table_seq").orderBy("k")
    k, t = F.col("k"), F.col("custkey") % 5
    whole = (k % 4000).cast("string")
    cents = F.concat(F.floor(k % 500 / 100).cast("string"), F.lit("."), F.lpad((k % 100).cast("string"), 2, "0"))
    first = (
        F.when(t == 0, whole)
        .when(t == 1, F.when(k % 3 == 0, "").otherwise(whole))
        .when(t == 2, F.when(k % 2 == 0, cents).otherwise(whole))
        .when(t == 3, F.when(k % 5 == 0, "see note").otherwise(cents))
        .otherwise(F.when(k % 2 == 0, "true").otherwise("FALSE"))
    )
    return (
        statement_lines(spark, sf_dir)
        .select(
            F.concat(F.lit("cust-"), F.col("custkey").cast("string")).alias("filename"),
            F.floor(k / TABLE_SPAN).cast("int").alias("table_seq"),
            "k",
            F.array(F.col("cells")[0], first, F.col("cells")[2]).alias("cells"),
        )
        .withColumn("row_idx", F.row_number().over(in_table))
        .select("filename", "table_seq", "row_idx", "cells")
    )


def long_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines as a single table."""
    return statement_lines(spark, sf_dir).select(
        F.lit("all").alias("filename"),
        F.lit(0).alias("table_seq"),
        F.col("k").alias("row_idx"),
        "cells",
    )


def padded_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statements with missing cells, white space, empty columns and empty rows."""
    label, first, second = (F.col("cells")[i] for i in range(3))
    padded = F.array(
        F.concat(F.lit("  "), label),
        F.lit(None).cast("string"),
        F.concat(first, F.lit("\t ")),
        F.lit(" "),
        second,
    )
    empty = F.array(F.lit(None).cast("string"), *(F.lit(" ") for _ in range(4)))
    return statement_grid(spark, sf_dir).withColumn(
        "cells", F.when(F.col("row_idx") % 4 == 0, empty).otherwise(padded)
    )


def documents(spark: SparkSession, sf_dir: str, grid=statement_grid) -> DataFrame:
    """Every statement table as an HTML filing, with open cells, inline tags and references."""
    label, first, second = (F.col("cells")[i] for i in range(3))
    row = F.concat(
        F.lit("<tr class='a>b'><td><font size=\"1\">"),
        label,
        F.lit("</font></td><td>"),
        F.when(first == "", "&nbsp;").otherwise(first),
        F.lit("<TD align=right> "),
        F.regexp_replace(second, r"\.", "&#46;"),
        F.lit("</tr>\n"),
    )
    rows = F.sort_array(F.collect_list(F.struct("row_idx", row.alias("row"))))
    return (
        grid(spark, sf_dir)
        .groupBy("filename", "table_seq")
        .agg(F.array_join(F.transform(rows, lambda r: r.row), "").alias("rows"))
        .select(
            F.concat("filename", F.lit("-"), "table_seq", F.lit(".html")).alias("filename"),
            F.concat(
                F.lit("<html><head><title>8-K</title></head><body><p>Report &amp; results<table>"),
                F.col("rows"),
                F.lit("</table><!-- <table> --><div>End</div></body></html>"),
            ).alias("html"),
        )
    )


def layout_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same filings laid out by tables: the statement in a cell, below a table that lacks its closing tag."""
    pages = documents(spark, sf_dir)
    opening = "<table><tr><td>Contents<td>1.00</td></tr><tr><td>EPS</td></tr><p>Our year</p>"
    layout = "<TABLE><tr><td>Menu</td><td>Results<table>"
    framed = F.regexp_replace("html", "<table>", opening + layout)
    closing = "</table>as filed</td></tr><tr><td>Foot<td>Page 2</table>"
    return pages.withColumn("html", F.regexp_replace(framed, "</table><!--.*?-->", closing))


def price_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``k`` and ``words``: the tokens of a sentence about prices, one per order."""
    k = F.col("o_orderkey")
    part = lambda n, m: ((k * n) % m).cast("string")
    return spread_table(spark, sf_dir, "orders", "o_orderkey").select(
        k.alias("k"),
        F.array(
            *(F.lit(w) for w in ("EPS", "of", "$")), part(1, 13), F.lit("."), part(7, 100),
            *(F.lit(w) for w in ("up", "from", "$")), part(3, 9), F.lit(","), part(11, 1000),
            F.lit("."), part(5, 10),
            F.lit("$"), part(2, 50), F.lit("percent"), F.lit("$"),
            F.concat(part(1, 7), F.lit("."), part(1, 3)), part(1, 4),
            F.lit("and"), F.lit("$"),
        ).alias("words"),
    )


def vector_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences whose token vectors are ``SENTENCE_TOKENS`` consecutive embeddings each."""
    place = F.col("vec_id") % SENTENCE_TOKENS
    label = F.col("label").cast("string")
    words = ["EPS", "of", "$", None, ".", "5", "or", "$", None, ".25", "eps", "$", "3", "x", "$"]
    word = F.when(F.lit(False), "")
    for i, text in enumerate(words):
        word = word.when(place == i, label if text is None else F.lit(text))
    tokens = F.sort_array(
        F.collect_list(
            F.struct(
                place.alias("place"),
                word.otherwise("1.5").alias("tok"),
                F.col("embedding").alias("vec"),
            )
        )
    )
    return (
        table(spark, sf_dir, "embeddings")
        .groupBy(F.floor(F.col("vec_id") / SENTENCE_TOKENS).alias("sid"))
        .agg(F.transform(tokens, lambda t: F.struct(t.tok, t.vec)).alias("tokens"))
        .select(
            F.concat(F.lit("s-"), F.col("sid").cast("string")).alias("filename"),
            F.lit(0).alias("elem_seq"),
            F.lit(0).alias("sent_idx"),
            F.lit(0).alias("variant_idx"),
            F.lit("eps").alias("phrase"),
            F.when(F.col("sid") % 3 == 0, "Basic EPS")
            .when(F.col("sid") % 3 == 1, "Diluted non-GAAP EPS")
            .otherwise("Total EPS")
            .alias("sentence"),
            "tokens",
        )
    )


def news_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filing per order: some with a table that answers, the others with prose only."""
    k = F.col("o_orderkey")
    price = F.concat((k % 9).cast("string"), F.lit("."), F.lpad((k % 100).cast("string"), 2, "0"))
    rows = F.concat(
        F.lit("<table><tr><td>Diluted EPS<td>"),
        amount(k),
        F.when(k % 4 == 0, "<tr><td>End</table>").otherwise("</table>"),
    )
    return spread_table(spark, sf_dir, "orders", "o_orderkey").select(
        F.concat(F.lit("news-"), k.cast("string"), F.lit(".html")).alias("filename"),
        F.concat(
            F.lit("<p>Revenue of $9.99 rose. Profit fell.</p>"),
            F.when(k % 2 == 0, rows).otherwise(""),
            F.when(
                k % 3 != 0,
                F.concat(
                    F.lit("<div>Sales, Inc. had revenue of $3 and <b>basic EPS</b> of $"),
                    price,
                    F.lit(", up from $1.25 before. All fine.</div>"),
                ),
            ).otherwise("<div>No EPS was named.</div>"),
        ).alias("html"),
    )


def rejected_numbers(html: Column, k: Column) -> Column:
    """News with numbers that cannot be read: a dash parted from its number in a table, a point behind one in a sentence."""
    row = F.replace(html, F.lit("<tr><td>End"), F.lit("<tr><td>Basic EPS<td>- 0.05<tr><td>End"))
    said = F.concat(F.lit("<p>Diluted EPS came to $"), (k % 9).cast("string"), F.lit(".25.</p>"))
    return F.concat(row, F.when(k % 7 == 0, said).otherwise(""))


def spoilt(html: Column, n: Column) -> Column:
    """The bytes of a filing, for every eleventh ``n`` not all UTF-8; null for every thirteenth."""
    broken = F.concat(F.encode(html, "utf-8"), F.unhex(F.lit("C328FF")))
    return F.when(n % 13 != 0, F.when(n % 11 == 0, broken).otherwise(F.encode(html, "utf-8")))


def near_first_encoder():
    """A stand-in for a language model: words as tokens, dollar signs less alike the later."""
    import re

    word = re.compile(r"[A-Za-z.]*[A-Za-z]|\d+|\S")

    def encode(sentences):
        out = []
        for sentence in sentences:
            tokens = word.findall(sentence.lower())
            vectors = [[1.0, 0.0 if t != "$" else 0.01 * i] for i, t in enumerate(tokens)]
            out.append((tokens, vectors))
        return out

    return encode


def work_folder(spark: SparkSession) -> str:
    """A new folder in the place the cluster shares."""
    return posixpath.join(shared_folder(spark), uuid.uuid4().hex)


def write_files(files: DataFrame, folder: str) -> None:
    """Write ``html`` to a file called ``filename`` for every row; a retry writes the same again."""

    def write(rows):
        from pyarrow import fs

        uri = folder if "://" in folder or folder.startswith("file:") else "file://" + folder
        filesystem, root = fs.FileSystem.from_uri(uri)
        filesystem.create_dir(root, recursive=True)
        for row in rows:
            with filesystem.open_output_stream(f"{root}/{row.filename}") as out:
                out.write(row.html.encode("utf-8"))

    files.select("filename", "html").foreachPartition(write)
