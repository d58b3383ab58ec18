"""Headers by reference: short texts in place of long headers, and header runs of any length."""

import random
import time

import pytest
from pyspark.sql import functions as F

from fixtures import GRID_SCHEMA
from pershare import eps_from_grid, extract_eps
from pershare.functions import labels
from pershare.operators import grid

WORDS = ["income", "per", "share", "loss", "Earnings", "EPS", "e.p.s", "shares", "basic", "diluted", "subtotal", "paper"]
WORDS += ["non", "gaap", "G.A.A.P.", "gaaps", "un", "adjusted", "unadjusted", "glosses", "x", "\n", "\n", "incomes", "𝒳", "loſs"]
LONG = "x" * labels.SHORT_HEADER


def found(context):
    flags = [labels.mentions_eps, labels.is_basic, labels.is_diluted, labels.is_net, labels.is_adjusted]
    flags += [lambda c: labels.signed(c, F.lit(1.0), force_loss_negative=True)]
    return F.struct(*(f(context).alias(f"f{i}") for i, f in enumerate(flags)), labels.type_labels(context).alias("types"))


def test_short_header_says_the_same(spark):
    rng = random.Random(3)
    texts = lambda: " ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 7)))
    padded = lambda: (lambda t: t.replace(" ", f" {LONG} ", 1) if " " in t else t)(texts())
    rows = [(padded(), padded(), texts()) for _ in range(1500)]
    df = spark.createDataFrame(rows, "a string, b string, label string")
    whole = labels.join_context(F.concat_ws(" ", "a", "b"), F.col("label"))
    once = labels.short_header(F.concat_ws(" ", "a", "b"))
    parts = labels.short_header(F.concat_ws(" ", F.lit(LONG), labels.short_header(F.col("a")), labels.short_header(F.col("b"))))
    said = df.select(
        "a", "b", "label", found(whole).alias("want"),
        found(labels.join_context(once, F.col("label"))).alias("once"),
        found(labels.join_context(parts, F.col("label"))).alias("parts"),
        F.length(once).alias("length"),
    ).collect()
    assert sum(r.want.f0 for r in said) > 200 and sum(r.length < len(r.a) for r in said) > 400
    for r in said:
        assert r.want == r.once, (r.a, r.b, r.label)
        assert r.want == r.parts, (r.a, r.b, r.label)
        assert r.length <= labels.SHORT_HEADER


@pytest.mark.parametrize("word", ["Net loss", "Basic EPS", "income per"])
def test_long_header_runs_take_linear_time(spark, word):
    def table(heads):
        is_head = F.col("id") < heads
        label = F.when(F.col("id") == heads + 500, "per share").otherwise("for a share")
        cells = F.when(is_head, F.array(F.concat_ws(" ", F.lit(word), "id"), F.lit(""))).otherwise(
            F.array(label, F.concat("id", F.lit(".5")))
        )
        return spark.range(heads + 1000).select(
            F.lit("f").alias("filename"), F.lit(0).alias("table_seq"), F.col("id").cast("int").alias("row_idx"), cells.alias("cells")
        )

    first = {"Net loss": 500, "Basic EPS": 0, "income per": 0}[word]
    for heads in (1000, 100_000):
        start = time.monotonic()
        assert eps_from_grid(table(heads)).first().EPS == heads + first + 0.5
        assert time.monotonic() - start < 60
    assert eps_from_grid(table(1000), block_rows=None).first().EPS == 1000 + first + 0.5


def test_header_text_of_runs_across_blocks(spark):
    """Each row has the text of the whole run it belongs to, whatever the blocks."""
    rng = random.Random(8)
    rows = []
    for t, share in enumerate((0.1, 0.6, 0.95, 1.0)):
        rows += [("f", t, i, [], [f"h{i}", "" if rng.random() < share else "0.5"]) for i in range(120) if rng.random() > 0.05]
    df = spark.createDataFrame(rows, GRID_SCHEMA)

    def texts(block_rows):
        return {tuple(r) for r in grid.header_groups(df, block_rows).select("table_seq", "row_idx", "group_start", "header").collect()}

    whole = texts(None)
    assert len(whole) == len(rows)
    for block_rows in (1, 7, 50, 1000):
        assert texts(block_rows) == whole


def test_long_headers_of_a_filing(spark):
    heads = lambda n: "".join(f"<tr><td>Net loss of the year {i}" for i in range(n))
    values = lambda n: "".join(f"<tr><td>per share<td>{i}.5" for i in range(n))
    pages = {f"p{n}": f"<table>{heads(n)}{values(n)}</table>" for n in (1, 20, 100)} | {"none": "<table><tr><td>a<tr><td>EPS<td>2.5</table>"}
    filings = spark.createDataFrame(list(pages.items()), "filename string, html string")
    plain = set(map(tuple, extract_eps(filings).collect()))
    assert set(map(tuple, extract_eps(filings, long_headers=True).collect())) == plain
    assert dict(plain) == {"p1": 0.5, "p20": 0.5, "p100": 0.5, "none": 2.5}
    long = filings.limit(0).union(spark.createDataFrame([("long", f"<table>{heads(4000)}{values(4000)}</table>")], filings.schema))
    start = time.monotonic()
    assert extract_eps(long, long_headers=True).first().EPS == 0.5
    assert time.monotonic() - start < 60
