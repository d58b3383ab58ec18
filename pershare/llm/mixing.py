"""Mixing documents to target weights by iterative proportional fitting, with DataFrame functions only.

Tokens are summed for each cell (one combination of the values of all margins). The cells' weights are then scaled to the
targets of one margin after the other, ``rounds`` times. A document is kept with the probability that brings its cell's
tokens to the cell's weight: ``min(1, c * weight / tokens)``, where ``c`` is calibrated (``CAPS`` times) so that a ``share`` of all
tokens is expected to stay although no probability is above 1. The draw is a hash of the document's id, so it is the
same in every run.

A value's target is given, or by default its tokens to the power ``temper``; targets are scaled to sum to all tokens.
Values without a given target get none of the tokens.

Rules. A null in a margin is a value of its own. Words are what stands between ``[\\x20\\x09-\\x0D]``; null and empty texts have 0
tokens and are kept as their cell is, with probability 0 if the cell has no tokens. Rows that repeat share their draw; a
null id is drawn as an empty one. The cells are joined to the documents by a broadcast if there are at most ``FEW`` of them,
otherwise by a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, stored

CAPS = 3
FEW = 50_000
#: The pattern of white space between words.
SPACES = r"[\x20\x09-\x0D]+"


def n_words(text: Column | str) -> Column:
    """Number of words of a text, with no list of them."""
    trimmed = F.btrim(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.length(trimmed) == 0, F.lit(0)).otherwise(F.size(F.split(trimmed, SPACES))).cast("long")


def raked(cells: DataFrame, margins: list[str], rounds: int, temper: float, targets: Mapping[str, DataFrame]) -> DataFrame:
    """``cells`` (margins, tokens) with weight."""
    names = [f"target_{i}" for i in range(len(margins))]
    out = cells
    total = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0)).cast("double")).first()[0]
    for name, margin in zip(names, margins):
        own = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("t"))
        if margin in targets:
            given = targets[margin].toDF("value", "target")
            own = own.join(given, own[margin].eqNullSafe(given["value"]), "left").select(margin, F.coalesce("target", F.lit(0.0)).alias(name))
        else:
            own = own.select(margin, F.pow("t", F.lit(temper)).alias(name))
        whole = own.agg(F.sum(name)).first()[0] or 1.0
        own = own.withColumn(name, F.col(name) / F.lit(whole) * F.lit(total)).withColumnRenamed(margin, "value")
        out = out.join(own, out[margin].eqNullSafe(own["value"]), "left").drop("value")
    out = stored(out.withColumn("weight", F.col("tokens").cast("double")), "weights")
    for _ in range(rounds):
        for name, margin in zip(names, margins):
            held = F.sum("weight").over(Window.partitionBy(margin))
            out = out.withColumn("weight", F.when(held > 0, F.col("weight") * F.col(name) / held).otherwise(F.col("weight")))
        out = stored(out, "weights")
    return out.drop(*names)


def draw(key: str) -> Column:
    """A number from 0 to 1 that belongs to the id."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def probabilities(docs: DataFrame, margins: list[str], share: float = 0.5, rounds: int = 8, temper: float = 0.5, targets: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """``docs`` (doc_id, text, margins) with n_tokens and keep_probability."""
    tokens, keep = free_name(docs, "n_tokens"), free_name(docs, "keep_probability")
    counted = docs.withColumn(tokens, n_words("text"))
    own = [f"margin_{i}" for i in range(len(margins))]
    cells = counted.groupBy(*(F.col(m).cast("string").alias(o) for m, o in zip(margins, own))).agg(F.sum(tokens).alias("tokens"))
    cells = raked(stored(cells, "cells"), own, rounds, temper, {o: (targets or {})[m] for m, o in zip(margins, own) if m in (targets or {})})
    cells = cells.withColumn("ratio", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(F.lit(0.0)))
    facts = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.count("*")).first()
    wanted, c = share * facts[0], share
    for _ in range(CAPS):
        reached = cells.agg(F.coalesce(F.sum(F.least(F.lit(1.0), F.lit(c) * F.col("ratio")) * F.col("tokens")), F.lit(0.0))).first()[0]
        c = c * wanted / reached if reached > 0 else c
    cells = cells.select(*own, F.least(F.lit(1.0), F.lit(c) * F.col("ratio")).alias(keep))
    met = reduce(lambda a, b: a & b, (counted[m].cast("string").eqNullSafe(cells[o]) for m, o in zip(margins, own)))
    return counted.join(F.broadcast(cells) if facts[1] <= FEW else cells, met, "left").drop(*own)


def mixed_sample(docs: DataFrame, margins: list[str], **how) -> DataFrame:
    """The documents drawn, with n_tokens and keep_probability."""
    keep = free_name(docs, "keep_probability")
    return probabilities(docs, margins, **how).where(draw("doc_id") < F.col(keep))


def topic(text: str = "text") -> Column:
    """Topic of a document by what stands in it: the first of a few marks that fits."""
    found = F.coalesce(F.col(text), F.lit(""))
    rules = (("legal", "licensed under"), ("table", " | "), ("noise", "$$$"), ("shouting", "!! "), ("list", "\n- "))
    out = F.lit("prose")
    for name, mark in reversed(rules):
        out = F.when(F.contains(found, F.lit(mark)), F.lit(name)).otherwise(out)
    return out
