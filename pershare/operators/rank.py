"""Scores, the best candidate per filing, and what stands in where there is none."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pershare.functions import labels

TABLE_ORDER = ("table_seq", "row_idx")
TEXT_ORDER = ("elem_seq", "sent_idx", "variant_idx")


def scores(candidates: DataFrame) -> DataFrame:
    return candidates.withColumn(
        "score",
        labels.score(F.col("type"), F.col("is_adjusted"), F.col("is_net"), F.col("is_loss")),
    )


def rank_key(order: tuple[str, ...]) -> Column:
    """Greatest for the highest score, and among equals for the first in document order."""
    return F.struct(F.col("score"), *(-F.col(name) for name in order))


def top_candidate(scored: DataFrame, order: tuple[str, ...] = TABLE_ORDER) -> DataFrame:
    """``value`` of the best candidate per filing, as a partial and a final aggregate."""
    return scored.groupBy("filename").agg(F.max_by("value", rank_key(order)).alias("value"))


def top_candidate_rows(scored: DataFrame, order: tuple[str, ...] = TABLE_ORDER) -> DataFrame:
    """The whole best candidate per filing.

    The row travels through the aggregate as one struct, so a filing with very many candidates
    is reduced before the shuffle.
    """
    row = F.struct(*(F.col(c) for c in scored.columns if c != "filename"))
    best = scored.groupBy("filename").agg(F.max_by(row, rank_key(order)).alias("best"))
    return best.select("filename", "best.*")


def default_zero(filings: DataFrame, winners: DataFrame) -> DataFrame:
    """One row per filing: its best value, or 0."""
    return (
        filings.select("filename")
        .join(winners, "filename", "left")
        .select("filename", F.coalesce("value", F.lit(0.0)).alias("EPS"))
    )


def fallback(filings: DataFrame, table_winners: DataFrame, text_winners: DataFrame) -> DataFrame:
    """The table result where there is one, else the text result, else 0."""
    by_table = table_winners.select("filename", F.col("value").alias("table_value"))
    by_text = text_winners.select("filename", F.col("value").alias("text_value"))
    return (
        filings.select("filename")
        .join(by_table, "filename", "left")
        .join(by_text, "filename", "left")
        .select(
            "filename", F.coalesce("table_value", "text_value", F.lit(0.0)).alias("EPS")
        )
    )
