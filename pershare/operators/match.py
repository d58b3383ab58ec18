"""From value rows with context to candidates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pershare.functions import cells as cell
from pershare.functions import labels


def eps_rows(rows: DataFrame) -> DataFrame:
    """Rows whose context holds one of the phrases."""
    return rows.filter(labels.mentions_eps(F.col("context")))


def row_values(rows: DataFrame) -> DataFrame:
    """``token``: the first signed number of the row in scan direction; rows without one go."""
    return rows.withColumn(
        "token", cell.value_token(F.col("cells"), F.col("reverse"))
    ).filter(F.col("token").isNotNull())


def signed_values(rows: DataFrame) -> DataFrame:
    """``value`` and ``is_loss``; a token that is no number gives null."""
    value = cell.parse_value(F.col("token"))
    return rows.withColumn("value", value).withColumn("is_loss", F.col("value") < 0)


def type_labels(rows: DataFrame) -> DataFrame:
    return rows.withColumn("labels", labels.type_labels(F.col("context")))


def candidates(rows: DataFrame, keep_rejects: bool = False) -> DataFrame:
    """One candidate per matching row, from rows with ``cells``, ``context`` and ``reverse``.

    Rows whose number cannot be read are no candidates; with ``keep_rejects`` they stay, with a
    null value, so that they can be counted.
    """
    valued = rows.transform(eps_rows).transform(row_values).transform(signed_values)
    if not keep_rejects:
        valued = valued.filter(F.col("value").isNotNull())
    return valued.select(
        "filename",
        F.lit("table").alias("source"),
        "table_seq",
        "row_idx",
        *labels.candidate_fields(F.col("context"), F.col("value"), F.col("is_loss")),
    )
