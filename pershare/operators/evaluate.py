"""Results against labels."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compare(results: DataFrame, truth: DataFrame) -> DataFrame:
    """One row per filing of either side: both values, who has it, and whether they agree."""
    ours = results.select("filename", F.col("EPS").alias("EPS"), F.lit(True).alias("in_results"))
    theirs = truth.select("filename", F.col("EPS").alias("true_EPS"), F.lit(True).alias("in_truth"))
    return (
        ours.join(theirs, "filename", "full_outer")
        .na.fill(False, ["in_results", "in_truth"])
        .withColumn(
            "equal",
            F.col("in_results") & F.col("in_truth") & F.col("EPS").eqNullSafe(F.col("true_EPS")),
        )
    )


def mismatches(results: DataFrame, truth: DataFrame) -> DataFrame:
    return compare(results, truth).filter(~F.col("equal"))


def accuracy(results: DataFrame, truth: DataFrame) -> DataFrame:
    """Share of equal values over all filings of either side, and the counts behind it."""
    return compare(results, truth).agg(
        F.count("*").alias("n_filings"),
        F.count_if("equal").alias("n_equal"),
        F.count_if(~F.col("in_results")).alias("n_missing"),
        F.count_if(~F.col("in_truth")).alias("n_extra"),
        F.avg(F.col("equal").cast("double")).alias("accuracy"),
    )
