"""Parallelism of narrow plans."""

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Deal out an input that comes in fewer pieces than there are cores.

    Parsing and matching are narrow, so they run in as many tasks as the input has splits. Large
    inputs have plenty and pass through untouched, without a shuffle; a single small file is dealt
    out row by row. Streams pass through as they are.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
