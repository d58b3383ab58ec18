"""Result files with header ``filename,EPS``."""

from pyspark.sql import DataFrame, SparkSession

RESULT_SCHEMA = "filename string, EPS double"


def write_results(results: DataFrame, folder: str, fmt: str = "parquet") -> None:
    """Write one file per partition; ``csv`` has a header line and CRLF line ends."""
    writer = results.select("filename", "EPS").write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True).option("lineSep", "\r\n")
    writer.format(fmt).save(folder)


def read_results(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Results or labels; blank lines are skipped and either line end is accepted."""
    reader = spark.read.schema(RESULT_SCHEMA)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)
