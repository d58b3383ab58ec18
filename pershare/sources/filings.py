"""Readers of filings: ``filename``, ``html``, ``mtime`` and ``filing_id``, one row per filing.

``filing_id`` tells filings apart that have the same bare name: it is made of the path and the bytes.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def read_filings(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``*.html`` file directly in the folder, whole.

    ``html`` is null where the file is no valid UTF-8; see ``undecodable``. Small files share
    tasks up to ``spark.sql.files.maxPartitionBytes``.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.html").load(folder)
    return _as_filings(files)


def stream_filings(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """The same as a stream over files as they arrive; ``max_files`` bounds one trigger."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("pathGlobFilter", "*.html")
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _as_filings(reader.load(folder))


def packed_filings(
    table: DataFrame, filename: Column, html: Column, path: Column | None = None
) -> DataFrame:
    """Filings held as rows of a table, batch or stream: far cheaper to list than single files.

    ``html`` may be bytes: those that are no valid UTF-8 become null. With ``path``, which names where a filing is from,
    filings get an id.
    """
    packed = table.select(
        filename.alias("filename"),
        F.try_validate_utf8(html.cast("string")).alias("html"),
        *([] if path is None else [filing_id(path, html).alias("filing_id")]),
    )
    return packed


def filing_id(path: Column, content: Column) -> Column:
    """A key for a filing: a hash of where it is from and of what it holds."""
    held = F.sha2(F.coalesce(content.cast("binary"), F.lit("").cast("binary")), 256)
    return F.sha2(F.concat_ws(":", held, F.isnull(content).cast("string"), path), 256)


def undecodable(filings: DataFrame) -> DataFrame:
    """Filings whose bytes are no valid UTF-8; extraction leaves them out unless asked for each filing's status."""
    return filings.filter(F.col("html").isNull()).drop("html")


def decodable(filings: DataFrame) -> DataFrame:
    return filings.filter(F.col("html").isNotNull())


def _as_filings(files: DataFrame) -> DataFrame:
    return files.select(
        F.regexp_extract("path", r"[^/]*\z", 0).alias("filename"),
        F.try_validate_utf8(F.col("content").cast("string")).alias("html"),
        F.col("modificationTime").alias("mtime"),
        filing_id(F.col("path"), F.col("content")).alias("filing_id"),
    )
