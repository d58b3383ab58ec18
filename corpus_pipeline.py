"""From raw documents to a mixed training set, in stages that each read what the one before wrote.

The columns of documents stay the same: doc_id, text, lang, source, n_chars. Where a stage shortens a text, n_chars follows. Only
the last stage adds columns: the words of a document and the probability with which it was drawn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pershare.llm import language
from pershare.llm.common import stored
from pershare.llm.decontaminate import clean_documents
from pershare.llm.jaccard_join import one_of_each
from pershare.llm.line_dedup import dedup_lines
from pershare.llm.mixing import mixed_sample, topic

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A text that looks like no language to the model has a lower score.
LEAST_SCORE = 0.25


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out texts without letters and those that fit no language learned from the labelled documents."""
    found = language.predict(docs.select(*COLUMNS), language.fit(docs))
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines of ten or more documents out of all texts; documents of which nothing is left stay, empty."""
    return dedup_lines(docs.select(*COLUMNS), 10).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""
    return one_of_each(docs.select(*COLUMNS))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that hold a passage of the benchmark."""
    return clean_documents(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws documents so that tokens follow the tempered shares of source, language and topic."""
    drawn = mixed_sample(docs.select(*COLUMNS).withColumn("topic", topic()), ["source", "lang", "topic"])
    return drawn.withColumn("keep_probability", F.round("keep_probability", 6))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_common_lines),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_benchmark_passages),
    ("mixing", mix_sources),
]
#: SQL has no form of the language model; tests hold the stages against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs, f"stage-{number}-{name}")
    return docs
