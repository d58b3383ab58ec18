"""Extraction over filings as they arrive.

A filing is complete when its file is, so there is nothing to wait for and no state to keep: from
tables alone the streaming plan is the batch plan, row by row, and the file sink writes each filing
once. With text fallback there is an aggregate per filing, so each batch of files runs as a batch
job whose output folder is named after the batch and the run and replaced if the batch is run again. A run is
what one checkpoint holds: a new checkpoint on the same folder starts another run, which overwrites nothing.
"""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pershare.functions.patterns import DEFAULT_TIMEFRAME
from pershare.plans.extract import extract_eps


def stream_eps(
    filings: DataFrame,
    folder: str,
    checkpoint: str,
    timeframe: int = DEFAULT_TIMEFRAME,
    make_encoder=None,
    trigger: dict | None = None,
    status: bool = False,
) -> StreamingQuery:
    """Start writing results as parquet below ``folder``; by default stop when all input is read.

    With an encoder the results lie in one sub-folder ``batch=n/run=id`` per batch of files and checkpoint. ``status`` as in
    ``extract_eps``; it is what tells filings apart where a second run reads them again, see ``settled_results``.
    """
    trigger = trigger or {"availableNow": True}
    if make_encoder is None:
        writer = (
            extract_eps(filings, timeframe, status=status)
            .writeStream.format("parquet")
            .option("path", folder)
            .outputMode("append")
        )
    else:

        def write_batch(batch: DataFrame, batch_id: int) -> None:
            results = extract_eps(batch, timeframe, make_encoder, status=status)
            run = _run_id(batch.sparkSession, checkpoint)
            results.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}/run={run}")

        writer = filings.writeStream.foreachBatch(write_batch)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def settled_results(spark: SparkSession, folder: str) -> DataFrame:
    """The results of all runs, each filing once: by all columns, so with ``filing_id`` if they were written with ``status``."""
    found = spark.read.parquet(folder)
    return found.drop("batch", "run").distinct()


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a checkpoint keeps from its first start on."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
