"""Tables that a plan writes once and reads several times, in the folder all executors see."""

import posixpath
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset a temporary folder, which only a local session has in common."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "file://" + tempfile.mkdtemp(prefix="pershare-")


def written_once(df: DataFrame, name: str) -> DataFrame:
    """The rows, worked out now and read back by everything that uses them; each reader takes only its columns.

    It survives lost executors and is not removed: the folder's owner decides how long its tables are kept.
    """
    path = posixpath.join(shared_folder(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
