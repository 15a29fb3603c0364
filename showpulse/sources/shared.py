"""The folder that all executors share."""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder name under `spark.checkpoint.dir`. Only a local master may do without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="showpulse-")
    return f"{root}/{uuid.uuid4()}"


def settled(df: DataFrame) -> DataFrame:
    """The rows of `df` from a table written now: for results of costly steps that are read more than once."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
