"""Files of messages and events."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from showpulse.functions.schema import EVENT


def file_events(
    spark: SparkSession,
    path: str,
    schema: StructType | str = EVENT,
    format: str = "parquet",
    max_files: int | None = 1,
) -> DataFrame:
    """Files as a stream, oldest first, `max_files` per trigger; None takes all files that are there."""
    reader = spark.readStream.schema(schema).format(format)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def finished(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the `name=number` folders whose write has finished."""
    done = file_system(spark, folder).globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*/_SUCCESS"))
    return sorted(int(status.getPath().getParent().getName().split("=")[1]) for status in done or [])


def file_system(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def publish_files(messages: DataFrame, path: str, checkpoint: str | None = None) -> StreamingQuery | None:
    """Write the column `value` as lines of text. A stream needs a checkpoint and gives back its query."""
    values = messages.select("value")
    if messages.isStreaming:
        return values.writeStream.format("text").option("checkpointLocation", checkpoint).start(path)
    values.write.mode("append").text(path)
    return None
