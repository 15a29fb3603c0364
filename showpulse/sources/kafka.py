"""Kafka topics. They need the `spark-sql-kafka` connector on the class path."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def kafka_events(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", max_per_trigger: int | None = None
) -> DataFrame:
    """Messages of a topic as a stream: `value`, arrival time, and the position that orders the messages."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().selectExpr(
        "value", "timestamp AS arrived_at", "partition AS source_partition", "offset AS source_offset"
    )


def publish_kafka(
    messages: DataFrame, servers: str, topic: str, checkpoint: str | None = None
) -> StreamingQuery | None:
    """Send the column `value`, without a message key. A stream needs a checkpoint and gives back its query."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    values = messages.select("value")
    if messages.isStreaming:
        return values.writeStream.format("kafka").options(**options, checkpointLocation=checkpoint).start()
    values.write.format("kafka").options(**options).save()
    return None
