"""Kafka in and out. Needs Spark's Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_offsets: int | None = None,
    **options: str,
) -> DataFrame:
    """A topic as a stream of ``key, value, topic, partition, offset, timestamp``.

    Each streaming query keeps its own position in its checkpoint, so two readers
    of one topic both see every message.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def write_topic(messages: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Publish a batch of ``(key, value)``."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**options)
        .save()
    )


def stream_to_topic(
    messages: DataFrame, servers: str, topic: str, checkpoint: str, **options: str
):
    """Publish a stream of ``(key, value)``; returns the started query."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .options(**options)
        .start()
    )
