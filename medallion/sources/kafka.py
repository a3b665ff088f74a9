"""Kafka topic source and sink. The connector jar has to be on the cluster's classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

STARTING_OFFSETS = "earliest"


def read_topic(
    spark: SparkSession, servers: str, topic: str, max_offsets_per_trigger: int | None = None, **options: str
) -> DataFrame:
    """A topic as a stream with value, topic, partition, offset and timestamp; the checkpoint keeps the offsets."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", STARTING_OFFSETS)
        .options(**options)
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader.load()


def publish(messages: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Write (key, value) rows to a topic with full acknowledgement and an idempotent producer."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("topic", topic)
        .options(**options)
        .save()
    )


def publish_stream(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """The streaming twin of ``publish``, with the same guarantees; not started yet."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
