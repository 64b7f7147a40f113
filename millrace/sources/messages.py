"""Key/value messages: the connector calls are thin, the envelope work is plain columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_FORMAT = "kafka"


def message_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic}


def message_source(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Subscribe to a topic. Needs the Kafka connector package on the class path."""
    reader = spark.readStream.format(MESSAGE_FORMAT)
    return reader.options(**message_options(servers, topic), **options).load()


def decode_messages(df: DataFrame) -> DataFrame:
    """Envelope to ``topic`` and text ``value``."""
    return df.select("topic", F.col("value").cast("string").alias("value"))


def encode_messages(df: DataFrame, key: Column, value: Column) -> DataFrame:
    return df.select(key.cast("string").alias("key"), value.cast("string").alias("value"))


def encode_json(df: DataFrame, key: Column, columns: list[str]) -> DataFrame:
    """The listed columns as one JSON text; fields that are NULL are left out."""
    return encode_messages(df, key, F.to_json(F.struct(*columns)))


def message_sink(df: DataFrame, servers: str, topic: str, checkpoint: str):
    """A writer for the envelope; the caller picks a trigger and starts it."""
    return df.writeStream.format(MESSAGE_FORMAT).options(
        **{"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}
    )
