"""What a query's checkpoint holds, as tables. The query must not be running."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def state_table(
    spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None
) -> DataFrame:
    """Keys and values that one stateful operator kept, after the last or a given batch.

    The operators of a query are numbered from its sources on. Read with Spark's state data
    source, one task per partition of the state.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint).select("key.*", "value.*")


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a query, with their stores and partitions."""
    return spark.read.format("state-metadata").load(checkpoint)


def committed_batches(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Number and watermark (milliseconds) of each micro-batch that has been committed."""
    commits = _log(spark, f"{checkpoint}/commits").select("batch")
    offsets = _log(spark, f"{checkpoint}/offsets")
    mark = F.get_json_object("value", "$.batchWatermarkMs").cast("long")
    marks = offsets.groupBy("batch").agg(F.max(mark).alias("watermark_ms"))
    return commits.distinct().join(marks, "batch")


def _log(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of a log whose files are named by batch."""
    lines = spark.read.text(f"{folder}/[0-9]*")
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return lines.select(name.cast("long").alias("batch"), "value")
