"""Parquet tables and snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.session import new_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(
    spark: SparkSession,
    folder: str,
    name: str,
    max_files: int | None = None,
    max_bytes: int | None = 1 << 30,
) -> DataFrame:
    """The same table as a stream of its files.

    The path is written as a glob because a file stream does not take the path of one
    file; the glob matches a single file as well as a directory of part files. A micro-batch
    takes about ``max_bytes`` of files, so that a large table comes in many.
    """
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    if max_files is not None:  # Spark takes one of the two limits
        reader = reader.option("maxFilesPerTrigger", max_files)
    elif max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(f"{folder}/{name}.parque[t]")


def read_snapshot(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """One version of a mutable table; pass ``format="delta"`` where that is installed."""
    return spark.read.format(format).load(path)


def write_snapshot(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    partition_by: tuple[str, ...] = (),
    mode: str = "errorifexists",
) -> None:
    """Write the first or the next version; each version gets its own path."""
    df.write.format(format).mode(mode).partitionBy(*partition_by).save(path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to shared storage and read it back.

    It is computed once, survives the loss of executors and has exact size statistics.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
