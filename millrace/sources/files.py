"""Static files and directory streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.schemas import STOCK
from millrace.session import scoped_conf


def json_table(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """Static JSON; without a schema Spark infers one, at the cost of a pass over the data."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def csv_stream(
    spark: SparkSession,
    path: str,
    schema: str | StructType = STOCK,
    date_format: str = "MMM d yyyy",
    **options,
) -> DataFrame:
    """Header-less CSV directory; a field that does not parse is NULL and the row stays."""
    return (
        spark.readStream.schema(schema)
        .options(header=False, dateFormat=date_format, **options)
        .csv(path)
    )


def json_stream(spark: SparkSession, path: str, schema: str | StructType, **options) -> DataFrame:
    return spark.readStream.schema(schema).options(**options).json(path)


def parquet_stream(
    spark: SparkSession,
    path: str,
    schema: str | StructType | None = None,
    max_files: int | None = None,
    archive: str | None = None,
    **options,
) -> DataFrame:
    """Parquet directory whose files may differ in columns.

    ``max_files`` limits a micro-batch. ``archive`` moves consumed files to that folder;
    Spark does this in the background, so the newest files may remain when a query ends.
    Without a schema it is inferred from the files present at the start.
    """
    settings = {"mergeSchema": True} | options
    if max_files is not None:
        settings["maxFilesPerTrigger"] = max_files
    if archive is not None:
        settings |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    if schema is not None:
        return spark.readStream.schema(schema).options(**settings).parquet(path)
    with scoped_conf(spark, {"spark.sql.streaming.schemaInference": "true"}):
        return spark.readStream.options(**settings).parquet(path)


def line_source(spark: SparkSession, format: str = "text", **options) -> DataFrame:
    """A stream with one string column ``value``: text folders, or any Spark line source."""
    return spark.readStream.format(format).options(**options).load().select("value")


def with_file_name(df: DataFrame, name: str = "file_name") -> DataFrame:
    return df.withColumn(name, F.input_file_name())
