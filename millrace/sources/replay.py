"""Replay recorded batches, or a table in the order of its times, as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.session import new_folder

#: Rows in a micro-batch of a replayed table, and rows in one of its files.
RANGE_ROWS = 20_000_000
FILE_ROWS = 200_000
#: Bytes of text in a micro-batch of replayed lines, and in one of its files.
RANGE_BYTES = 128 << 20
FILE_BYTES = 8 << 20
#: Rows of both sides in a micro-batch of a join. All of them pass through its state.
JOIN_ROWS = 5_000_000


def replay_batches(
    spark: SparkSession, batches: Sequence[Sequence[tuple]], schema: str, path: str
) -> DataFrame:
    """A stream that delivers one queue entry per micro-batch.

    Meant for short recorded sequences the caller holds in memory: each entry becomes one
    file, and files are taken one per trigger in the order they were written.
    """
    for rows in batches:
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").json(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(path)


def range_count(tables: Sequence[DataFrame], rows: int | None = None) -> int:
    """Ranges of time for tables replayed side by side, at most ``rows`` (RANGE_ROWS) of them all."""
    return max(2, -(-sum(df.count() for df in tables) // (rows or RANGE_ROWS)))


def _text_bytes(text: str | None) -> Column:
    size = F.lit(0) if text is None else F.octet_length(text)
    return F.coalesce(F.sum(size), F.lit(0)).cast("long")


def in_time_order(
    df: DataFrame, time: str, slices: int | None = None, text: str | None = None
) -> DataFrame:
    """A stream of a table's rows by event time, one range of times per micro-batch.

    A table's files are in no order of time, so a watermark would drop rows of the files that
    come later. One pass divides the table into ranges of about equally many rows, RANGE_ROWS
    at most unless ``slices`` is given; the ranges then follow each other into the folder of
    the stream, each as the same number of files, which its tasks write side by side and one
    micro-batch reads. Rows without a time come first. Where rows become many, such as lines
    split into words, name their ``text``: ranges and files are then bounded by its bytes too.
    """
    spark = df.sparkSession
    if slices is None:
        slices = range_count([df])
        if text is not None:
            slices = max(slices, -(-df.agg(_text_bytes(text)).first()[0] // RANGE_BYTES))
    shares = [k / slices for k in range(1, slices)] or [0.5]
    seen = df.agg(F.percentile_approx(time, shares).alias("b"), F.max(time).alias("last")).first()
    bounds = [b for b in sorted(set(seen.b or [])) if b < seen.last] if slices > 1 else []
    path, staged = new_folder(spark, "replay"), new_folder(spark, "ranges")
    number = "_".join(["range", *df.columns])  # longer than any of them
    place = F.lit(0)
    for bound in bounds:
        place = place + F.coalesce(F.col(time) > F.lit(bound), F.lit(False)).cast("int")
    df.withColumn(number, place).write.partitionBy(number).parquet(staged)
    ranged = spark.read.schema(StructType([*df.schema.fields]).add(number, "integer")).parquet(staged)
    counted = ranged.groupBy(number).agg(F.count(F.lit(1)), _text_bytes(text)).collect()
    sizes = {row[0]: row[1] for row in counted}
    wanted = [max(-(-rows // FILE_ROWS), -(-size // FILE_BYTES)) for _, rows, size in counted]
    files = min(*sizes.values(), max(wanted)) if sizes else 1
    for one in sorted(sizes):
        part = spark.read.schema(df.schema).parquet(f"{staged}/{number}={one}")
        turn = F.pmod(F.monotonically_increasing_id(), F.lit(files)).cast("int")
        part.repartitionById(files, turn).write.mode("append").parquet(path)
    if not sizes:
        df.write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def rows_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def number_table(spark: SparkSession, count: int, name: str = "number") -> DataFrame:
    """1..count, generated on the executors."""
    return spark.range(1, count + 1).withColumnRenamed("id", name)
