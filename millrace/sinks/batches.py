"""Functions for ``foreachBatch``.

Each takes a micro-batch and its id. Folder writers name the folder after the batch id and
overwrite it, so a batch that is run again after a failure replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BatchWriter = Callable[[DataFrame, int], None]
FILE_FORMATS = ("parquet", "json", "csv", "orc")


def show_batch(rows: int = 10) -> BatchWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        batch.show(rows, truncate=False)

    return write


def folder_per_batch(path: str, format: str) -> BatchWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(format).save(f"{path}/batch={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str, format: str, schema: StructType) -> DataFrame:
    """Rows of all batch folders, without the batch number the folder names add."""
    return spark.read.schema(schema).format(format).load(path).select(schema.names)


def text_folders(path: str) -> BatchWriter:
    """One folder per batch, one text file per partition; takes a single string column."""
    return folder_per_batch(path, "text")


def json_folders(path: str) -> BatchWriter:
    return folder_per_batch(path, "json")


def replace_table(path: str, format: str = "parquet") -> BatchWriter:
    """Keep only the newest result, for complete-mode aggregates.

    Each batch writes a version of its own, and the one before goes only after that, so a job
    that fails leaves the earlier result. Read it with :func:`newest_version`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(format).save(f"{path}/version={batch_id}")
        spark = batch.sparkSession
        for earlier in _versions(spark, path):
            if earlier < batch_id:
                folder = _hadoop_path(spark, f"{path}/version={earlier}")
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

    return write


def newest_version(spark: SparkSession, path: str, schema: StructType, format: str = "parquet"):
    """The result that :func:`replace_table` wrote last, or None before the first batch."""
    versions = _versions(spark, path)
    if not versions:
        return None
    return spark.read.schema(schema).format(format).load(f"{path}/version={max(versions)}")


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Finished versions under a path; a folder without its success mark is not one."""
    pattern = _hadoop_path(spark, f"{path}/version=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return [int(f.getPath().getParent().getName().split("=")[1]) for f in found]


def table_writer(
    format: str,
    options: Mapping[str, str],
    columns: Sequence[str] | None = None,
    mode: str = "append",
    batch_column: str | None = None,
) -> BatchWriter:
    """Write chosen columns of every batch to an external table through a Spark connector.

    A batch may run again after a failure. With ``batch_column`` its rows carry the batch id:
    a file table is then written by partitions of that column, of which a repeated batch
    replaces its own, and a keyed store overwrites equal keys. Without it a repeated batch is
    appended twice, unless the table has a key that replaces.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        chosen = batch.select(*columns) if columns else batch
        writer = chosen.write.format(format).options(**options).mode(mode)
        if batch_column is not None:
            marked = chosen.withColumn(batch_column, F.lit(batch_id).cast("long"))
            writer = marked.write.format(format).options(**options)
            if format in FILE_FORMATS:
                writer = writer.partitionBy(batch_column).option("partitionOverwriteMode", "dynamic")
                writer = writer.mode("overwrite")
            else:
                writer = writer.mode(mode)
        writer.save()

    return write


def jdbc_options(url: str, table: str, **properties: str) -> dict[str, str]:
    """Connection options; credentials only ever come from the caller."""
    return {"url": url, "dbtable": table, **properties}


def jdbc_writer(url: str, table: str, mode: str = "append", **properties: str) -> BatchWriter:
    """JDBC write per batch. ``mode="errorifexists"`` lets only the first batch through."""
    return table_writer("jdbc", jdbc_options(url, table, **properties), mode=mode)


def keyspace_writer(keyspace: str, table: str, columns: Sequence[str]) -> BatchWriter:
    """Append projected columns to a Cassandra table; needs that connector installed."""
    options = {"keyspace": keyspace, "table": table}
    return table_writer("org.apache.spark.sql.cassandra", options, columns)
