"""Sinks, checked by reading back what was written."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.plans.registry import query
from millrace.session import new_folder
from millrace.sinks.batches import json_folders, read_batches, table_writer, text_folders
from millrace.sources.tables import read_snapshot, table, table_stream, write_snapshot
from millrace.streaming.runtime import run_batches


@query("SELECT props AS value FROM events")
def text_batches_sink(spark, sf_dir):
    path = new_folder(spark, "text")
    values = table_stream(spark, sf_dir, "events").select(F.col("props").alias("value"))
    run_batches(values, text_folders(path))
    return read_batches(spark, path, "text", values.schema)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def json_batches_sink(spark, sf_dir):
    path = new_folder(spark, "json")
    customers = table_stream(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    run_batches(customers, json_folders(path))
    return read_batches(spark, path, "json", customers.schema)


@query("SELECT p_name, p_size FROM part")
def table_sink(spark, sf_dir):
    path = new_folder(spark, "table")
    writer = table_writer("parquet", {"path": path}, ["p_name", "p_size"], batch_column="batch")
    run_batches(table_stream(spark, sf_dir, "part"), writer)
    return read_batches(spark, path, "parquet", StructType.fromDDL("p_name string, p_size int"))


@query("SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def snapshot_sink(spark, sf_dir):
    path = new_folder(spark, "snapshot")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    write_snapshot(suppliers, path)
    return read_snapshot(spark, path)
