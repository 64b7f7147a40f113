"""Line and record streams: scans, parsing, filters and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import text
from millrace.functions.dates import from_millis
from millrace.plans.registry import query
from millrace.schemas import STOCK
from millrace.session import new_folder
from millrace.sources.files import csv_stream as csv_lines
from millrace.sources.files import json_stream as json_lines
from millrace.sources.files import json_table, parquet_stream, with_file_name
from millrace.sources.files import line_source as text_lines
from millrace.sources.tables import table, table_stream
from millrace.streaming.runtime import run_to_table


def document_lines(spark, sf_dir):
    documents = table_stream(spark, sf_dir, "documents").select("text")
    return text.lines(documents, "text")


DOCUMENT_LINES_SQL = (
    "SELECT unnest(string_split(text, chr(10))) AS value FROM documents"
)


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_parquet_scan(spark, sf_dir):
    return run_to_table(table_stream(spark, sf_dir, "events", max_files=10))


@query(DOCUMENT_LINES_SQL)
def stream_lines(spark, sf_dir):
    return run_to_table(document_lines(spark, sf_dir))


@query(f"SELECT value FROM ({DOCUMENT_LINES_SQL}) WHERE length(value) <= 5")
def stream_short_lines(spark, sf_dir):
    return run_to_table(text.short_lines(document_lines(spark, sf_dir), 5))


@query(f"SELECT upper(replace(value, 'ß', 'SS')) AS value FROM ({DOCUMENT_LINES_SQL})")
def stream_upper(spark, sf_dir):
    return run_to_table(text.upper_lines(document_lines(spark, sf_dir)))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def stream_json_parse(spark, sf_dir):
    payloads = table_stream(spark, sf_dir, "events").select("event_id", "props")
    return run_to_table(text.json_records(payloads, "k int", "props"))


@query("SELECT c_name AS name FROM customer")
def stream_names(spark, sf_dir):
    customers = table_stream(spark, sf_dir, "customer")
    return run_to_table(customers.select(F.col("c_name").alias("name")))


@query(
    """SELECT o_orderkey AS id, o_orderpriority AS priority, CAST(o_orderdate AS DATE) AS placed,
        CAST(-1 AS INTEGER) AS amount, false AS valid FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE), CAST(o_custkey AS INTEGER), true
    FROM orders WHERE o_orderstatus <> 'F'"""
)
def parse_delimited(spark, sf_dir):
    # Orders written as text lines; the amount of finished orders is not a number.
    amount = F.when(F.col("o_orderstatus") == "F", "none").otherwise(F.col("o_custkey").cast("string"))
    date = F.date_format("o_orderdate", "MMM d yyyy")
    written = table_stream(spark, sf_dir, "orders").select(
        F.concat_ws(":", "o_orderkey", "o_orderpriority", date, amount).alias("value")
    )
    schema = "id long, priority string, placed date, amount int"
    parsed = text.parse_delimited(written, schema, ":", date_format="MMM d yyyy", valid="valid")
    return run_to_table(parsed.fillna(-1, ["amount"]))


@query(
    """SELECT doc_id, word FROM
        (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents)
    WHERE word <> ''"""
)
def words_explode(spark, sf_dir):
    return text.words(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")


@query(
    """SELECT page_id, string_split(url, '/')[4] AS section, string_split(url, '/')[5] AS page,
        string_split(url, '/')[6] AS rest FROM pages"""
)
def path_segments(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return text.path_segments(pages, "url", {3: "section", 4: "page", 5: "rest"})


@query(
    """SELECT 'events' AS table_name, count(*) AS rows, true AS named FROM events"""
)
def file_monitor(spark, sf_dir):
    """Files that a stream of the events table has read, each with its rows, added up per table.

    ``named`` says that every row came with the base name of a file.
    """
    read = with_file_name(table_stream(spark, sf_dir, "events"))
    seen = run_to_table(read.groupBy("file_name").agg(F.count(F.lit(1)).alias("rows")), "complete")
    base = F.element_at(F.split("file_name", "/"), -1)
    folder = F.regexp_extract("file_name", r"([^/]+)\.parquet", 1)
    return seen.groupBy(folder.alias("table_name")).agg(
        F.sum("rows").alias("rows"), F.bool_and(base.endswith(".parquet")).alias("named")
    )


def exported(spark, df, format, **options):
    """Write a table in another format to a folder of its own on shared storage."""
    folder = new_folder(spark, format)
    df.write.format(format).options(**options).save(folder)
    return folder


@query(
    """SELECT event_type AS company, CAST(ts AS DATE) AS date, value,
        epoch_us(ts) // 1000 AS created, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events"""
)
def csv_stream(spark, sf_dir):
    """CSV files with a written-out date, epoch milliseconds and an ISO date, read as a stream."""
    events = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    folder = exported(
        spark,
        events.select(
            F.col("event_type").alias("company"), day.alias("date"), "value",
            F.unix_millis(F.col("ts").cast("timestamp")).alias("created"),
            F.date_format(day, "yyyy-MM-dd").alias("iso"),
        ),
        "csv",
        dateFormat="MMM d yyyy",
    )
    schema = f"{STOCK}, created long, iso string"
    read = run_to_table(csv_lines(spark, folder, schema))
    milliseconds = F.unix_millis(from_millis(F.col("created")))
    day = text.typed_field(F.col("iso"), "date").cast("string")
    return read.select(
        "company", "date", "value", milliseconds.alias("created"), day.alias("day")
    )


@query("SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders")
def json_stream(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"
    )
    folder = exported(spark, orders, "json")
    return run_to_table(json_lines(spark, folder, orders.schema))


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def json_inferred(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return json_table(spark, exported(spark, customers, "json"))


@query(
    """SELECT n_nationkey AS key, n_name AS name, n_regionkey AS region FROM nation
    UNION ALL SELECT r_regionkey, r_name, NULL FROM region"""
)
def parquet_merge_schema(spark, sf_dir):
    """Files of different columns in one folder, one file per micro-batch."""
    folder = exported(
        spark,
        table(spark, sf_dir, "nation").selectExpr(
            "n_nationkey AS key", "n_name AS name", "n_regionkey AS region"
        ),
        "parquet",
    )
    regions = table(spark, sf_dir, "region").selectExpr("r_regionkey AS key", "r_name AS name")
    regions.write.mode("append").parquet(folder)
    return run_to_table(parquet_stream(spark, folder, max_files=1))


@query("SELECT unnest(string_split(text, chr(10))) AS value FROM documents")
def line_source(spark, sf_dir):
    """Lines of text files as a stream. A carriage return ends a line too, so it is replaced."""
    documents = table(spark, sf_dir, "documents").select("text")
    written = documents.withColumn("text", F.replace("text", F.lit("\r"), F.lit("\x1f")))
    folder = exported(spark, written, "text")
    lines = run_to_table(text_lines(spark, "text", path=folder))
    return lines.withColumn("value", F.replace("value", F.lit("\x1f"), F.lit("\r")))
