"""Message envelopes and the records inside them."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.text import parse_delimited
from millrace.plans.registry import query
from millrace.schemas import CLICK
from millrace.sources.messages import decode_messages, encode_json, encode_messages
from millrace.sources.tables import table_stream
from millrace.streaming.runtime import run_to_table


def event_messages(spark, sf_dir):
    """Events as they would come from a topic: binary key and value, then the metadata."""
    events = table_stream(spark, sf_dir, "events")
    text = F.concat_ws(",", "user_id", "event_id")
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.col("event_type").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


@query(
    """SELECT event_type AS topic, CAST(user_id AS VARCHAR) || ',' || CAST(event_id AS VARCHAR)
        AS value FROM events"""
)
def kafka_decode(spark, sf_dir):
    return run_to_table(decode_messages(event_messages(spark, sf_dir)))


@query(
    """SELECT event_type AS topic, CAST(user_id AS VARCHAR) AS "sessionId",
        event_id AS "clickDuration" FROM events"""
)
def kafka_records(spark, sf_dir):
    return run_to_table(parse_delimited(decode_messages(event_messages(spark, sf_dir)), CLICK))


@query("SELECT upper(c_name) AS key, c_name AS value FROM customer")
def kafka_encode_kv(spark, sf_dir):
    customers = table_stream(spark, sf_dir, "customer")
    return run_to_table(encode_messages(customers, F.upper("c_name"), F.col("c_name")))


@query(
    """SELECT c_name AS key, '{"c_custkey":' || CAST(c_custkey AS VARCHAR)
        || CASE WHEN c_mktsegment = 'BUILDING' THEN ''
           ELSE ',"segment":"' || c_mktsegment || '"' END || '}' AS value
    FROM customer"""
)
def kafka_encode_json(spark, sf_dir):
    customers = table_stream(spark, sf_dir, "customer").withColumn(
        "segment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    )
    return run_to_table(encode_json(customers, F.col("c_name"), ["c_custkey", "segment"]))
