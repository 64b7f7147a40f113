"""Running and per-interval aggregates of streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators.aggregates import (
    approx_distinct,
    average,
    count_by,
    distinct_rows,
    distinct_within,
    numeric_aggregate,
    ratio_of_sums,
    running_count,
)
from millrace.operators.rolling import rolling_mean
from millrace.operators.windows import closed_windows
from millrace.plans.registry import query
from millrace.session import new_folder
from millrace.sources.replay import in_time_order
from millrace.sources.tables import table, table_stream
from millrace.streaming.runtime import run_to_table
from millrace.streaming.checkpoints import committed_batches, state_table
from millrace.streaming.ordered import ordered_rolling_means
from millrace.streaming.state import rolling_means_by_state


@query("SELECT round(avg(value), 4) AS mean_value FROM events")
def stream_avg(spark, sf_dir):
    mean = average(table_stream(spark, sf_dir, "events"), "value", "mean_value")
    rounded = mean.select(F.round("mean_value", 4).alias("mean_value"))
    return run_to_table(rounded, mode="complete")


@query("SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def stream_group_count(spark, sf_dir):
    counts = count_by(table_stream(spark, sf_dir, "events"), "event_type")
    return run_to_table(counts, mode="complete")


@query("SELECT count(*) AS line_count FROM documents")
def stream_count(spark, sf_dir):
    return run_to_table(running_count(table_stream(spark, sf_dir, "documents")), mode="complete")


PRIORITY_NUMBERS_SQL = """FROM (SELECT TRY_CAST(part AS INTEGER) AS n FROM
    (SELECT unnest(string_split(o_orderpriority, '-')) AS part FROM orders))"""


def priority_parts(spark, sf_dir):
    """Lines that are numbers or words in turn: the two halves of each order priority."""
    orders = table_stream(spark, sf_dir, "orders").select("o_orderpriority")
    return text.explode_parts(orders, "o_orderpriority", "-", "value")


@query(f"SELECT CAST(sum(n) AS BIGINT) AS result {PRIORITY_NUMBERS_SQL}")
def stream_numeric_agg(spark, sf_dir):
    return run_to_table(numeric_aggregate(priority_parts(spark, sf_dir), F.sum), mode="complete")


@query(f"SELECT round(avg(n), 4) AS result {PRIORITY_NUMBERS_SQL}")
def stream_numeric_mean(spark, sf_dir):
    mean = numeric_aggregate(priority_parts(spark, sf_dir), lambda n: F.round(F.mean(n), 4))
    return run_to_table(mean, mode="complete")


@query(
    """SELECT l_returnflag, round(sum(l_extendedprice) / sum(l_quantity), 4) AS price_per_unit
    FROM lineitem GROUP BY l_returnflag"""
)
def stream_ratio_of_sums(spark, sf_dir):
    items = table_stream(spark, sf_dir, "lineitem")
    ratio = ratio_of_sums(items, "l_returnflag", "l_extendedprice", "l_quantity", "ratio")
    rounded = ratio.select("l_returnflag", F.round("ratio", 4).alias("price_per_unit"))
    return run_to_table(rounded, mode="complete")


@query("SELECT DISTINCT o_custkey FROM orders")
def stream_distinct(spark, sf_dir):
    """Update mode: a value comes out in each batch that has it, so batches may repeat it."""
    customers = distinct_rows(table_stream(spark, sf_dir, "orders"), "o_custkey")
    return run_to_table(customers, mode="update").select("o_custkey").distinct()


@query("SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events")
def stream_distinct_within(spark, sf_dir):
    """Active users per day in append mode. The rows of a day lie less than the horizon apart, so
    that each value comes out once; days behind the watermark leave the state."""
    events = zoned(in_time_order(table(spark, sf_dir, "events").select("user_id", "ts"), "ts"), "ts")
    first = distinct_within(events.withColumn("day", F.to_date("ts")), "ts", "1 day", "user_id", "day")
    return run_to_table(first.select("user_id", "day"))


@query("SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def state_as_table(spark, sf_dir):
    """The state that a stopped count per type left in its checkpoint."""
    counts = count_by(table_stream(spark, sf_dir, "events"), "event_type")
    checkpoint = new_folder(spark, "checkpoint")
    run_to_table(counts, mode="complete", checkpoint=checkpoint, path=new_folder(spark, "table"))
    return state_table(spark, checkpoint).select("event_type", "count")


@query(
    """SELECT 'files' AS source, count(*) > 0 AS has_batches, true AS in_order FROM events"""
)
def offsets_as_table(spark, sf_dir):
    """The batches that a stopped query's checkpoint has committed, numbered from 0."""
    counts = count_by(table_stream(spark, sf_dir, "events"), "event_type")
    checkpoint = new_folder(spark, "checkpoint")
    run_to_table(counts, mode="complete", checkpoint=checkpoint, path=new_folder(spark, "table"))
    batches = committed_batches(spark, checkpoint)
    return batches.agg(
        F.lit("files").alias("source"), (F.count("batch") > 0).alias("has_batches"),
        (F.max("batch") == F.count("batch") - 1).alias("in_order"),
    )


# The standard error of the sketch is 5 percent; three times that is almost never exceeded.
APPROX_SQL = "SELECT event_type, true AS close FROM events GROUP BY event_type"


@query(APPROX_SQL)
def stream_approx_distinct(spark, sf_dir):
    """Whether the estimate of each type is within the error of the sketch."""
    users = table_stream(spark, sf_dir, "events")
    found = run_to_table(approx_distinct(users, "user_id", "event_type", name="near"), "complete")
    exact = table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count_distinct("user_id").alias("exact")
    )
    close = F.abs(F.col("near") - F.col("exact")) <= F.greatest(F.lit(1), 0.15 * F.col("exact"))
    return found.join(exact, "event_type").select("event_type", close.alias("close"))


def zoned(df, *names):
    return df.withColumns({c: F.col(c).cast("timestamp") for c in names})


def without_zone(df, *names):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in names})


def hourly(spark, sf_dir, measures, keys=()):
    """Totals of closed hours: an interval is forgotten once the watermark has passed it."""
    events = zoned(in_time_order(table(spark, sf_dir, "events"), "ts"), "ts")
    totals = closed_windows(events, "ts", "1 hour", "1 hour", measures, keys)
    return run_to_table(without_zone(totals, "start", "end"))


def hourly_sql(select, keys=""):
    by = f", {keys}" if keys else ""
    return f"""SELECT start, start + INTERVAL 1 HOUR AS "end"{by}, {select}
        FROM (SELECT *, date_trunc('hour', ts) AS start FROM events)
        WHERE start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
        GROUP BY start{by}"""


@query(hourly_sql("count(*) AS count"))
def batch_count(spark, sf_dir):
    return hourly(spark, sf_dir, {"count": ("count", F.lit(1))})


@query(hourly_sql("count(*) AS count", "event_type"))
def batch_count_by_value(spark, sf_dir):
    return hourly(spark, sf_dir, {"count": ("count", F.lit(1))}, ["event_type"])


@query(hourly_sql("count(*) AS n, max(value) AS largest", "user_id"))
def batch_reduce_by_key(spark, sf_dir):
    measures = {"n": ("count", F.lit(1)), "largest": ("max", F.col("value"))}
    return hourly(spark, sf_dir, measures, ["user_id"])


ROLLING_SQL = """SELECT user_id, ts, event_id, value, round(mean, 4) AS mean FROM (
    SELECT user_id, ts, event_id, value,
        avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
            ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS mean,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS position
    FROM events) WHERE position >= 3"""
ORDER = ["ts", "event_id"]


def rounded_mean(df):
    return df.withColumn("mean", F.round("mean", 4))


@query(ROLLING_SQL)
def rolling_mean_batch(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", *ORDER, "value")
    return rounded_mean(rolling_mean(events, "user_id", ORDER, "value", 3))


@query(ROLLING_SQL)
def rolling_mean_stream(spark, sf_dir):
    """Several micro-batches in event order, with the last rows of each user as state."""
    events = table(spark, sf_dir, "events").select("user_id", *ORDER, "value")
    return means_by_state(in_time_order(events, "ts"))


@query(
    f"""SELECT * FROM ({ROLLING_SQL}) WHERE ts <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"""
)
def rolling_mean_ordered(spark, sf_dir):
    """Rows wait in state for the watermark and leave it in order, whatever order they came in."""
    events = table(spark, sf_dir, "events").select("user_id", *ORDER, "value")
    stream = zoned(in_time_order(events, "ts"), "ts")
    means = ordered_rolling_means(stream, "user_id", "ts", "1 hour", "event_id", "value", 3)
    return rounded_mean(without_zone(run_to_table(means), "ts"))


@query(ROLLING_SQL)
def rolling_mean_state(spark, sf_dir):
    """The table's own files, in no order of time, as one micro-batch."""
    return means_by_state(table_stream(spark, sf_dir, "events", max_bytes=None))


def means_by_state(events):
    means = rolling_means_by_state(zoned(events, "ts"), "user_id", ORDER, "value", 3)
    return rounded_mean(without_zone(run_to_table(means), "ts"))
