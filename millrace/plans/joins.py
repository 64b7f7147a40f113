"""Stream-static and stream-stream joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.joins import PACK_SETTINGS, spread_join, stream_anti_join
from millrace.operators.timed_joins import Span
from millrace.plans.registry import query
from millrace.sources.replay import JOIN_ROWS, in_time_order, range_count
from millrace.sources.tables import table, table_stream
from millrace.streaming.runtime import run_to_table


def events_with_customers(spark, sf_dir, how):
    """Event stream against the customers of one market segment, unique on their key."""
    events = table_stream(spark, sf_dir, "events").select("event_id", "user_id")
    customers = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return spread_join(events, customers.select("c_custkey", "c_name"), "user_id", "c_custkey", how)


@query(
    """SELECT event_id, user_id, c_name FROM events JOIN customer ON user_id = c_custkey
    WHERE c_mktsegment = 'BUILDING'"""
)
def stream_static_inner(spark, sf_dir):
    return run_to_table(events_with_customers(spark, sf_dir, "inner").drop("c_custkey"))


@query(
    """SELECT event_id, user_id, c_name FROM events LEFT JOIN
        (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') ON user_id = c_custkey"""
)
def stream_static_left(spark, sf_dir):
    return run_to_table(events_with_customers(spark, sf_dir, "left").drop("c_custkey"))


@query(
    """SELECT event_id, user_id FROM events WHERE user_id IN
        (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"""
)
def stream_static_semi(spark, sf_dir):
    return run_to_table(events_with_customers(spark, sf_dir, "left_semi"))


@query(
    """SELECT event_id, user_id FROM events WHERE user_id NOT IN
        (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"""
)
def stream_static_anti(spark, sf_dir):
    return run_to_table(events_with_customers(spark, sf_dir, "left_anti"))


ITEM = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
ORDER = ["o_orderkey", "o_custkey", "o_orderdate"]
#: Rows of both sides in a bucket of a join that packs its state.
BUCKET_ROWS = 128
#: The same with a watermark, where few of them wait at once; and buckets of small tables.
TIMED_ROWS = 500_000
TIMED_BUCKETS = 96
#: An order is placed at most so many milliseconds before an item of it is shipped.
IN_TIME_MS = 90 * 24 * 3600 * 1000


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, o_custkey
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
)
def stream_stream_inner(spark, sf_dir):
    """Without a watermark both sides are kept as state for as long as the query lives."""
    items = table_stream(spark, sf_dir, "lineitem").select(*ITEM)
    orders = table_stream(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rows = sum(table(spark, sf_dir, name).count() for name in ("lineitem", "orders"))
    buckets = max(1, rows // BUCKET_ROWS)
    joined = spread_join(items, orders, "l_orderkey", "o_orderkey", packed=buckets)
    return run_to_table(joined.drop("o_orderkey"), settings=PACK_SETTINGS)


def shipped_in_time(spark, sf_dir, how):
    """Items matched to orders placed up to 90 days before shipping, both watermarked."""
    shipped = table(spark, sf_dir, "lineitem").select(*ITEM)
    placed = table(spark, sf_dir, "orders").select(*ORDER)
    # As many ranges on both sides, so that neither stream runs ahead and waits in the state.
    slices = range_count([shipped, placed], JOIN_ROWS)
    return match_in_time(
        in_time_order(shipped, "l_shipdate", slices),
        in_time_order(placed, "o_orderdate", slices),
        how,
        max(TIMED_BUCKETS, (shipped.count() + placed.count()) // TIMED_ROWS),
    )


def match_in_time(shipped, placed, how, buckets=TIMED_BUCKETS):
    shipped = shipped.withColumn("shipped", F.col("l_shipdate").cast("timestamp"))
    placed = placed.withColumn("placed", F.col("o_orderdate").cast("timestamp"))
    shipped = shipped.drop("l_shipdate").withWatermark("shipped", "10 days")
    placed = placed.drop("o_orderdate").withWatermark("placed", "10 days")
    within = Span("shipped", "placed", -IN_TIME_MS, 0)
    if how == "left_anti":
        joined = stream_anti_join(shipped, placed, "l_orderkey", "o_orderkey", within, packed=buckets)
    else:
        joined = spread_join(
            shipped, placed, "l_orderkey", "o_orderkey", how, within=within, packed=buckets
        )
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("shipped", "placed") if c in joined.columns}
    keeps_unmatched = how in ("left", "left_anti")
    return run_to_table(
        joined.withColumns(times), idle_batches=keeps_unmatched, settings=PACK_SETTINGS
    )


IN_TIME = "l_orderkey = o_orderkey AND l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 90 DAY"
INTERVAL_COLUMNS = """l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate AS shipped,
    o_orderkey, o_custkey, o_orderdate AS placed"""


@query(f"SELECT {INTERVAL_COLUMNS} FROM lineitem JOIN orders ON {IN_TIME}")
def stream_stream_interval(spark, sf_dir):
    return shipped_in_time(spark, sf_dir, "inner")


@query(
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate AS shipped FROM lineitem
    WHERE EXISTS (SELECT 1 FROM orders WHERE {IN_TIME})"""
)
def stream_stream_semi(spark, sf_dir):
    return shipped_in_time(spark, sf_dir, "left_semi")


@query(
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate AS shipped FROM lineitem
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE {IN_TIME}) AND l_shipdate <
        least((SELECT max(l_shipdate) FROM lineitem), (SELECT max(o_orderdate) FROM orders))
        - INTERVAL 10 DAY"""
)
def stream_stream_anti(spark, sf_dir):
    """Items without an order in time, released once the watermark has passed their last chance."""
    return shipped_in_time(spark, sf_dir, "left_anti")


# Rows without a partner come out once the watermark, which trails the slower stream, has
# passed the last moment at which a partner could still have arrived.
WATERMARK = """(SELECT least((SELECT max(l_shipdate) FROM lineitem),
    (SELECT max(o_orderdate) FROM orders)) - INTERVAL 10 DAY)"""


@query(
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate AS shipped,
        coalesce(o_custkey, -1) AS o_custkey, o_orderdate AS placed
    FROM lineitem LEFT JOIN orders ON {IN_TIME}
    WHERE o_orderkey IS NOT NULL OR l_shipdate < {WATERMARK}"""
)
def stream_stream_left(spark, sf_dir):
    joined = shipped_in_time(spark, sf_dir, "left").drop("o_orderkey")
    return joined.fillna(-1, ["o_custkey"])


def labels_in_time(spark, sf_dir, how):
    """Documents, a minute apart, and the labels that follow them within an hour.

    Toxic labels take two hours and come too late. A right or full join must see all
    partners of a kept row in one place, so hot keys could not be spread; here the key is
    unique on both sides.
    """
    second = F.col("doc_id") * 60 + F.lit(1_704_067_200)
    written = F.timestamp_seconds(second)
    labelled = F.timestamp_seconds(second + F.col("toxic") * 7200 + 60)
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id"), written.alias("written")
    )
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("labelled_id"), labelled.alias("labelled")
    )
    slices = range_count([documents, labels], JOIN_ROWS)
    documents = in_time_order(documents, "written", slices)
    labels = in_time_order(labels, "labelled", slices)
    joined = spread_join(
        documents.withWatermark("written", "10 minutes"),
        labels.withWatermark("labelled", "10 minutes"),
        "doc_id",
        "labelled_id",
        how,
        within=F.expr("labelled BETWEEN written AND written + INTERVAL 1 HOUR"),
    )
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("written", "labelled")}
    return run_to_table(joined.withColumns(times).fillna(-1, ["doc_id", "labelled_id"]))


LABELLED_SQL = """WITH d AS (SELECT doc_id,
        TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id * 60) AS written FROM documents),
    l AS (SELECT doc_id AS labelled_id, TIMESTAMP '2024-01-01 00:00:00'
        + to_seconds(doc_id * 60 + toxic * 7200 + 60) AS labelled FROM labels),
    w AS (SELECT least((SELECT max(written) FROM d), (SELECT max(labelled) FROM l))
        - INTERVAL 10 MINUTE AS mark)
    SELECT coalesce(doc_id, -1) AS doc_id, written, coalesce(labelled_id, -1) AS labelled_id,
        labelled
    FROM d {how} JOIN l ON doc_id = labelled_id
        AND labelled BETWEEN written AND written + INTERVAL 1 HOUR
    WHERE (doc_id IS NOT NULL AND labelled_id IS NOT NULL)
        OR (doc_id IS NULL AND labelled < (SELECT mark FROM w))
        OR (labelled_id IS NULL AND written + INTERVAL 1 HOUR < (SELECT mark FROM w))"""


@query(LABELLED_SQL.format(how="RIGHT"))
def stream_stream_right(spark, sf_dir):
    return labels_in_time(spark, sf_dir, "right")


@query(LABELLED_SQL.format(how="FULL"))
def stream_stream_full(spark, sf_dir):
    return labels_in_time(spark, sf_dir, "full")


@query(
    """SELECT event_id, event_type FROM events WHERE event_type = 'click'
    UNION ALL SELECT event_id, event_type FROM events WHERE event_type = 'purchase'"""
)
def stream_union(spark, sf_dir):
    kinds = [
        table_stream(spark, sf_dir, "events")
        .filter(F.col("event_type") == kind)
        .select("event_id", "event_type")
        for kind in ("click", "purchase")
    ]
    return run_to_table(kinds[0].unionByName(kinds[1]))
