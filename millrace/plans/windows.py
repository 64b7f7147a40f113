"""Event-time, arrival-time and processing-time windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators import windows
from millrace.plans.registry import query
from millrace.sources.replay import in_time_order
from millrace.sources.tables import table, table_stream
from millrace.streaming.runtime import run_to_table, run_to_table_with_watermark


def value_total():
    return {"total": ("sum", F.col("value"))}


def row_count():
    return {"count": ("count", F.lit(1))}


def rounded(totals):
    return totals.withColumn("total", F.round("total", 4))


def arrivals(spark, sf_dir):
    """Conversation turns as lines that arrive in order, ten seconds between conversations."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    second = F.col("conv_id") * 10 + F.col("turn")
    arrived = F.timestamp_seconds(second + F.lit(1_704_067_200))
    lines = turns.select(arrived.alias("arrived"), F.col("text").alias("value"))
    return in_time_order(lines, "arrived", text="value")


ARRIVALS_SQL = """(SELECT TIMESTAMP '2024-01-01 00:00:00'
    + to_seconds(conv_id * 10 + turn) AS arrived, text AS value FROM conversations)"""


def sliding_sql(select: str, source: str, time: str, seconds: int, slide: int, keys: str = ""):
    """Windows as the series of starts that cover each row."""
    by = f", {keys}" if keys else ""
    return f"""SELECT start, start + to_seconds({seconds}) AS "end"{by}, {select} FROM (
        SELECT *, unnest(generate_series(
            time_bucket(to_seconds({slide}), {time}) - to_seconds({seconds - slide}),
            time_bucket(to_seconds({slide}), {time}),
            to_seconds({slide}))) AS start FROM {source})
    GROUP BY start{by}"""


def closed_sql(totals: str, source: str, time: str, delay: str):
    """The windows that a watermark behind the last row by ``delay`` has passed."""
    return f"""SELECT * FROM ({totals})
        WHERE "end" <= (SELECT max({time}) - INTERVAL {delay} FROM {source})"""


def closed_sliding(df, time, delay, width, slide, measures, keys=()):
    """Buckets and windows that leave the state once the watermark has passed them."""
    totals = windows.closed_sliding_windows(df, time, delay, width, slide, measures, keys)
    return run_to_table(without_zone(totals))


def sliding_stream(df, time, width, slide, measures, keys=()):
    """Keep slide-sized buckets as stream state and derive the windows from the result."""
    buckets = run_to_table(windows.bucket_totals(df, time, slide, measures, keys), "complete")
    return windows.windows_from_buckets(buckets, width, slide, measures, keys)


DAY_TOTALS_SQL = """SELECT date_trunc('day', ts) AS start,
    date_trunc('day', ts) + INTERVAL 1 DAY AS "end", round(sum(value), 4) AS total
    FROM events GROUP BY ALL"""
SLIDING_TOTALS_SQL = sliding_sql("round(sum(value), 4) AS total", "events", "ts", 86400, 3600)
DAY_ITEMS_SQL = """SELECT date_trunc('day', ts) AS start,
    date_trunc('day', ts) + INTERVAL 1 DAY AS "end", event_type, round(sum(value), 4) AS total
    FROM events GROUP BY ALL"""
SLIDING_ITEMS_SQL = sliding_sql(
    "round(sum(value), 4) AS total", "events", "ts", 86400, 3600, "event_type"
)


def top_sql(totals: str) -> str:
    return f"""SELECT start, "end", event_type, total FROM ({totals}) QUALIFY row_number()
        OVER (PARTITION BY start ORDER BY total DESC, event_type) = 1"""


@query(DAY_TOTALS_SQL)
def window_tumbling_sum(spark, sf_dir):
    events = table_stream(spark, sf_dir, "events")
    totals = windows.window_totals(events, "ts", "1 day", value_total())
    return rounded(run_to_table(totals, "complete"))


@query(DAY_TOTALS_SQL)
def window_tumbling_sum_static(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return rounded(windows.window_totals(events, "ts", "1 day", value_total()))


@query(SLIDING_TOTALS_SQL)
def window_sliding_sum(spark, sf_dir):
    events = table_stream(spark, sf_dir, "events")
    return rounded(sliding_stream(events, "ts", "1 day", "1 hour", value_total()))


@query(SLIDING_TOTALS_SQL)
def window_sliding_sum_static(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return rounded(windows.sliding_totals(events, "ts", "1 day", "1 hour", value_total()))


def day_items(spark, sf_dir):
    events = table_stream(spark, sf_dir, "events")
    totals = windows.window_totals(events, "ts", "1 day", value_total(), ["event_type"])
    return rounded(run_to_table(totals, "complete"))


def sliding_items(spark, sf_dir):
    events = table_stream(spark, sf_dir, "events")
    return rounded(
        sliding_stream(events, "ts", "1 day", "1 hour", value_total(), ["event_type"])
    )


@query(DAY_ITEMS_SQL)
def window_rank_day(spark, sf_dir):
    return windows.ranked(day_items(spark, sf_dir), "total")


@query(top_sql(DAY_ITEMS_SQL))
def window_top1_day(spark, sf_dir):
    return windows.top_per_window(day_items(spark, sf_dir), "event_type", "total")


@query(SLIDING_ITEMS_SQL)
def window_rank_24h(spark, sf_dir):
    return windows.ranked(sliding_items(spark, sf_dir), "total")


@query(top_sql(SLIDING_ITEMS_SQL))
def window_top1_24h(spark, sf_dir):
    return windows.top_per_window(sliding_items(spark, sf_dir), "event_type", "total")


@query("SELECT CAST(sum(length(text)) AS BIGINT) AS total_chars FROM documents")
def processing_time_chars(spark, sf_dir):
    """Line lengths per ten seconds of processing time, added up to be comparable."""
    documents = windows.with_arrival(table_stream(spark, sf_dir, "documents").select("text"))
    length = {"chars": ("sum", F.length("text"))}
    totals = windows.window_totals(documents, "arrived", "10 seconds", length)
    return run_to_table(totals, "complete").agg(F.sum("chars").alias("total_chars"))


@query(
    """SELECT start, start + INTERVAL 1 HOUR AS "end", event_type, count(*) AS count
    FROM (SELECT date_trunc('hour', ts) AS start, event_type FROM events)
    WHERE start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)
    GROUP BY start, event_type"""
)
def watermark_window_count(spark, sf_dir):
    counts = windows.closed_windows(
        zoned_events(spark, sf_dir), "ts", "2 hours", "1 hour", row_count(), ["event_type"]
    )
    return run_to_table(without_zone(counts))


def zoned_events(spark, sf_dir):
    """Watermarks need time stamps with a zone; the session is in UTC."""
    events = in_time_order(table(spark, sf_dir, "events"), "ts")
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def without_zone(totals):
    return totals.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@query(
    f"""SELECT * FROM ({SLIDING_TOTALS_SQL})
    WHERE "end" <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)"""
)
def window_sliding_closed(spark, sf_dir):
    totals = windows.closed_sliding_windows(
        zoned_events(spark, sf_dir), "ts", "2 hours", "1 day", "1 hour", value_total()
    )
    return rounded(run_to_table(without_zone(totals)))


TEXT_SUM_SQL = sliding_sql(
    "CAST(sum(length(value)) AS BIGINT) AS chars", ARRIVALS_SQL, "arrived", 10, 5
)


@query(closed_sql(TEXT_SUM_SQL, ARRIVALS_SQL, "arrived", "20 SECOND"))
def window_text_sum(spark, sf_dir):
    length = {"chars": ("sum", F.length("value"))}
    return closed_sliding(
        arrivals(spark, sf_dir), "arrived", "20 seconds", "10 seconds", "5 seconds", length
    )


@query(
    """SELECT start, start + INTERVAL 1 DAY AS "end", ts, event_id FROM (
        SELECT ts, event_id, unnest([time_bucket(INTERVAL 12 HOUR, ts),
            time_bucket(INTERVAL 12 HOUR, ts) - INTERVAL 12 HOUR]) AS start FROM events)"""
)
def window_rows(spark, sf_dir):
    events = table_stream(spark, sf_dir, "events").select("ts", "event_id")
    return run_to_table(windows.window_rows(events, "ts", "1 day", "12 hours"))


def closed_by_difference(df, time, delay, width, slide, measures, keys=()):
    """Closed buckets from the stream, and the closed windows from them.

    A bucket leaves the state once; the watermark it ended with says which windows are whole.
    """
    marked = df if delay is None else df.withWatermark(time, delay)
    buckets = windows.bucket_totals(marked, time, slide, measures, keys)
    closed, mark = run_to_table_with_watermark(buckets)
    until = F.lit(mark).cast("timestamp")
    return without_zone(
        windows.windows_by_difference(closed, width, slide, list(measures), keys, until)
    )


@query(closed_sql(sliding_sql("count(*) AS count", "events", "ts", 3600, 30), "events", "ts", "1 HOUR"))
def window_count(spark, sf_dir):
    events = zoned_events(spark, sf_dir)
    return closed_by_difference(events, "ts", "1 hour", "60 minutes", "30 seconds", row_count())


@query(
    """SELECT start, start + INTERVAL 1 DAY AS "end", event_type, total,
        CAST(row_number() OVER (PARTITION BY start ORDER BY total DESC, event_type) AS INTEGER) AS rank
    FROM (SELECT date_trunc('day', ts) AS start, event_type, round(sum(value), 4) AS total
        FROM events GROUP BY ALL)
    WHERE start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)
    QUALIFY rank <= 3"""
)
def window_top3_closed(spark, sf_dir):
    """The three leading event types of each closed day, ranked inside the stream."""
    top = windows.closed_top(
        zoned_events(spark, sf_dir), "ts", "2 hours", "1 day", "event_type", F.col("value"), k=3
    )
    return rounded(run_to_table(without_zone(top)))


@query(
    """SELECT start, start + INTERVAL 1 DAY AS "end", event_type, total FROM (
        SELECT date_trunc('day', ts) AS start, event_type, round(sum(value), 4) AS total
        FROM events GROUP BY ALL)
    WHERE start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)
    QUALIFY row_number() OVER (PARTITION BY start ORDER BY total DESC, event_type) = 1"""
)
def window_top1_closed(spark, sf_dir):
    """The leading event type of each closed day; one row of state per open day and step."""
    top = windows.closed_top(
        zoned_events(spark, sf_dir), "ts", "2 hours", "1 day", "event_type", F.col("value")
    )
    return rounded(run_to_table(without_zone(top).drop("rank")))


DISTINCT_USERS_SQL = sliding_sql("count(DISTINCT user_id) AS users", "events", "ts", 86400, 3600)


@query(
    f"""SELECT start, "end", true AS close FROM ({DISTINCT_USERS_SQL})
    WHERE "end" <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)"""
)
def window_distinct_sketch(spark, sf_dir):
    """Distinct users per day and hour of start, each estimate held against the exact count.

    ``close`` allows four standard errors.
    """
    users = windows.closed_sliding_distinct(
        zoned_events(spark, sf_dir), "ts", "2 hours", "1 day", "1 hour", "user_id"
    )
    estimated = run_to_table(without_zone(users))
    by_hour = table(spark, sf_dir, "events").select(F.date_trunc("hour", "ts").alias("ts"), "user_id").distinct()
    exact = by_hour.groupBy(F.window("ts", "1 day", "1 hour")).agg(F.countDistinct("user_id").alias("users"))
    exact = exact.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "users")
    close = F.abs(F.col("distinct") - F.col("users")) <= F.greatest(F.lit(1), F.col("users") * 0.065)
    return estimated.join(exact, "start").select("start", "end", close.alias("close"))


ARRIVED_WORDS_SQL = f"""(SELECT arrived, word FROM
    (SELECT arrived, unnest(string_split(value, ' ')) AS word FROM {ARRIVALS_SQL})
    WHERE word <> '')"""


def arrived_words(spark, sf_dir):
    return text.words(arrivals(spark, sf_dir))


def closed_words_sql(totals):
    # A line without a word still moves the clock.
    return closed_sql(totals, ARRIVALS_SQL, "arrived", "20 SECOND")


@query(closed_words_sql(sliding_sql("count(*) AS count", ARRIVED_WORDS_SQL, "arrived", 60, 30, "word")))
def window_word_count(spark, sf_dir):
    marked = arrivals(spark, sf_dir).withWatermark("arrived", "20 seconds")
    return closed_by_difference(
        text.words(marked), "arrived", None, "60 seconds", "30 seconds", row_count(), ["word"]
    )


def closed_words(spark, sf_dir, width, slide, measures, keys=(), prepare=None):
    """The watermark is set on the lines, before any word is left out."""
    marked = arrivals(spark, sf_dir).withWatermark("arrived", "20 seconds")
    found = text.words(marked)
    found = prepare(found) if prepare else found
    return closed_sliding(found, "arrived", None, width, slide, measures, keys)


LONG_WORDS_SQL = f"(SELECT * FROM {ARRIVED_WORDS_SQL} WHERE length(word) >= 10)"


def long_words(words):
    return words.filter(F.length("word") >= 10)


@query(closed_words_sql(sliding_sql("count(*) * 2 AS score", LONG_WORDS_SQL, "arrived", 30, 10)))
def window_word_score(spark, sf_dir):
    """Two points for each word of ten characters or more."""
    scored = closed_words(spark, sf_dir, "30 seconds", "10 seconds", row_count(), prepare=long_words)
    return scored.select("start", "end", (F.col("count") * 2).alias("score"))


@query(
    closed_words_sql(
        sliding_sql(
            "count(*) * 2 AS score", f"(SELECT *, 'expensive' AS class FROM {LONG_WORDS_SQL})",
            "arrived", 30, 10, "class",
        )
    )
)
def window_word_score_by_class(spark, sf_dir):
    """The same score as a sum of points per class of word."""

    def classed(words):
        is_long = F.length("word") >= 10
        return long_words(words).select(
            "arrived",
            F.when(is_long, "expensive").otherwise("cheap").alias("class"),
            F.when(is_long, 2).otherwise(1).alias("points"),
        )

    points = {"score": ("sum", F.col("points"))}
    return closed_words(spark, sf_dir, "30 seconds", "10 seconds", points, ["class"], classed)
