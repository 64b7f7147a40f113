"""Tumbling, sliding and processing-time windows.

A sliding window of length ``width`` moved by ``slide`` covers each row ``width / slide``
times. When the ratio is whole, totals are first kept per slide-sized bucket and only the
buckets are repeated, so the repetition depends on the time span and not on the row count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A measure is a combining function and the expression it is applied to.
Measure = tuple[str, Column]

COMBINE = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
#: Time per chunk of a running sum, and changes that a task sums.
CHUNK_SECONDS = 6 * 3600
CHANGES_PER_TASK = 1_000_000
# Partial counts are added up; the other functions combine with themselves.
RECOMBINE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def _flat(windowed: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    return windowed.select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, *values
    )


def window_totals(
    df: DataFrame,
    time: str,
    width: str,
    measures: Mapping[str, Measure],
    keys: Sequence[str] = (),
    slide: str | None = None,
) -> DataFrame:
    """``start, end, keys…, measures…`` for every window that holds at least one row."""
    aggregates = [COMBINE[how](value).alias(name) for name, (how, value) in measures.items()]
    windowed = df.groupBy(F.window(time, width, slide), *keys).agg(*aggregates)
    return _flat(windowed, keys, list(measures))


def bucket_totals(
    df: DataFrame,
    time: str,
    slide: str,
    measures: Mapping[str, Measure],
    keys: Sequence[str] = (),
) -> DataFrame:
    """First step of a sliding window: partial totals per slide-sized bucket."""
    return window_totals(df, time, slide, measures, keys).drop("end")


def windows_from_buckets(
    buckets: DataFrame,
    width: str,
    slide: str,
    measures: Mapping[str, Measure],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Second step: combine bucket totals into overlapping windows.

    ``width`` must be a multiple of ``slide``; each bucket then lies wholly inside every
    window that contains its start.
    """
    parts = [RECOMBINE[how](name).alias(name) for name, (how, _) in measures.items()]
    windowed = buckets.groupBy(F.window("start", width, slide), *keys).agg(*parts)
    return _flat(windowed, keys, list(measures))


def sliding_totals(
    df: DataFrame,
    time: str,
    width: str,
    slide: str,
    measures: Mapping[str, Measure],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Both steps on a static table. A stream keeps buckets and derives windows on read."""
    buckets = bucket_totals(df, time, slide, measures, keys)
    return windows_from_buckets(buckets, width, slide, measures, keys)


def window_rows(df: DataFrame, time: str, width: str, slide: str | None = None) -> DataFrame:
    """Each row once per window it falls in. A projection: nothing is shuffled."""
    windowed = df.select(F.window(time, width, slide).alias("window"), "*")
    others = [c for c in df.columns if c != time]
    return _flat(windowed, [time], others)


def ranked(totals: DataFrame, total: str) -> DataFrame:
    """Windows in time order, the largest total first within each."""
    return totals.orderBy("start", F.desc(total))


def top_per_window(totals: DataFrame, item: str, total: str) -> DataFrame:
    """The item with the largest total in each window; the first by name on a tie."""
    best = F.min(F.struct((-F.col(total)).alias("_order"), F.col(item).alias("_item")))
    picked = totals.groupBy("start", "end").agg(best.alias("_best"))
    return picked.select(
        "start", "end", F.col("_best._item").alias(item), (-F.col("_best._order")).alias(total)
    )


def closed_windows(
    df: DataFrame,
    time: str,
    delay: str,
    width: str,
    measures: Mapping[str, Measure],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Totals per window for append mode: each window comes out once, when it is closed.

    The watermark trails the newest ``time`` by ``delay``. Rows behind it are dropped and
    windows behind it leave the state, which therefore stays bounded.
    """
    return window_totals(df.withWatermark(time, delay), time, width, measures, keys)


def closed_sliding_windows(
    df: DataFrame,
    time: str,
    delay: str | None,
    width: str,
    slide: str,
    measures: Mapping[str, Measure],
    keys: Sequence[str] = (),
) -> DataFrame:
    """The two steps of a sliding window as chained streaming aggregates, for append mode.

    Without a ``delay`` the stream already has its watermark.
    """
    first = [COMBINE[how](value).alias(name) for name, (how, value) in measures.items()]
    second = [RECOMBINE[how](name).alias(name) for name, (how, _) in measures.items()]
    marked = df if delay is None else df.withWatermark(time, delay)
    buckets = marked.groupBy(F.window(time, slide).alias("bucket"), *keys).agg(*first)
    windowed = buckets.groupBy(F.window("bucket", width, slide), *keys).agg(*second)
    return _flat(windowed, keys, list(measures))


def windows_by_difference(
    buckets: DataFrame,
    width: str,
    slide: str,
    measures: Sequence[str],
    keys: Sequence[str] = (),
    until: Column | None = None,
) -> DataFrame:
    """Sliding windows from bucket totals (``start, keys…, measures…``), for measures that can be
    taken back: sums of whole numbers and counts.

    A bucket enters with the first window that covers it and leaves behind the last one, so it
    is two rows, not one per window; a running sum over them is the total between two changes,
    which is then laid out window by window. Long series are summed in chunks of time: the
    chunks' own totals are few, and only these are added up from the beginning. Windows without
    a row are left out, and so are windows that end after ``until``.

    The changes are dealt once, by key and chunk, to as many tasks as their number asks for, so
    that a task's memory does not grow with the table; ``buckets`` are counted for it and should
    be stored.
    """
    spark = buckets.sparkSession
    tasks = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        -(-2 * buckets.count() // CHANGES_PER_TASK),
    )
    step, reach = F.expr(f"INTERVAL {slide}"), F.expr(f"INTERVAL {width}")
    enter = buckets.select(
        (F.col("start") - reach + step).alias("start"), *keys, F.lit(1).alias("_rows"), *measures
    )
    leave = buckets.select(
        (F.col("start") + step).alias("start"), *keys, F.lit(-1).alias("_rows"),
        *[(-F.col(m)).alias(m) for m in measures],
    )
    totals = ["_rows", *measures]
    chunk = F.floor(F.unix_seconds(F.col("start").cast("timestamp")) / CHUNK_SECONDS)
    changes = enter.unionByName(leave).withColumn("_chunk", chunk)
    changes = changes.repartition(tasks, *keys, "_chunk").groupBy("start", *keys, "_chunk").agg(
        *[F.sum(c).alias(c) for c in totals]
    )
    by = list(keys) or [F.lit(0)]
    before = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(1, 1)
    chunks = changes.groupBy(*keys, "_chunk").agg(
        *[F.sum(c).alias(f"_sum{c}") for c in totals], F.min("start").alias("_first")
    )
    if keys:
        chunks = chunks.repartition(tasks, *keys)
    chunks = chunks.select(
        *keys, "_chunk", F.max("_first").over(ahead).alias("_next"),
        *[F.coalesce(F.sum(f"_sum{c}").over(before), F.lit(0)).alias(f"_from{c}") for c in totals],
    )
    inside = Window.partitionBy(*keys, "_chunk").orderBy("start")
    running = (
        changes.withColumns({c: F.sum(c).over(inside) for c in totals})
        .withColumn("_after", F.lead("start").over(inside))
        .join(chunks, [*keys, "_chunk"])
    )
    levels = running.select(
        "start", F.coalesce("_after", "_next").alias("_after"), *keys,
        *[(F.col(c) + F.col(f"_from{c}")).cast("long").alias(c) for c in totals],
    ).where("_rows > 0")
    start = F.explode(F.sequence(F.col("start"), F.col("_after") - step, step))
    windows = levels.select(start.alias("start"), *keys, *measures)
    windows = windows.select("start", (F.col("start") + reach).alias("end"), *keys, *measures)
    return windows if until is None else windows.where(F.col("end") <= until)


def closed_top(
    df: DataFrame, time: str, delay: str, width: str, item: str, value: Column, total: str = "total", k: int = 1
) -> DataFrame:
    """The ``k`` items with the largest sums in each closed window, as a stream in append mode.

    Two chained aggregates: sums per window and item, and the first ``k`` of them once the
    watermark has closed the window. Both leave the state then. Equal sums go by name. Returns
    start, end, rank (from 1), the item and its sum.
    """
    sums = df.withWatermark(time, delay).groupBy(F.window(time, width).alias("_w"), item).agg(
        F.sum(value).alias(total)
    )
    row = F.struct((-F.col(total)).alias("_order"), F.col(item).alias("_item"))
    # One item needs one row of state; more need the items of the window.
    first = F.array(F.min(row)) if k == 1 else F.slice(F.array_sort(F.collect_list(row)), 1, k)
    best = sums.groupBy(F.window("_w", width).alias("window")).agg(first.alias("_best"))
    placed = best.select("window", F.posexplode("_best").alias("_place", "_row"))
    return placed.select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"),
        (F.col("_place") + 1).alias("rank"), F.col("_row._item").alias(item),
        (-F.col("_row._order")).alias(total),
    )


def closed_sliding_distinct(
    df: DataFrame, time: str, delay: str, width: str, slide: str, column: str, name: str = "distinct"
) -> DataFrame:
    """Estimated number of distinct values per closed sliding window, as a stream in append mode.

    One sketch per slide-sized bucket; the sketches of the buckets of a window are united, so a
    value is put into one sketch however many windows cover it. With 2^12 registers the
    standard error is about 1.6 percent.
    """
    buckets = df.withWatermark(time, delay).groupBy(F.window(time, slide).alias("bucket")).agg(
        F.hll_sketch_agg(column, 12).alias("sketch")
    )
    windowed = buckets.groupBy(F.window("bucket", width, slide)).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name)
    )
    return _flat(windowed, [], [name])


def with_arrival(df: DataFrame, name: str = "arrived") -> DataFrame:
    """Processing time: one value for all rows of a micro-batch."""
    return df.withColumn(name, F.current_timestamp())
