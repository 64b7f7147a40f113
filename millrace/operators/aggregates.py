"""Aggregates that run once on a table and keep running on a stream.

All of them combine rows inside each task before the shuffle, so a key that holds a large
share of the input reaches its reducer as one partial result per task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def running_count(df: DataFrame, name: str = "line_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def average(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.avg(column).alias(name))


def count_by(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def numeric_aggregate(
    df: DataFrame,
    function: Callable[[Column], Column],
    column: str = "value",
    name: str = "result",
) -> DataFrame:
    """Apply any aggregate to text lines read as integers; other lines count as NULL."""
    return df.agg(function(F.col(column).try_cast("int")).alias(name))


def ratio_of_sums(
    df: DataFrame, key: str, numerator: str, denominator: str, name: str
) -> DataFrame:
    """Total over total per key: a weighted mean, not the mean of per-row ratios."""
    totals = df.groupBy(key).agg(
        F.sum(numerator).alias("_numerator"), F.sum(denominator).alias("_denominator")
    )
    return totals.select(key, F.try_divide("_numerator", "_denominator").alias(name))


def reduce_by(df: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """Reduce the rows of each key with the given aggregate expressions."""
    return df.groupBy(*keys).agg(*[a.alias(name) for name, a in aggregates.items()])


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct values; use it in update or complete mode on a stream.

    Written as a grouping, which drops repeats in each task before the shuffle. ``distinct``
    on a stream would shuffle every repeated row.
    """
    return count_by(df, *columns).select(*columns)


def distinct_within(df: DataFrame, time: str, horizon: str, *columns: str) -> DataFrame:
    """The first row of each value of ``columns``, as a stream whose state expires.

    A value is forgotten once the watermark, ``horizon`` behind the newest ``time``, is that much
    later than the row that was kept. Repeats at most ``horizon`` apart come out once; a
    value that stays away for longer may come out again.
    """
    return df.withWatermark(time, horizon).dropDuplicatesWithinWatermark(list(columns))


def approx_distinct(df: DataFrame, column: str, *keys: str, name: str = "distinct") -> DataFrame:
    """Distinct count by sketch, for streams where the exact count is not supported."""
    return df.groupBy(*keys).agg(F.approx_count_distinct(column).alias(name))
