"""Mean over the last n rows of each key.

A plain window function sends every row of a key to one task. Here all rows are cut, in key
and row order, into ranges of about equal size, whatever the keys; each range also receives
the n - 1 rows of its first key before its start, so every row still sees its full frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.sources.tables import stored


def last_rows(df: DataFrame, key: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The newest n rows per key. Spark cuts each task's rows to n before the shuffle."""
    newest_first = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in order])
    numbered = df.withColumn("_age", F.row_number().over(newest_first))
    return numbered.filter(F.col("_age") <= n).drop("_age")


def _full_frame_means(
    df: DataFrame, key: Sequence[str], order: Sequence[str], value: str, n: int, name: str
) -> DataFrame:
    ordered = Window.partitionBy(*key).orderBy(*order)
    return (
        df.withColumn(name, F.avg(value).over(ordered.rowsBetween(1 - n, 0)))
        .withColumn("_position", F.row_number().over(ordered))
        .filter(F.col("_position") >= n)
        .drop("_position")
    )


def _segments(
    df: DataFrame, key: str, order: Sequence[str], segments: int | None
) -> DataFrame:
    """Cut the rows, in key and row order, into consecutive segments of about equal size.

    Range partitioning samples the data for its bounds, so the numbered rows are written
    out once and every later step sees the same segments.
    """
    columns = [key, *order]
    ranged = (
        df.repartitionByRange(*columns)
        if segments is None
        else df.repartitionByRange(segments, *columns)
    )
    return stored(ranged.withColumn("_segment", F.spark_partition_id()), "segments")


def _carried_rows(segmented: DataFrame, key: str, order: Sequence[str], n: int) -> DataFrame:
    """For every segment the n - 1 rows of the same key that come before it.

    Those rows are among the last n - 1 rows of the earlier segments, a set whose size
    depends on the number of segments and not on the number of rows.
    """
    tails = last_rows(segmented, [key, "_segment"], order, n - 1).withColumn(
        "_position",
        F.row_number().over(Window.partitionBy(key).orderBy("_segment", *order)),
    )
    first = tails.groupBy(key, "_segment").agg(F.min("_position").alias("_first"))
    wanted = first.filter(F.col("_first") > 1).select(
        key,
        "_segment",
        F.explode(
            F.sequence(F.greatest(F.lit(1), F.col("_first") - (n - 1)), F.col("_first") - 1)
        ).alias("_position"),
    )
    same = F.col(f"t.{key}").eqNullSafe(F.col(f"w.{key}")) & (
        F.col("t._position") == F.col("w._position")
    )
    joined = wanted.alias("w").join(tails.drop("_segment").alias("t"), same)
    return joined.select("w._segment", "t.*").drop("_position")


def rolling_mean(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    n: int,
    name: str = "mean",
    segments: int | None = None,
) -> DataFrame:
    """Mean of the last ``n`` values per key, for rows that have n - 1 earlier ones.

    ``order`` must be a total order within a key. NULL values count as rows but not in the
    mean. ``segments`` is the number of ranges, by default that of shuffle partitions.
    """
    segmented = _segments(df, key, order, segments).withColumn("_carried", F.lit(False))
    if n > 1:
        carried = _carried_rows(segmented.drop("_carried"), key, order, n)
        segmented = segmented.unionByName(carried.withColumn("_carried", F.lit(True)))
    means = _full_frame_means(segmented, [key, "_segment"], order, value, n, name)
    return means.filter(~F.col("_carried")).drop("_carried", "_segment")
