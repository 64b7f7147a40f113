"""Equi-joins between tables and streams, with hot keys spread over several tasks.

Whether a side is broadcast is left to Spark, which compares its size statistics with
``spark.sql.autoBroadcastJoinThreshold``. Adaptive execution splits skewed partitions of
static joins. Stateful stream joins have no such help; for them the caller may name hot keys,
known from earlier batches or from :func:`heavy_keys` over a sample period, to be salted.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Collection, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from millrace.operators.timed_joins import Span, packed_timed_join

# Repeating the right side for a hot key is only right when unmatched right rows are not kept.
SALTABLE = ("inner", "left", "left_semi", "left_anti")
MERGE_GROUPS = 512
#: Groups of buckets that a micro-batch is divided into for packing, at most.
PACK_GROUPS = 256
#: Rows of one pack at most, and bytes of rows that a task holds while it packs them.
PACK_ROWS = 1024
PACK_BYTES = 64 << 20
#: For a query that packs narrow rows: Spark adds up an Arrow batch's bytes at every row unless they
#: are unlimited, which costs more than the packing. Its limit of rows in a batch remains.
PACK_SETTINGS = {"spark.sql.execution.arrow.maxBytesPerBatch": str(2**31 - 1)}


def heavy_keys(df: DataFrame, key: str, min_share: float | None = None) -> dict:
    """Values of ``key`` in a static table that are too large for one task, with their share.

    By default that is more than one core's fair share of the rows. One pass over one column
    makes a frequent-items sketch per task; the sketches are merged in two levels, and at
    most ``1 / min_share`` values come back. The result steers parallelism only: a value
    missed or listed needlessly changes no query result.
    """
    if min_share is None:
        min_share = 1 / max(100, df.sparkSession.sparkContext.defaultParallelism)
    limit = max(1, round(1 / min_share))
    tracked = 10 * limit
    sketches = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(`{key}`, {tracked})").alias("sketch"),
        F.count(F.lit(1)).alias("rows"),
    )
    # Combining no sketches at all is an error in Spark, so the merge is grouped too: an
    # empty table then gives no row.
    found = sketches.groupBy(F.lit(0).alias("all")).agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {limit})").alias(
            "top"
        ),
        F.sum("rows").alias("rows"),
    ).first()
    if found is None:
        return {}
    return {
        entry["item"]: entry["count"] / found["rows"]
        for entry in found["top"]
        if entry["count"] >= min_share * found["rows"]
    }


def listed(key: Column, values: Collection) -> Column:
    """Is the key among the values? Never NULL; a ``None`` in the list stands for NULL keys."""
    present = [value for value in values if value is not None]
    found = F.coalesce(key.isin(present), F.lit(False)) if present else F.lit(False)
    return found | key.isNull() if None in values else found


def _salt_count(key: Column, hot: Mapping, partitions: int) -> Column:
    """Tasks to use for a key: the share of all partitions that its rows are of all rows.

    Rounded up to a power of two, so that keys fall into few groups. The counts of all hot
    keys add up to a small multiple of ``partitions``, however many keys there are.
    """
    groups = defaultdict(list)
    for value, share in hot.items():
        groups[2 ** max(1, math.ceil(math.log2(max(2.0, share * partitions))))].append(value)
    count = F.lit(1)
    for salts, values in groups.items():
        count = F.when(listed(key, values), F.lit(salts)).otherwise(count)
    return count


def _packer(bucket: str, group: str) -> Callable:
    """The packing function of a task; it needs nothing of this package there."""
    most_rows, most_bytes = PACK_ROWS, PACK_BYTES

    def entries(batches):
        rows = pa.Table.from_batches(batches).combine_chunks()
        order = np.argsort(rows[bucket].to_numpy(), kind="stable")
        rows = rows.take(pa.array(order)).combine_chunks()
        buckets = rows[bucket].to_numpy()
        first = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])
        place = np.arange(len(buckets)) - np.repeat(first, np.diff(np.r_[first, len(buckets)]))
        starts = np.flatnonzero(place % most_rows == 0)
        offsets = pa.array(np.r_[starts, len(buckets)], pa.int32())
        names = [name for name in rows.column_names if name != bucket]
        lists = []
        for name in names:
            values = pa.concat_arrays(rows[name].chunks)
            of_values = pa.list_(pa.field("element", values.type))
            lists.append(pa.ListArray.from_arrays(offsets, values, type=of_values))
        fields = [pa.field(name, one.type) for name, one in zip(names, lists, strict=True)]
        packed = pa.StructArray.from_arrays(lists, fields=fields)
        return pa.RecordBatch.from_arrays([pa.array(buckets[starts]), packed], ["bucket", "rows"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch.drop_columns([group]))
                size += batch.nbytes
            if size >= most_bytes:
                yield entries(held)
                held, size = [], 0
        if held:
            yield entries(held)

    return pack


def _packed(df: DataFrame, bucket: Column, buckets: int, names: Sequence[str]) -> DataFrame:
    """The rows of a bucket in a micro-batch as one entry with a list per column.

    An entry has PACK_ROWS rows at most; ``names`` are those of the bucket and of the lists.
    """
    number, group = (f"_{kind}_{'_'.join(df.columns)}" for kind in ("bucket", "group"))
    rows = StructType()
    for field in df.schema.fields:
        rows.add(field.name, ArrayType(field.dataType))
    schema = StructType().add("bucket", "long").add("rows", rows)
    numbered = df.withColumn(number, bucket)
    grouped = numbered.withColumn(group, F.pmod(number, F.lit(min(buckets, PACK_GROUPS))))
    return grouped.groupBy(group).applyInArrow(_packer(number, group), schema).toDF(*names)


def _row_by_row(df: DataFrame, packed: str, columns: Sequence[str], name: str) -> DataFrame:
    """The rows of packed entries again, as structs."""
    lists = [F.col(packed).getField(column) for column in columns]
    others = [column for column in df.columns if column != packed]
    return df.select(F.explode(F.arrays_zip(*lists)).alias(name), *others)


def spread_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "inner",
    hot: Mapping | None = None,
    row_id: Sequence[str] = (),
    partitions: int | None = None,
    within: Column | Span | None = None,
    packed: int | None = None,
) -> DataFrame:
    """Join on one key; the left rows of ``hot`` keys are divided over several tasks.

    ``hot`` maps a key to its share of the left rows, as :func:`heavy_keys` returns it. The
    right rows of those keys are repeated once per salt, so each left row still meets all
    its partners exactly once. Pick the side that is unique, or nearly so, on the key as
    the right one. ``row_id`` names left columns that differ between the rows of a key.
    ``within`` adds a condition such as a time range.

    ``packed`` is for an inner join of streams that keeps all rows, where the entries of the
    state cost most of the time. Keys are hashed into that many buckets; the rows that a
    micro-batch brings to a bucket are one entry, entries meet by bucket, and their rows by key.
    Choose some 100 to 200 rows of both sides to a bucket over the life of the query. Event
    times are not kept for a watermark.

    With a :class:`Span` as ``within``, ``packed`` is for streams with watermarks and also for
    left, semi and anti joins: the watermark cuts the state as in Spark's own join. A bucket is
    then one entry, read and written in every micro-batch.
    """
    matches = F.col(left_key) == F.col(right_key)
    span = within if isinstance(within, Span) else None
    if packed is not None and span is None:
        if how != "inner":
            raise ValueError(f"rows cannot be packed in a {how} join")
        if left.schema[left_key].dataType != right.schema[right_key].dataType:
            raise ValueError("rows can be packed by keys of one type only")
    left_place, right_place = [left_key], [right_key]
    if hot:
        if how not in SALTABLE:
            raise ValueError(f"hot keys cannot be spread in a {how} join")
        if not row_id:
            raise ValueError("name the columns that tell the rows of a hot key apart")
        if partitions is None:
            partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        left_count = _salt_count(F.col(left_key), hot, partitions)
        left = left.withColumn("_left_salt", F.pmod(F.xxhash64(*row_id), left_count).cast("int"))
        right_count = _salt_count(F.col(right_key), hot, partitions)
        right = right.withColumn(
            "_right_salt", F.explode(F.sequence(F.lit(0), right_count - 1))
        )
        matches = matches & (F.col("_left_salt") == F.col("_right_salt"))
        left_place.append("_left_salt")
        right_place.append("_right_salt")
    if packed is not None and span is not None:
        places = list(zip(left_place, right_place, strict=True))
        joined = packed_timed_join(left, right, places, span, how, packed)
        return joined.drop("_left_salt", "_right_salt")
    if within is not None:
        matches = matches & (within if span is None else span.condition())
    if packed is not None:
        packs = [
            _packed(
                df.where(F.col(place[0]).isNotNull()),
                F.pmod(F.xxhash64(*place), F.lit(packed).cast("long")),
                packed,
                [f"_{side}_bucket", f"_{side}_rows"],
            )
            for df, place, side in ((left, left_place, "left"), (right, right_place, "right"))
        ]
        pairs = packs[0].join(packs[1], F.col("_left_bucket") == F.col("_right_bucket"))
        pairs = pairs.drop("_left_bucket", "_right_bucket")
        pairs = _row_by_row(pairs, "_left_rows", left.columns, "_left")
        pairs = _row_by_row(pairs, "_right_rows", right.columns, "_right")
        return pairs.select("_left.*", "_right.*").where(matches).drop("_left_salt", "_right_salt")
    return left.join(right, matches, how).drop("_left_salt", "_right_salt")


def stream_anti_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    within: Column | Span,
    packed: int | None = None,
) -> DataFrame:
    """Rows of a watermarked stream without a partner in another one, as a stream.

    Spark takes no anti join of two streams, since a row can be let go only when no partner can
    come any more. A left join keeps that state: ``within`` bounds the time of a partner, and
    once the watermark has passed it, a row that met none comes out with an empty right side.
    Matched rows come out of the join at once and are dropped here. With a :class:`Span` the
    rows may wait ``packed`` into that many buckets, as in :func:`spread_join`.
    """
    if packed is not None:
        if not isinstance(within, Span):
            raise ValueError("rows that wait are packed for a span of times only")
        return packed_timed_join(left, right, [(left_key, right_key)], within, "left_anti", packed)
    if isinstance(within, Span):
        within = within.condition()
    marked = right.withColumn("_partner", F.lit(True))
    joined = left.join(marked, (F.col(left_key) == F.col(right_key)) & within, "left")
    return joined.where(F.col("_partner").isNull()).select(*left.columns)
