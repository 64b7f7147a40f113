"""Joins of two streams with watermarks whose rows wait in the state packed by buckets of keys.

Spark's own join writes every row to the state and takes it out again, which costs more than all
else. Here a bucket of keys has one entry in the state: the waiting rows of both sides as records.
Each task packs its rows of a bucket before the shuffle, a micro-batch joins a bucket's records
at once, and the watermark cuts them as it cuts the state of Spark's join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructField, StructType

KINDS = ("inner", "left", "left_semi", "left_anti")
#: Types of columns that can be packed: that of a record's field and that of Arrow.
FIXED = {
    "boolean": ("?", pa.bool_()),
    "tinyint": ("<i1", pa.int8()), "smallint": ("<i2", pa.int16()),
    "int": ("<i4", pa.int32()), "bigint": ("<i8", pa.int64()),
    "float": ("<f4", pa.float32()), "double": ("<f8", pa.float64()),
    "date": ("<i4", pa.date32()), "timestamp": ("<i8", pa.timestamp("us", "UTC")),
    "timestamp_ntz": ("<i8", pa.timestamp("us")),
}
KEYS = ("tinyint", "smallint", "int", "bigint", "date", "timestamp", "timestamp_ntz")
#: Columns of both sides at most: a record has a bit for each, and one more.
MOST_COLUMNS = 63
#: Bytes of rows that a task holds while it packs them.
PACK_BYTES = 32 << 20
#: Pairs of rows with equal keys that are looked at together, and bytes of results in an entry.
STEP = 1 << 17
OUT_BYTES = 4 << 20


@dataclass(frozen=True)
class Span:
    """The time of a right row is ``earliest`` to ``latest`` milliseconds after the left row's.

    ``left`` and ``right`` name the columns with the event times.
    """

    left: str
    right: str
    earliest: int
    latest: int

    def condition(self) -> Column:
        first, last = (F.expr(f"INTERVAL '{ms / 1000:.3f}' SECOND") for ms in (self.earliest, self.latest))
        return F.col(self.right).between(F.col(self.left) + first, F.col(self.left) + last)


def _layout(fields: Sequence[StructField]) -> tuple[np.dtype, list[pa.DataType]]:
    """The record of some columns; ``flags`` has a bit for each column that is null."""
    kinds = [field.dataType.simpleString() for field in fields]
    if len(kinds) > MOST_COLUMNS or not all(kind in FIXED for kind in kinds):
        raise ValueError(f"cannot pack columns of the types {kinds}")
    record = [("flags", "<u8"), *((f"c{i}", FIXED[kind][0]) for i, kind in enumerate(kinds))]
    return np.dtype(record), [FIXED[kind][1] for kind in kinds]


def _packer(record: np.dtype, side: int, buckets: int) -> Callable:
    """Packs the rows of a task, whose last column is the bucket.

    Every task names every bucket, so that each of them learns of every watermark.
    """
    most = PACK_BYTES

    def entries(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(batches)
        bucket = rows.column(rows.num_columns - 1).to_numpy()
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        packed = np.zeros(len(order), record)
        for i, name in enumerate(record.names[1:]):
            column = rows.column(i).combine_chunks()
            kind = record[name]
            if pa.types.is_temporal(column.type):
                column = column.view(pa.int64() if kind.itemsize == 8 else pa.int32())
            if column.null_count:
                gone = column.is_null().to_numpy(zero_copy_only=False)[order]
                packed["flags"] |= gone.astype(np.uint64) << np.uint64(i)
                column = column.fill_null(False if kind.kind == "b" else 0)
            packed[name] = column.to_numpy(zero_copy_only=False)[order]
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        return of(bucket[starts], np.r_[starts, len(order)] * record.itemsize, packed)

    def of(numbers: np.ndarray, offsets: np.ndarray, packed: np.ndarray) -> pa.RecordBatch:
        buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(packed.tobytes())]
        binary = pa.Array.from_buffers(pa.binary(), len(numbers), buffers)
        sides = pa.array(np.full(len(numbers), side, np.int32))
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), sides, binary], ["bucket", "side", "rows"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = np.zeros(buckets, bool)
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
                named[batch.column(batch.num_columns - 1).to_numpy()] = True
            if size >= most:
                yield entries(held)
                held, size = [], 0
        if held:
            yield entries(held)
        others = np.flatnonzero(~named)
        yield of(others, np.zeros(len(others) + 1, np.int64), np.zeros(0, record))

    return pack


def _joiner(
    left: np.dtype, right: np.dtype, out: np.dtype, keys: Sequence[tuple[int, int]],
    times: tuple[int, int], span: Span, how: str, previous: bool,
) -> Callable:
    """The join of one bucket, called for every micro-batch with rows or a new watermark.

    ``keys`` are places of columns that must be equal, the first of them the key. With
    ``previous`` rows are late that the watermark before this micro-batch's had passed.
    """
    step, most = STEP, OUT_BYTES
    key_left, key_right = (f"c{i}" for i in keys[0])
    others = [(f"c{i}", f"c{j}") for i, j in keys[1:]]
    time_left, time_right = (f"c{i}" for i in times)
    null_key = np.uint64(1 << keys[0][0])
    met = np.uint64(1 << 63)
    first_ms, last_ms = span.earliest, span.latest
    width = len(left.names) - 1
    both = how in ("inner", "left")
    absent = np.uint64(((1 << len(right.names[1:])) - 1) << width)

    def pairs(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of rows that match, some at a time."""
        if not len(a) or not len(b):
            return
        order = np.argsort(b[key_right], kind="stable")
        held, wanted = b[key_right][order], np.ascontiguousarray(a[key_left])
        first = np.searchsorted(held, wanted, "left")
        number = np.searchsorted(held, wanted, "right") - first
        number[(a["flags"] & null_key) != 0] = 0
        some = np.flatnonzero(number)
        ends = np.cumsum(number[some])
        at_a, at_b = np.ascontiguousarray(a[time_left]), np.ascontiguousarray(b[time_right])
        at = 0
        while at < len(some):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + step, "right")))
            rows = some[at:to]
            count = number[rows]
            i = np.repeat(rows, count)
            j = np.arange(len(i)) + np.repeat(first[rows] - (ends[at:to] - count - done), count)
            j = order[j]
            gap = at_b[j] - at_a[i]
            near = (gap >= first_ms * 1000) & (gap <= last_ms * 1000)
            for x, y in others:
                near &= a[x][i] == b[y][j]
            if near.any():
                yield i[near], j[near]
            at = to

    def results(a: np.ndarray, b: np.ndarray | None = None) -> bytes:
        """Rows of the result; without ``b`` of left rows alone."""
        made = np.zeros(len(a), out)
        made["flags"] = a["flags"] & ~met
        for name in left.names[1:]:
            made[name] = a[name]
        if both and b is None:
            made["flags"] |= absent
        elif both:
            made["flags"] |= b["flags"] << np.uint64(width)
            for k, name in enumerate(right.names[1:]):
                made[f"c{width + k}"] = b[name]
        return made.tobytes()

    def found(l_new, r_new, l_held, r_held, now: int, kept: list) -> Iterator[bytes]:
        until_left, until_right = (now - last_ms - 1) * 1000, (now + first_ms - 1) * 1000
        # New left rows meet the waiting right rows, then wait unless it is too late for that;
        # new right rows meet all left rows that wait.
        matched = np.zeros(len(l_new), bool)
        for i, j in pairs(l_new, r_held):
            matched[i] = True
            if both:
                yield results(l_new[i], r_held[j])
        if how == "left_semi" and matched.any():
            yield results(l_new[matched])
        waits = l_new[time_left] > until_left
        if how in ("left", "left_anti") and (alone := ~waits & ~matched).any():
            yield results(l_new[alone])
        if not both:
            waits &= ~matched
        l_new["flags"] |= matched.astype(np.uint64) << np.uint64(63)
        l_held = np.concatenate([l_held, l_new[waits]])
        matched = (l_held["flags"] & met) != 0
        for i, j in pairs(l_held, r_new):
            matched[i] = True
            if both:
                yield results(l_held[i], r_new[j])
        if how == "left_semi" and matched.any():
            yield results(l_held[matched])
        gone = l_held[time_left] <= until_left
        if how in ("left", "left_anti") and (alone := gone & ~matched).any():
            yield results(l_held[alone])
        l_held["flags"] |= matched.astype(np.uint64) << np.uint64(63)
        l_held = l_held[~gone if both else ~gone & ~matched]
        r_held = np.concatenate([r_held, r_new])
        r_held = r_held[r_held[time_right] > until_right]
        kept += [l_held.tobytes(), r_held.tobytes()]

    def join(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        before, l_held, r_held = state.get if state.exists else (0, b"", b"")
        came: tuple[list, list] = ([], [])
        if not state.hasTimedOut:
            for frame in chunks:
                for side, rows in zip(frame["side"], frame["rows"], strict=True):
                    came[side].append(rows)
        l_new, r_new = (np.frombuffer(b"".join(c), kind) for c, kind in zip(came, (left, right), strict=True))
        late = (before if previous else now) * 1000
        l_new, r_new = l_new[l_new[time_left] > late], r_new[r_new[time_right] > late]
        l_held, r_held = np.frombuffer(l_held, left), np.frombuffer(r_held, right)
        kept, ready, size = [], [], 0
        for rows in found(l_new, r_new, l_held, r_held, now, kept):
            ready.append(rows)
            size += len(rows)
            if size >= most:
                yield pd.DataFrame({"rows": ready})
                ready, size = [], 0
        if ready:
            yield pd.DataFrame({"rows": ready})
        state.update((now, *kept))
        # Called again as soon as the watermark moves.
        state.setTimeoutTimestamp(max(1, now))

    return join


def _unpacker(record: np.dtype, kinds: list[pa.DataType], names: Sequence[str]) -> Callable:
    """Rows of packed results again."""
    most = OUT_BYTES

    def rows_of(entries: list[bytes]) -> pa.RecordBatch:
        rows = np.frombuffer(b"".join(entries), record)
        columns = []
        for i, kind in enumerate(kinds):
            gone = (rows["flags"] >> np.uint64(i)) & np.uint64(1) != 0
            column = pa.array(np.ascontiguousarray(rows[f"c{i}"]), mask=gone if gone.any() else None)
            columns.append(column.view(kind) if pa.types.is_temporal(kind) else column)
        return pa.RecordBatch.from_arrays(columns, list(names))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for entry in batch.column(0):
                held.append(entry.as_py())
                size += len(held[-1])
                if size >= most:
                    yield rows_of(held)
                    held, size = [], 0
        if held:
            yield rows_of(held)

    return unpack


def packed_timed_join(
    left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], span: Span, how: str,
    buckets: int,
) -> DataFrame:
    """Join of two streams with watermarks on equal ``keys`` and a span of times.

    The first pair of ``keys`` decides about NULL; the others never are. Rows go to a bucket by
    the hash of their keys. As in Spark's join of streams a row waits until the watermark, the
    lesser of both, has passed the last time at which a partner may come; left and anti joins
    release rows without a partner then. Rows without a time match nothing and never come out.
    Event times are not kept for a watermark.
    """
    if how not in KINDS:
        raise ValueError(f"rows that wait cannot be packed in a {how} join")
    sides = [(left, [k for k, _ in keys], span.left), (right, [k for _, k in keys], span.right)]
    for place, (df, _, time) in enumerate(sides):
        if df.schema[time].dataType.simpleString() != "timestamp":
            raise ValueError("rows are packed by zoned time stamps only")
        if df.schema[keys[0][place]].dataType.simpleString() not in KEYS:
            raise ValueError("rows are packed by keys that are whole numbers or times")
    if any(left.schema[a].dataType != right.schema[b].dataType for a, b in keys):
        raise ValueError("rows can be packed by keys of one type only")
    records, packs = [], []
    for side, (df, names, time) in enumerate(sides):
        record, _ = _layout(df.schema.fields)
        records.append(record)
        rows = df.where(F.col(time).isNotNull())
        code = F.xxhash64(*names)
        if side == 0 and how in ("left", "left_anti"):
            # Rows without a key only wait, so they may do so anywhere.
            code = F.when(F.col(names[0]).isNull(), F.xxhash64(*df.columns)).otherwise(code)
        else:
            rows = rows.where(F.col(names[0]).isNotNull())
        number = "_".join(["bucket", *df.columns])  # longer than any of them
        rows = rows.withColumn(number, F.pmod(code, F.lit(buckets).cast("long")))
        packs.append(rows.mapInArrow(_packer(record, side, buckets), "bucket long, side int, rows binary"))
    # The rows' watermarks are kept below; this column only says that there are some.
    marked = F.lit(None).cast("timestamp").alias("mark", metadata={"spark.watermarkDelayMs": 0})
    packed = packs[0].union(packs[1]).select("bucket", "side", "rows", marked)
    fields = [*left.schema.fields, *(right.schema.fields if how in ("inner", "left") else [])]
    out, kinds = _layout(fields)
    previous = left.sparkSession.conf.get("spark.sql.streaming.statefulOperator.allowMultiple", "true") == "true"
    join = _joiner(
        *records, out, [(left.columns.index(a), right.columns.index(b)) for a, b in keys],
        (left.columns.index(span.left), right.columns.index(span.right)), span, how, previous,
    )
    joined = packed.groupBy("bucket").applyInPandasWithState(
        join, "rows binary", "mark long, lefts binary, rights binary", "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    schema = StructType([StructField(f.name, f.dataType) for f in fields])
    names = [f"c{i}" for i in range(len(fields))]
    plain = StructType([StructField(n, f.dataType) for n, f in zip(names, fields, strict=True)])
    return joined.mapInArrow(_unpacker(out, kinds, names), plain).toDF(*schema.names)
