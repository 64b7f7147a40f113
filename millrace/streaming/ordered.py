"""Keyed state that gives its rows out in order of event time."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Rows lie in the state as packed columns, many to an entry: an entry costs much more than a row.
WAITING = "at binary, tie binary, value binary"
KEPT = "timer long, recent binary"
PACKED = ("int64", "int64", "float64")


class OrderedMeans(StatefulProcessor):
    """Means of the last ``n`` rows of a key by (time, tie).

    Rows wait in a list state. One timer per key stands at its earliest waiting row; when the
    watermark passes it, the rows up to the watermark leave in order, CHUNK at a time, and the
    timer moves to the earliest row that is left. Between timers only the last n - 1 values
    stay beside the waiting rows. A missing value is NaN.
    """

    CHUNK = 10_000

    def __init__(self, key: str, time: str, tie: str, value: str, name: str, n: int) -> None:
        self.columns = [key, time, tie, value, name]
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", WAITING)
        self.kept = handle.getValueState("kept", KEPT)

    def _packed(self, columns: list[np.ndarray]) -> list[tuple]:
        starts = range(0, len(columns[0]), self.CHUNK)
        return [tuple(c[i:i + self.CHUNK].tobytes() for c in columns) for i in starts]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        earliest = None
        for frame in rows:
            if not len(frame):
                continue
            held = ("held_at", "held_tie", "held_value")
            columns = [frame[c].to_numpy(kind) for c, kind in zip(held, PACKED)]
            self.waiting.appendList(self._packed(columns))
            first = int(columns[0].min())
            earliest = first if earliest is None else min(earliest, first)
        if earliest is not None:
            # The watermark must have passed the whole millisecond.
            at = earliest // 1000
            timer, recent = self.kept.get() or (None, b"")
            if timer is None or at < timer:
                if timer is not None:
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(at)
                self.kept.update((at, recent))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = timerValues.getCurrentWatermarkInMs() * 1000
        entries = [tuple(row) for row in self.waiting.get()]
        columns = [
            np.frombuffer(b"".join(row[i] for row in entries), kind) for i, kind in enumerate(PACKED)
        ]
        is_due = columns[0] <= until
        left = [c[~is_due] for c in columns]
        at, tie, value = (c[is_due] for c in columns)
        order = np.lexsort((tie, at))
        at, tie, value = at[order], tie[order], value[order]
        kept = self.kept.get()
        window = np.concatenate([np.frombuffer(kept[1] if kept else b"", "float64"), value])
        timer = None
        if len(left[0]):
            timer = int(left[0].min()) // 1000
            self.waiting.put(self._packed(left))
            self.handle.registerTimer(timer)
        else:
            self.waiting.clear()
        self.kept.update((timer, window[max(0, len(window) - (self.n - 1)):].tobytes()))
        values = window.tolist()
        whole = max(0, len(values) - self.n + 1)
        skipped = len(at) - whole
        for i in range(0, whole, self.CHUNK):
            means = [self._mean(values[j:j + self.n]) for j in range(i, min(whole, i + self.CHUNK))]
            rows = slice(skipped + i, skipped + i + len(means))
            times = pd.DatetimeIndex(at[rows].view("datetime64[us]"), tz="UTC")
            data = ([key[0]] * len(means), times, tie[rows], value[rows], np.array(means, "float64"))
            yield pd.DataFrame(dict(zip(self.columns, data)))

    def _mean(self, frame: list[float]) -> float:
        present = [v for v in frame if v == v]
        return math.fsum(present) / len(present) if present else math.nan

    def close(self) -> None:
        pass


def ordered_rolling_means(
    df: DataFrame, key: str, time: str, delay: str, tie: str, value: str, n: int, name: str = "mean"
) -> DataFrame:
    """``key, time, tie, value, mean`` of the last ``n`` rows per key by ``time`` and ``tie``.

    Unlike ``rolling_means_by_state``, which drops what comes after a later row was used, this
    holds rows back until the watermark, ``delay`` behind the newest ``time``, has passed them;
    so rows may come in any order within the delay and the result is that of the table. Rows
    behind the watermark are late and dropped. Equal rows of (time, tie) are taken in the order
    in which they came. NULL values count as rows of the frame, not in the mean; rows without a
    time or tie are left out. ``tie`` is a whole number.
    """
    kind = df.schema[key].dataType.simpleString()
    rows = df.withWatermark(time, delay).where(F.col(time).isNotNull() & F.col(tie).isNotNull()).select(
        F.col(key), F.col(time), F.unix_micros(time).alias("held_at"), F.col(tie).cast("long").alias("held_tie"),
        F.col(value).cast("double").alias("held_value"),
    )
    output = f"`{key}` {kind}, `{time}` timestamp, `{tie}` long, `{value}` double, `{name}` double"
    return rows.groupBy(key).transformWithStateInPandas(
        OrderedMeans(key, time, tie, value, name, n), output, "append", "eventTime"
    )
