"""Keyed state, and rolling means as an example of it."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def keyed_state(
    df: DataFrame,
    keys: Sequence[str],
    update: Callable,
    output: str,
    state: str,
    ttl: bool = False,
    mode: str = "append",
) -> DataFrame:
    """Run ``update(key, chunks, state)`` once per key and micro-batch.

    It gets the rows of the key as an iterator of pandas frames and may yield any number of
    output frames. With ``ttl`` it may set a processing-time timeout on the state; such a
    query always has a next batch to run, so give it an interval trigger.
    """
    timeout = GroupStateTimeout.ProcessingTimeTimeout if ttl else GroupStateTimeout.NoTimeout
    return df.groupBy(*keys).applyInPandasWithState(update, output, state, mode, timeout)


# Order columns become numbers, which the state can keep and compare.
WHOLE = ("tinyint", "smallint", "int", "bigint")
TIMES = ("timestamp", "timestamp_ntz", "date")


def _as_number(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType.simpleString()
    if kind in WHOLE:
        return F.col(name).cast("long")
    if kind in TIMES:
        return F.unix_micros(F.col(name).cast("timestamp"))
    raise TypeError(f"cannot order a stream by {name}: {kind}")


def rolling_means_by_state(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    n: int,
    name: str = "mean",
    ttl_ms: int | None = None,
) -> DataFrame:
    """``key, order…, value, mean`` of the last ``n`` rows per key, held as keyed state.

    The rows of a key in a micro-batch are put in order first, so a rate limit on the source
    bounds what a task holds; between batches only n - 1 values and the last position stay.
    A row that comes after a later row of its key has been used is late and is dropped. A key
    emits nothing until it has n rows. NULL values count as rows but not in the mean. With
    ``ttl_ms`` a key that stays silent is forgotten.
    """
    kinds = {c: df.schema[c].dataType.simpleString() for c in [key, *order]}
    rows = df.select(
        key, *order, F.col(value).cast("double").alias(value),
        *[_as_number(df, c).alias(f"_at{i}") for i, c in enumerate(order)],
    )
    columns = [*(f"`{c}` {kind}" for c, kind in kinds.items()), f"`{value}` double", f"`{name}` double"]
    update = _state_update([key, *order, value], len(order), n, name, ttl_ms)
    state = "recent array<double>, last array<long>"
    return keyed_state(rows, [key], update, ", ".join(columns), state, ttl_ms is not None)


def _state_update(
    columns: Sequence[str], n_order: int, n: int, name: str, ttl_ms: int | None
) -> Callable:
    places = [f"_at{i}" for i in range(n_order)]

    def update(
        group: tuple, chunks: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        recent, last = (list(state.get[0]), list(state.get[1])) if state.exists else ([], [])
        rows = pd.concat(list(chunks), ignore_index=True).sort_values(places, ignore_index=True)
        if last:
            position = rows[places].itertuples(index=False, name=None)
            rows = rows[[list(at) > last for at in position]]
        if len(rows):
            last = [int(x) for x in rows[places].iloc[-1]]
        earlier = np.array([np.nan if v is None else v for v in recent], dtype="float64")
        values = np.concatenate([earlier, rows[columns[-1]].to_numpy("float64")])
        if len(values) >= n and len(rows):
            frames = np.lib.stride_tricks.sliding_window_view(values, n)
            counts = (~np.isnan(frames)).sum(axis=1)
            sums = np.nansum(frames, axis=1)
            means = np.divide(sums, counts, out=np.full(len(sums), np.nan), where=counts > 0)
            yield rows[list(columns)].iloc[len(rows) - len(means):].assign(**{name: means})
        kept = values[max(0, len(values) - (n - 1)):]
        state.update(([None if np.isnan(v) else float(v) for v in kept], last))
        if ttl_ms is not None:
            state.setTimeoutDuration(ttl_ms)

    return update
