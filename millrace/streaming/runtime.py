"""Run a streaming DataFrame to a sink with a checkpoint of its own."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.session import new_folder, scoped_conf, state_settings
from millrace.sinks.batches import (
    BatchWriter,
    folder_per_batch,
    newest_version,
    replace_table,
)

# Everything that is there now, in as many micro-batches as the rate limit asks for.
AVAILABLE_NOW: Mapping[str, object] = {"availableNow": True}


def every(interval: str) -> dict[str, str]:
    """Trigger a micro-batch per interval."""
    return {"processingTime": interval}


def continuous(interval: str) -> dict[str, str]:
    """Continuous processing, for map-like queries between sources that support it."""
    return {"continuous": interval}


def start(
    df: DataFrame,
    *,
    mode: str = "append",
    format: str | None = None,
    writer: BatchWriter | None = None,
    rows=None,
    checkpoint: str | None = None,
    trigger: Mapping[str, object] = AVAILABLE_NOW,
    options: Mapping[str, str] | None = None,
    name: str | None = None,
    count_state: bool = False,
    idle_batches: bool = True,
    settings: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Start a query on exactly one sink: a format, a batch writer or a row writer.

    Two queries must not share a checkpoint; without one given a new folder is used.
    ``count_state`` makes the progress report show how many rows the state holds.
    ``idle_batches`` lets a moved watermark close windows and expire state without new
    input; a query that outputs nothing on expiry, such as an inner join, can do without.
    ``settings`` are further session options of this query.
    """
    if sum(sink is not None for sink in (format, writer, rows)) != 1:
        raise ValueError("give one of format, writer or rows")
    spark = df.sparkSession
    stream = (
        df.writeStream.outputMode(mode)
        .trigger(**trigger)
        .option("checkpointLocation", checkpoint or new_folder(spark, "checkpoint"))
        .options(**(options or {}))
    )
    if name is not None:
        stream = stream.queryName(name)
    if format is not None:
        stream = stream.format(format)
    elif writer is not None:
        stream = stream.foreachBatch(writer)
    else:
        stream = stream.foreach(rows)
    # A query copies the session settings when it starts.
    with scoped_conf(spark, {**state_settings(spark, count_state, idle_batches), **(settings or {})}):
        return stream.start()


def finish(
    query: StreamingQuery, timeout: float | None = None, grace: float = 60
) -> StreamingQuery:
    """Wait for the query; after ``timeout`` seconds stop it between two micro-batches.

    A batch that still runs after ``grace`` more seconds is interrupted. It is run again
    when the query is restarted from its checkpoint.
    """
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        deadline = time.monotonic() + grace
        while query.status["isTriggerActive"] and time.monotonic() < deadline:
            time.sleep(0.05)
        query.stop()
    return query


def run_batches(df: DataFrame, writer: BatchWriter, **kwargs) -> StreamingQuery:
    return finish(start(df, writer=writer, **kwargs))


def run_to_table(
    df: DataFrame,
    mode: str = "append",
    path: str | None = None,
    checkpoint: str | None = None,
    **kwargs,
) -> DataFrame:
    """Process everything available and return the result as a table in shared storage.

    ``append`` uses the exactly-once file sink, ``complete`` keeps the last full result and
    ``update`` keeps one folder per batch, visible as the column ``batch``.
    """
    spark = df.sparkSession
    base = new_folder(spark, "run") if path is None or checkpoint is None else ""
    path = path or f"{base}/table"
    checkpoint = checkpoint or f"{base}/checkpoint"
    schema = df.schema
    if mode == "append":
        finish(start(df, format="parquet", options={"path": path}, checkpoint=checkpoint, **kwargs))
    elif mode == "complete":
        run_batches(df, replace_table(path), mode=mode, checkpoint=checkpoint, **kwargs)
        newest = newest_version(spark, path, schema)
        return spark.createDataFrame([], schema) if newest is None else newest
    else:
        writer = folder_per_batch(path, "parquet")
        run_batches(df, writer, mode=mode, checkpoint=checkpoint, **kwargs)
        schema = StructType(list(schema.fields)).add("batch", "long")
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        # No input, so no batch has run and nothing was written.
        return spark.createDataFrame([], schema)


def run_to_table_with_watermark(df: DataFrame) -> tuple[DataFrame, str | None]:
    """As ``run_to_table`` in append mode, with the watermark of the last micro-batch as ISO text."""
    spark = df.sparkSession
    base = new_folder(spark, "run")
    query = finish(
        start(df, format="parquet", options={"path": f"{base}/table"}, checkpoint=f"{base}/checkpoint")
    )
    marks = [p["eventTime"]["watermark"] for p in query.recentProgress if p["eventTime"]]
    try:
        return spark.read.schema(df.schema).parquet(f"{base}/table"), marks[-1] if marks else None
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], df.schema), None


def show_stream(df: DataFrame, mode: str = "append", rows: int = 20, **kwargs) -> StreamingQuery:
    """Console sink."""
    return start(df, mode=mode, format="console", options={"numRows": str(rows)}, **kwargs)
