"""What a running query has done so far."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from millrace.session import new_folder

PROGRESS = (
    "batch long, started string, input_rows long, watermark string, max_event_time string, "
    "state_rows long, state_bytes long"
)
SCHEMA = f"query string, {PROGRESS}"


def _entry(progress_json: str) -> tuple:
    entry = json.loads(progress_json)
    event_time = entry.get("eventTime", {})
    state = entry.get("stateOperators", [])
    return (
        entry["batchId"],
        entry["timestamp"],
        entry.get("numInputRows", 0),
        event_time.get("watermark"),
        event_time.get("max"),
        sum(s["numRowsTotal"] for s in state),
        sum(s["memoryUsedBytes"] for s in state),
    )


def progress_report(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row per report that Spark still remembers; it forgets all but the last 100.

    For every batch of a long run, attach a :class:`ProgressLog` before the query starts.
    """
    return spark.createDataFrame([_entry(p.json) for p in query.recentProgress], PROGRESS)


class ProgressLog(StreamingQueryListener):
    """Keeps every progress report of the session's queries as a table on shared storage.

    Reports come one at a time and are written ``size`` at a time; ``report`` writes the rest
    and reads all of them.
    """

    def __init__(self, spark: SparkSession, size: int = 100):
        self.spark, self.size = spark, size
        self.folder = new_folder(spark, "progress")
        self.held: list[tuple] = []
        self.written = 0
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.held.append((str(event.progress.id), *_entry(event.progress.json)))
        if len(self.held) >= self.size:
            self._write()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def _write(self) -> None:
        # Reports come on a thread of their own; a folder per write keeps jobs apart.
        with self.lock:
            rows, self.held = self.held, []
            if rows:
                table = self.spark.createDataFrame(rows, SCHEMA).coalesce(1)
                table.write.parquet(f"{self.folder}/part={self.written}")
                self.written += 1

    def report(self) -> DataFrame:
        """``query`` and the columns of a progress report, for all batches so far."""
        self._write()
        if not self.written:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.folder).drop("part")
