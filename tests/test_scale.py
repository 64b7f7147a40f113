"""How replayed joins, word windows and ordered state are divided."""

import random
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import windows
from millrace.plans import joins
from millrace.plans.registry import QUERIES
from millrace.sources import replay
from millrace.streaming.ordered import OrderedMeans
from millrace.streaming.runtime import run_to_table

DAY = 86_400


def write_orders(spark, folder, rng):
    """More items than orders; some items match no order in time, some orders no item."""
    items = [(rng.randrange(30), i, 1, 2, 800_000_000 + rng.randrange(400) * DAY) for i in range(200)]
    orders = [(k, k % 7, 800_000_000 + rng.randrange(400) * DAY) for k in range(25)]
    for name, rows, columns, time in (
        ("lineitem", items, joins.ITEM, "l_shipdate"), ("orders", orders, joins.ORDER, "o_orderdate"),
    ):
        schema = ", ".join(f"{c} long" for c in columns)
        stamp = F.timestamp_seconds(F.col(time)).cast("timestamp_ntz")
        table = spark.createDataFrame(rows, schema).withColumn(time, stamp)
        table.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return items, orders


@pytest.mark.parametrize("name", ["interval", "left", "semi", "anti"])
def test_both_sides_of_a_join_come_in_the_same_small_ranges(spark, tmp_path, monkeypatch, name):
    items, orders = write_orders(spark, tmp_path, random.Random(3))
    monkeypatch.setattr(joins, "JOIN_ROWS", 45)
    counted = []

    def recorded(df, time, slices=None):
        counted.append(slices)
        return replay.in_time_order(df, time, slices)

    monkeypatch.setattr(joins, "in_time_order", recorded)
    got = QUERIES[f"stream_stream_{name}"](spark, str(tmp_path)).collect()
    assert counted == [5, 5]
    mark = min(max(i[4] for i in items), max(o[2] for o in orders)) - 10 * DAY
    pairs, single = [], []
    for item in items:
        found = [o for o in orders if o[0] == item[0] and 0 <= item[4] - o[2] <= 90 * DAY]
        pairs += [item[1]] * len(found)
        if name == "semi" and found or name in ("left", "anti") and not found and item[4] < mark:
            single.append(item[1])
    want = {"interval": pairs, "left": pairs + single, "semi": single, "anti": single}[name]
    assert sorted(row["l_linenumber"] for row in got) == sorted(want) and want


def test_a_join_without_a_watermark_keeps_few_entries(spark, tmp_path, monkeypatch):
    items, orders = write_orders(spark, tmp_path, random.Random(4))
    monkeypatch.setattr(joins, "BUCKET_ROWS", 15, raising=False)
    checkpoint = str(tmp_path / "checkpoint")

    def recorded(df, **kwargs):
        return run_to_table(df, path=str(tmp_path / "out"), checkpoint=checkpoint, **kwargs)

    monkeypatch.setattr(joins, "run_to_table", recorded)
    got = QUERIES["stream_stream_inner"](spark, str(tmp_path)).collect()
    want = [(i[1], o[1]) for i in items for o in orders if i[0] == o[0]]
    assert sorted((row["l_linenumber"], row["o_custkey"]) for row in got) == sorted(want)
    # 225 rows in 15 buckets, which each side brings at once.
    for side in ("left", "right"):
        state = spark.read.format("statestore").option("joinSide", side).load(checkpoint)
        assert 0 < state.count() <= 15


def test_lines_are_replayed_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(replay, "RANGE_BYTES", 2_500)
    monkeypatch.setattr(replay, "FILE_BYTES", 500)
    lines = spark.range(100).select(F.timestamp_seconds("id").alias("t"), F.lit("x" * 100).alias("line"))
    paths = []

    def noted(spark, label, new=replay.new_folder):
        paths.append(new(spark, label))
        return paths[-1]

    monkeypatch.setattr(replay, "new_folder", noted)
    replay.in_time_order(lines, "t", text="line")
    files = spark.read.parquet(paths[0]).groupBy(F.input_file_name()).count().collect()
    assert sum(f["count"] for f in files) == 100
    assert len(list(Path(paths[1]).glob("range*"))) == 4 and len(files) >= 20


def test_null_and_missing_lines(spark):
    schema = "t timestamp, line string"
    for rows in ([], [(None, None)]):
        stream = replay.in_time_order(spark.createDataFrame(rows, schema), "t", text="line")
        assert stream.isStreaming and stream.columns == ["t", "line"]


def test_tasks_of_a_running_sum_grow_with_the_changes(spark, monkeypatch):
    monkeypatch.setattr(windows, "CHANGES_PER_TASK", 20)
    df = spark.range(100).select(F.timestamp_seconds(F.col("id") * 30).alias("ts"), F.lit("a").alias("w"))
    measures = {"n": ("count", F.lit(1))}
    buckets = windows.bucket_totals(df, "ts", "30 seconds", measures, ["w"])
    got = windows.windows_by_difference(buckets, "60 seconds", "30 seconds", ["n"], ["w"])
    assert ", 10), REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(row["n"] for row in got.collect()) == [1, 1] + [2] * 99


class Kept:
    """A state variable in memory."""

    def __init__(self):
        self.rows, self.entries = [], 0

    def get(self):
        return self.rows

    def clear(self):
        self.rows = []

    def put(self, rows):
        self.rows = list(rows)

    def appendList(self, rows):
        self.rows += rows
        self.entries += len(rows)


class Handle:
    def __init__(self):
        self.lists, self.timers = Kept(), set()

    def getListState(self, name, schema):
        return self.lists

    def getValueState(self, name, schema):
        value = Kept()
        value.get = lambda: value.rows or None
        value.update = value.put
        return value

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class Mark:
    def __init__(self, millis):
        self.millis = millis

    def getCurrentWatermarkInMs(self):
        return self.millis


def test_waiting_rows_share_an_entry():
    means, handle = OrderedMeans("k", "t", "i", "v", "mean", 3), Handle()
    means.init(handle)
    times = np.arange(1000)[::-1] * 1_000_000
    frame = pd.DataFrame({"held_at": times, "held_tie": 1, "held_value": times / 1e6})
    list(means.handleInputRows(("a",), iter([frame[:600], frame[600:]]), None))
    assert handle.lists.entries == 2 and handle.timers == {0}
    handle.timers.clear()
    first = pd.concat(means.handleExpiredTimer(("a",), Mark(499_000), None))
    assert handle.timers == {500_000}
    second = pd.concat(means.handleExpiredTimer(("a",), Mark(2_000_000), None))
    assert first["mean"].tolist() == [float(i) for i in range(1, 499)]
    assert second["mean"].tolist() == [float(i) for i in range(499, 999)]
