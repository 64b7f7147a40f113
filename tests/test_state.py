"""Ordered state, differences of windows, checkpoints as tables, merges by bucket, replay."""

import random
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators import changes, windows
from millrace.operators.aggregates import count_by, distinct_within
from millrace.operators.joins import stream_anti_join
from millrace.operators.rolling import rolling_mean
from millrace.session import new_folder
from millrace.sources.replay import in_time_order, replay_batches
from millrace.streaming.checkpoints import committed_batches, state_operators, state_table
from millrace.streaming.ordered import ordered_rolling_means
from millrace.streaming.progress import progress_report
from millrace.streaming.runtime import run_to_table, start, finish

ROOT = Path(__file__).resolve().parent.parent


def seconds(name="t"):
    return F.timestamp_seconds(F.col(name))


def test_ordered_means_do_not_depend_on_arrival(spark, tmp_path):
    """Rows up to 50 s late, in eight batches, give the means of the table."""
    rng = random.Random(1)
    times = [1_000_000 + rng.randrange(400) for _ in range(300)]
    rows = [(rng.choice("abc"), t, i, rng.choice([None, float(t % 7)])) for i, t in enumerate(times)]
    rows.sort(key=lambda r: r[1] + rng.random() * 50)
    schema = "k string, t long, i long, v double"
    batches = [rows[i:i + 40] for i in range(0, 300, 40)]
    stream = replay_batches(spark, batches, schema, str(tmp_path / "q")).withColumn("ts", seconds())
    got = run_to_table(ordered_rolling_means(stream, "k", "ts", "60 seconds", "i", "v", 3))
    whole = spark.createDataFrame(rows, schema).withColumn("ts", seconds())
    want = rolling_mean(whole.select("k", "ts", "i", "v"), "k", ["ts", "i"], "v", 3)
    want = want.where(F.unix_seconds("ts") <= max(times) - 60)

    def plain(df):
        return sorted((r["k"], str(r["ts"]), r["i"], str(r["v"]), str(r["mean"])[:8]) for r in df.collect())

    assert plain(got) == plain(want) and got.count() > 200


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_windows_by_difference(spark, keys, monkeypatch):
    monkeypatch.setattr(windows, "CHUNK_SECONDS", 70)
    rng = random.Random(2)
    rows = [(rng.choice("ab"), 1_000_000 + rng.randrange(60) * rng.choice([1, 1, 40])) for _ in range(150)]
    df = spark.createDataFrame(rows, "k string, t long").withColumn("ts", seconds())
    measures = {"n": ("count", F.lit(1)), "s": ("sum", F.col("t") % 5)}
    buckets = windows.bucket_totals(df, "ts", "5 seconds", measures, keys)
    got = windows.windows_by_difference(buckets, "60 seconds", "5 seconds", ["n", "s"], keys)
    want = windows.window_totals(df, "ts", "60 seconds", measures, keys, "5 seconds")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    until = F.lit("1970-01-12 13:47:00").cast("timestamp")
    early = windows.windows_by_difference(buckets, "60 seconds", "5 seconds", ["n", "s"], keys, until)
    assert sorted(map(str, early.collect())) == sorted(map(str, want.where(F.col("end") <= until).collect()))


def test_top_of_closed_windows_leaves_the_state(spark, tmp_path):
    batches = [
        [("x", 1, 5.0), ("y", 2, 5.0), ("z", 3, 9.0), ("w", 4, 1.0)], [("x", 61, 1.0)], [("x", 300, 1.0)], [("x", 301, 1.0)],
    ]
    stream = replay_batches(spark, batches, "item string, t long, v double", str(tmp_path / "q")).withColumn("ts", seconds())
    top = windows.closed_top(stream, "ts", "10 seconds", "1 minute", "item", F.col("v"), k=3)
    path = new_folder(spark, "top")
    query = finish(start(top, format="parquet", options={"path": path}, count_state=True))
    got = sorted((r["start"].minute, r["rank"], r["item"], r["total"]) for r in spark.read.parquet(path).collect())
    assert got == [(0, 1, "z", 9.0), (0, 2, "x", 5.0), (0, 3, "y", 5.0), (1, 1, "x", 1.0)]
    held = [r.state_rows for r in progress_report(spark, query).orderBy("batch").collect()]
    assert max(held) > held[-1]


def test_distinct_within_forgets(spark, tmp_path):
    batches = [[("a", 1), ("a", 3), ("b", 4)], [("a", 5)], [("c", 200)], [("c", 201)], [("a", 202)]]
    stream = replay_batches(spark, batches, "k string, t long", str(tmp_path / "q")).withColumn("ts", seconds())
    got = run_to_table(distinct_within(stream, "ts", "10 seconds", "k"))
    assert sorted((r["k"]) for r in got.collect()) == ["a", "a", "b", "c"]


def test_anti_join_releases_unmatched_rows(spark, tmp_path):
    left = [[("a", 1), ("b", 2), (None, 3)], [("c", 50)], [("d", 200)], [("e", 400)]]
    right = [[("a", 5)], [("c", 90)], [("x", 200)], [("x", 400)]]
    ls = replay_batches(spark, left, "k string, t long", str(tmp_path / "l")).withColumn("lt", seconds()).drop("t")
    rs = replay_batches(spark, right, "r string, t long", str(tmp_path / "r")).withColumn("rt", seconds()).drop("t")
    joined = stream_anti_join(
        ls.withWatermark("lt", "10 seconds"), rs.withWatermark("rt", "10 seconds"), "k", "r",
        F.expr("rt BETWEEN lt AND lt + INTERVAL 20 SECONDS"),
    )
    assert sorted(str(r["k"]) for r in run_to_table(joined).collect()) == ["None", "b", "c", "d"]


def test_checkpoint_as_tables(spark, tmp_path):
    batches = [[("a", 1), ("b", 2)], [("a", 3)]]
    stream = replay_batches(spark, batches, "k string, t long", str(tmp_path / "q"))
    checkpoint = new_folder(spark, "checkpoint")
    run_to_table(count_by(stream, "k"), mode="complete", checkpoint=checkpoint, path=new_folder(spark, "t"))
    assert {tuple(r) for r in state_table(spark, checkpoint).collect()} == {("a", 2), ("b", 1)}
    assert {tuple(r) for r in state_table(spark, checkpoint, batch=0).collect()} == {("a", 1), ("b", 1)}
    assert state_operators(spark, checkpoint).first()["operatorName"] == "stateStoreSave"
    assert [r.batch for r in committed_batches(spark, checkpoint).orderBy("batch").collect()] == [0, 1]


FEED = "Op string, ID long, t long, v string"


def test_merge_by_bucket_leaves_other_files(spark):
    loaded = spark.createDataFrame([(None, i, 0, "old") for i in range(200)], FEED)
    load, _ = changes.split_feed(loaded, ["ID"])
    path = new_folder(spark, "buckets")
    changes.write_buckets(load, path, 8)
    before = set(spark.read.parquet(path).inputFiles())
    # One bucket loses all its rows, one row is changed and one is added.
    gone = changes.bucket_of(F.struct(F.col("ID")), ["ID"], 8)
    lost = [r.ID for r in loaded.where(gone == 3).collect()]
    kept = [r.ID for r in loaded.where(gone == 5).collect()]
    rows = [("D", i, 1, "") for i in lost] + [("U", kept[0], 2, "new"), ("I", kept[1], 2, "ignored")]
    _, changed = changes.split_feed(spark.createDataFrame(rows, FEED), ["ID"])
    want = changes.merge_changes(load, changed, ["t"], "latest").select("Op", "value.ID", "value.v")
    want = sorted(map(str, want.collect()))
    assert changes.merge_buckets(spark, path, changed, ["t"], 8, "latest") == [3, 5]
    spark.catalog.refreshByPath(path)
    got = changes.read_buckets(spark, path).select("Op", "value.ID", "value.v")
    assert sorted(map(str, got.collect())) == want and len(want) == 200 - len(lost)
    after = set(spark.read.parquet(path).inputFiles())
    assert {f for f in before - after} == {f for f in before if "bucket=3/" in f or "bucket=5/" in f}
    assert changes.merge_buckets(spark, path, changed.limit(0), ["t"], 8, "latest") == []


def test_merge_takes_ties_in_a_total_order(spark):
    """At equal order fields: delete, insert, update, then the fields of the value."""
    rows = [
        (None, 1, 0, "x"), ("U", 1, 5, "a"), ("U", 1, 5, "c"), ("U", 1, 5, "b"),
        (None, 2, 0, "x"), ("D", 2, 5, "z"), ("I", 2, 5, "m"), ("I", 2, 5, "k"),
        (None, 3, 0, "x"), ("U", 3, 5, "u"), ("D", 3, 5, "a"), ("I", 4, 5, "i"), ("U", 4, 5, "h"),
    ]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        load, changed = changes.split_feed(spark.createDataFrame(rows, FEED).repartition(3), ["ID"])
        merged = changes.merge_changes(load, changed, ["t"], "latest")
        assert sorted((r.ID, r.v) for r in merged.select("value.ID", "value.v").collect()) == [(1, "c"), (2, "k"), (4, "h")]


def test_changes_come_in_feed_order(spark):
    rows = [("I", i % 7, (i * 5) % 11, str(i)) for i in range(60)] + [("D", 3, 4, "d")]
    _, changed = changes.split_feed(spark.createDataFrame(rows, FEED).repartition(4), ["ID"])
    newest = changes.latest_by(changed.filter("Op = 'U'"), ["t"])
    got = changes.change_set(changed, newest, ["t"], ordered=True).select("value.t", "value.ID").collect()
    assert [tuple(r) for r in got] == sorted(tuple(r) for r in got) and len(got) == 61


def test_replay_writes_ranges_in_parallel(spark, monkeypatch):
    from millrace.sources import replay

    monkeypatch.setattr(replay, "FILE_ROWS", 20)
    monkeypatch.setattr(replay, "RANGE_ROWS", 100)
    df = spark.range(500).select(((F.col("id") * 37) % 500).alias("t"), F.lit("x").alias("_range")).repartition(3)
    stream = in_time_order(df, "t")
    seen = {}
    files = {}

    def collect(batch, number):
        seen[number] = sorted(r.t for r in batch.collect())
        files[number] = batch.select(F.input_file_name()).distinct().count()

    finish(start(stream, writer=collect))
    assert len(seen) == 5 and sum(seen.values(), []) == list(range(500))
    assert set(files.values()) == {5} and stream.columns == ["t", "_range"]
    assert finish(start(in_time_order(df.limit(0), "t"), writer=collect)) is not None


@pytest.mark.parametrize("blocked, lost", [("zstandard", "op5_language_model"), ("corpus_pipeline", "pipeline")])
def test_entry_lives_without_optional_parts(blocked, lost):
    code = f"""
import sys
sys.modules[{blocked!r}] = None
sys.path.insert(0, {str(ROOT)!r})
import __spark_entry__ as e
names = set(e.queries())
assert "cdc_merge" in names and {lost!r} not in names, names
assert set(e.oracle_sql()) <= names
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
