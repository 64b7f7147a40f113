"""File, line and message sources on small folders."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators.aggregates import average, count_by
from millrace.sources import files
from millrace.sources.messages import decode_messages, message_options
from millrace.sources.replay import replay_batches, rows_table
from millrace.sources.tables import read_snapshot, table_stream, write_snapshot
from millrace.streaming.runtime import finish, run_batches, run_to_table, start

# Band 12 has no player, player 24 has no band, and one band has two players.
BANDS = [
    {"id": 10, "name": "Harbour", "hometown": "Porto", "year": 1999},
    {"id": 11, "name": "Lanterns", "hometown": "Cork", "year": 2007},
    {"id": 12, "name": "Slow Tide", "hometown": "Gdansk", "year": 2015},
]
PLAYERS = [
    {"id": 21, "name": "Ines", "guitars": [7], "band": 11},
    {"id": 22, "name": "Bram", "guitars": [], "band": 10},
    {"id": 23, "name": "Oona", "guitars": [8, 9, 7], "band": 11},
    {"id": 24, "name": "Petr", "guitars": [6], "band": None},
    {"id": 25, "name": "Zoe", "guitars": [9], "band": 77},
]


def write_lines(folder, name, lines):
    folder.mkdir(exist_ok=True, parents=True)
    (folder / name).write_text("".join(f"{line}\n" for line in lines))


def write_json(folder, rows):
    write_lines(folder, "part.json", [json.dumps(row) for row in rows])


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_static_json_schema_is_inferred_and_reused_by_a_stream(spark, tmp_path):
    write_json(tmp_path / "bands", BANDS)
    static = files.json_table(spark, str(tmp_path / "bands"))
    assert dict(static.dtypes) == {
        "id": "bigint", "name": "string", "hometown": "string", "year": "bigint"
    }
    stream = files.json_stream(spark, str(tmp_path / "bands"), static.schema)
    assert rows(run_to_table(stream)) == rows(static)


def test_players_join_bands(spark, tmp_path):
    write_json(tmp_path / "bands", BANDS)
    write_json(tmp_path / "players", PLAYERS)
    bands = files.json_table(spark, str(tmp_path / "bands"), schemas.BAND)
    players = files.json_table(spark, str(tmp_path / "players"), schemas.GUITAR_PLAYER)
    joined = players.join(bands, players.band == bands.id).select(bands.id)
    assert rows(joined) == [(10,), (11,), (11,)]


def test_csv_stream_keeps_bad_rows_and_skips_blank_lines(spark, tmp_path):
    write_lines(tmp_path / "s", "a.csv", ["ZQX,Mar 9 2011,7.25", "", "bad,Foo 1 2011,zz"])
    stocks = run_to_table(files.csv_stream(spark, str(tmp_path / "s")))
    assert sorted(stocks.collect(), key=lambda r: r.company) == [
        ("ZQX", dt.date(2011, 3, 9), 7.25),
        ("bad", None, None),
    ]


def test_identical_files_count_twice_and_a_restart_reads_only_new_ones(spark, tmp_path):
    folder, out = tmp_path / "s", str(tmp_path / "out")
    checkpoint = str(tmp_path / "checkpoint")
    row = ["ZQX,Apr 1 2012,3.5"]
    write_lines(folder, "one.csv", row)
    write_lines(folder, "two.csv", row)

    def run():
        return run_to_table(files.csv_stream(spark, str(folder)), "append", out, checkpoint).count()

    assert run() == 2
    assert run() == 2
    write_lines(folder, "three.csv", row)
    assert run() == 3


def test_json_stream_of_cars(spark, tmp_path):
    powers = [61, 77, 141, 140, 300, 95, None]
    cars = [{"Name": f"car {i}", "Horsepower": p, "Origin": "PT"} for i, p in enumerate(powers)]
    write_json(tmp_path / "cars", cars)
    stream = files.json_stream(spark, str(tmp_path / "cars"), schemas.CAR)
    powerful = stream.filter(F.coalesce("Horsepower", F.lit(0)) > 140)
    assert run_to_table(powerful).count() == 2
    mean = average(stream, "Horsepower", "mean").select(F.round("mean", 4))
    assert rows(run_to_table(mean, "complete")) == [(135.6667,)]
    assert rows(run_to_table(count_by(stream, "Origin"), "complete")) == [("PT", 7)]


def test_parquet_stream_merges_schemas_and_limits_files(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(2).coalesce(1).write.mode("append").parquet(path)
    wider = spark.range(3).select("id", F.lit("x").alias("extra")).coalesce(1)
    wider.write.mode("append").parquet(path)
    stream = files.parquet_stream(spark, path, max_files=1)
    assert stream.columns == ["id", "extra"]
    seen = []
    run_batches(stream, lambda batch, batch_id: seen.append(batch.count()))
    assert sorted(seen) == [2, 3]


def test_consumed_files_are_archived(spark, tmp_path):
    source, archive = tmp_path / "in", tmp_path / "done"
    for i in range(4):
        spark.range(1).coalesce(1).write.mode("append").parquet(str(source))
    stream = files.parquet_stream(spark, str(source), "id long", 1, str(archive))
    finish(start(stream, writer=lambda batch, batch_id: batch.count()))
    deadline = time.time() + 20
    while not list(archive.rglob("*.parquet")) and time.time() < deadline:
        time.sleep(0.2)
    assert list(archive.rglob("*.parquet"))


def test_line_source_and_file_names(spark, tmp_path):
    write_lines(tmp_path / "t", "lines.txt", ["ab", "abcdefgh"])
    stream = files.line_source(spark, "text", path=str(tmp_path / "t"))
    assert stream.isStreaming and stream.columns == ["value"]
    named = run_to_table(files.with_file_name(stream, "file"))
    assert [r.file.split("/")[-1] for r in named.collect()] == ["lines.txt"] * 2


def test_queue_is_replayed_one_entry_per_batch(spark, tmp_path):
    queue = [[(1,), (2,)], [(3,)], [(4,), (5,), (6,)]]
    stream = replay_batches(spark, queue, "n int", str(tmp_path / "q"))
    seen = {}

    def collect(batch, batch_id):
        seen[batch_id] = sorted(r.n for r in batch.collect())

    run_batches(stream, collect)
    assert seen == {0: [1, 2], 1: [3], 2: [4, 5, 6]}


def test_table_stream_reads_a_file_or_a_folder(spark, tmp_path):
    spark.range(5).repartition(2).write.parquet(str(tmp_path / "t.parquet"))
    assert run_to_table(table_stream(spark, str(tmp_path), "t")).count() == 5
    assert run_to_table(table_stream(spark, "/root/testdata/sf0.001", "region")).count() == 5


def test_snapshot_versions_do_not_overwrite(spark, tmp_path):
    path = str(tmp_path / "v1")
    write_snapshot(spark.range(3), path)
    assert read_snapshot(spark, path).count() == 3
    with pytest.raises(Exception, match="already exists"):
        write_snapshot(spark.range(1), path)


def test_message_envelope(spark):
    messages = rows_table(spark, [("clicks", bytearray(b"abc,120"))], "topic string, value binary")
    assert rows(decode_messages(messages)) == [("clicks", "abc,120")]
    assert message_options("broker:9092", "clicks") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "clicks",
    }
