"""Batch and row writers."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.sinks.batches import (
    folder_per_batch,
    jdbc_options,
    json_folders,
    keyspace_writer,
    newest_version,
    replace_table,
    show_batch,
    table_writer,
    text_folders,
)
from millrace.sinks.rows import RowWriter
from millrace.sources.messages import message_sink
from millrace.sources.replay import replay_batches
from millrace.streaming.runtime import finish, run_batches, start


@pytest.fixture
def stream(spark, tmp_path):
    return replay_batches(spark, [[("a",), ("b",)], [("c",)]], "v string", str(tmp_path / "q"))


def test_text_and_json_folders_per_batch(spark, stream, tmp_path):
    run_batches(stream, text_folders(str(tmp_path / "text")))
    run_batches(stream, json_folders(str(tmp_path / "json")))
    assert spark.read.text(str(tmp_path / "text/batch=1")).first().value == "c"
    assert spark.read.json(str(tmp_path / "json/batch=0")).count() == 2


def test_a_batch_written_twice_replaces_itself(spark, tmp_path):
    write = folder_per_batch(str(tmp_path / "out"), "json")
    for _ in range(2):
        write(spark.range(3), 7)
    assert spark.read.json(str(tmp_path / "out")).count() == 3


def test_rows_of_each_batch_are_printed(stream, capsys):
    run_batches(stream, show_batch())
    assert "batch 1" in capsys.readouterr().out


def test_table_writer_projects_and_appends(spark, stream, tmp_path):
    path = str(tmp_path / "t")
    run_batches(stream, table_writer("json", {"path": path}, ["v"]))
    assert sorted(r.v for r in spark.read.json(path).collect()) == ["a", "b", "c"]


def test_a_strict_table_takes_only_the_first_batch(stream, tmp_path):
    writer = table_writer("json", {"path": str(tmp_path / "t")}, mode="errorifexists")
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        run_batches(stream, writer)


class WriteCall:
    """Stands in for a batch and records how it is written."""

    def __init__(self):
        self.calls = []
        self.write = self

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return call


def test_connector_options(spark):
    assert jdbc_options("jdbc:x", "cars", user="me") == {
        "url": "jdbc:x", "dbtable": "cars", "user": "me"
    }
    batch = WriteCall()
    keyspace_writer("public", "cars", ["Name", "Horsepower"])(batch, 0)
    assert batch.calls == [
        ("select", ("Name", "Horsepower"), {}),
        ("format", ("org.apache.spark.sql.cassandra",), {}),
        ("options", (), {"keyspace": "public", "table": "cars"}),
        ("mode", ("append",), {}),
        ("save", (), {}),
    ]


class FolderConnection:
    """A transaction per file: statements are kept and committed together, or not at all."""

    def __init__(self, folder):
        self.folder, self.rows, self.name, self.rowcount = Path(folder), [], None, -1

    def cursor(self):
        return self

    def execute(self, statement, values):
        assert statement == "record"
        self.name = "-".join(map(str, values))
        self.rowcount = 0 if (self.folder / f"{self.name}.json").exists() else 1

    def executemany(self, statement, rows):
        self.rows += [[statement, *row] for row in rows]

    def commit(self):
        name = self.name or abs(hash(str(self.rows)))
        (self.folder / f"{name}.json").write_text(json.dumps(self.rows))

    def rollback(self):
        self.rows = []

    def close(self):
        pass


def test_row_writer_binds_values_and_keeps_nulls(spark, tmp_path):
    rows = [("O'Neil", None), ("b", 3)]
    stream = replay_batches(spark, [rows], "name string, power int", str(tmp_path / "q"))
    out = tmp_path / "out"
    out.mkdir()
    folder = str(out)
    writer = RowWriter(lambda: FolderConnection(folder), "insert into cars values (?, ?)",
                       ["name", "power"], size=1)
    finish(start(stream, rows=writer))
    written = [row for f in out.glob("*.json") for row in json.loads(f.read_text())]
    assert sorted(written) == [
        ["insert into cars values (?, ?)", "O'Neil", None],
        ["insert into cars values (?, ?)", "b", 3],
    ]


def test_an_epoch_that_is_run_again_is_written_once(tmp_path):
    for _ in range(2):
        writer = RowWriter(lambda: FolderConnection(str(tmp_path)), "insert", ["v"], record="record")
        if writer.open(3, 7):
            writer.process({"v": 1})
        writer.close(None)
    assert [json.loads(f.read_text()) for f in tmp_path.glob("*.json")] == [[["insert", 1]]]


def test_failed_partition_is_not_committed(tmp_path):
    writer = RowWriter(lambda: FolderConnection(str(tmp_path)), "insert", ["v"])
    assert writer.open(0, 0)
    writer.process({"v": 1})
    writer.close(ValueError("broken"))
    assert list(tmp_path.glob("*.json")) == []


def test_a_batch_appended_twice_leaves_one_copy(spark, tmp_path):
    path = str(tmp_path / "t")
    write = table_writer("parquet", {"path": path}, ["id"], batch_column="batch")
    for batch_id, n in ((0, 2), (1, 3), (1, 3), (0, 2)):
        write(spark.range(n), batch_id)
    found = spark.read.parquet(path).groupBy("batch").count().collect()
    assert sorted((r.batch, r["count"]) for r in found) == [(0, 2), (1, 3)]


def test_a_failed_version_leaves_the_one_before(spark, tmp_path):
    path = str(tmp_path / "v")
    write, schema = replace_table(path), spark.range(1).schema
    assert newest_version(spark, path, schema) is None
    write(spark.range(3), 0)
    with pytest.raises(Exception):
        write(spark.range(5).select(F.raise_error(F.lit("broken")).cast("long").alias("id")), 1)
    assert newest_version(spark, path, schema).count() == 3
    write(spark.range(5), 1)
    write(spark.range(5), 1)
    assert newest_version(spark, path, schema).count() == 5
    assert [p.name for p in Path(path).glob("version=*")] == ["version=1"]


def test_message_sink_without_a_connector_says_so(stream):
    with pytest.raises(Exception, match="(?i)kafka"):
        message_sink(stream, "broker:9092", "cars", "/tmp/unused").start()
