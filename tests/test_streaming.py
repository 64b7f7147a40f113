"""Triggers, output modes, watermarks, restarts and state."""

import time

import pytest
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from millrace import schemas
from millrace.functions import dates, text
from millrace.operators.aggregates import average, count_by, distinct_rows, running_count
from millrace.operators.windows import closed_windows, window_totals, with_arrival
from millrace.plans import joins
from millrace.plans import windows as window_plans
from millrace.session import scoped_conf, shared_dir, state_partitions, utc
from millrace.sources.files import json_stream
from millrace.sources.replay import in_time_order, replay_batches
from millrace.sources.tables import table, table_stream
from millrace.streaming.progress import ProgressLog, progress_report
from millrace.streaming.runtime import (
    continuous,
    every,
    finish,
    run_batches,
    run_to_table,
    show_stream,
    start,
)
from millrace.streaming.state import rolling_means_by_state

SF = "/root/testdata/sf0.001"

# Recorded sequences of late events, one list per micro-batch, and the closed windows
# (start second, end second, colour, count). Fixed values.
LATE = {
    "first": [
        ["7000,blue"], ["8000,green"], ["14000,blue"], ["9000,red"],
        ["15000,red", "8000,blue"], ["13000,green"], ["21000,green"], ["4000,purple"],
        ["17000,green"],
    ],
    "second": [
        ["5000,red", "5000,green", "4000,blue"],
        ["1000,yellow", "2000,cyan", "3000,magenta", "5000,black"],
        ["10000,pink"],
    ],
    "third": [
        ["9000,blue"], ["2000,green", "1000,blue", "8000,red"], ["5000,red", "18000,blue"],
        ["2000,green"], ["30000,purple", "10000,green"],
    ],
}
CLOSED = {
    "first": {
        (6, 8, "blue", 1), (8, 10, "green", 1), (12, 14, "green", 1), (14, 16, "blue", 1),
        (14, 16, "red", 1),
    },
    "second": {
        (2, 4, "cyan", 1), (2, 4, "magenta", 1), (4, 6, "black", 1), (4, 6, "blue", 1),
        (4, 6, "green", 1), (4, 6, "red", 1),
    },
    "third": {(8, 10, "blue", 1), (8, 10, "red", 1), (18, 20, "blue", 1)},
}
# Rows that the default rule still accepts in the batch that closes their window.
LAST_MOMENT = {
    "first": {(8, 10, "red", 1)},
    "second": {(0, 2, "yellow", 1)},
    "third": {(0, 2, "blue", 1), (2, 4, "green", 1)},
}


def colours(spark, path, batches):
    lines = replay_batches(spark, [[(v,) for v in b] for b in batches], schemas.LINE, path)
    parsed = text.parse_delimited(lines, schemas.COLOUR_EVENT)
    return parsed.withColumn("created", dates.from_millis(F.col("created")))


@pytest.mark.parametrize("case", LATE)
@pytest.mark.parametrize("several_operators", [True, False])
def test_late_rows(spark, tmp_path, case, several_operators):
    setting = "spark.sql.streaming.statefulOperator.allowMultiple"
    with utc(spark), scoped_conf(spark, {setting: str(several_operators).lower()}):
        events = colours(spark, str(tmp_path / "in"), LATE[case])
        counts = closed_windows(
            events, "created", "2 seconds", "2 seconds", window_plans.row_count(), ["color"]
        )
        closed = run_to_table(
            counts.select(F.unix_seconds("start"), F.unix_seconds("end"), "color", "count")
            .toDF("start", "end", "color", "count")
        )
    found = [tuple(r) for r in closed.collect()]
    expected = CLOSED[case] | (LAST_MOMENT[case] if several_operators else set())
    assert sorted(found) == sorted(expected)


def test_progress_shows_the_watermark(spark, tmp_path):
    with utc(spark):
        events = colours(spark, str(tmp_path / "in"), LATE["second"])
        counts = closed_windows(
            events, "created", "2 seconds", "2 seconds", window_plans.row_count(), ["color"]
        )
        query = finish(start(counts, format="noop"))
    report = progress_report(spark, query)
    marks = {r.batch: r.watermark for r in report.collect()}
    assert [marks[i][17:19] for i in sorted(marks)] == ["00", "03", "03", "08"]
    assert report.agg(F.sum("input_rows")).first()[0] == 8


def test_every_batch_is_in_the_progress_log(spark, tmp_path):
    log = ProgressLog(spark, size=2)
    spark.streams.addListener(log)
    try:
        stream = replay_batches(spark, [[(i,)] for i in range(5)], "n int", str(tmp_path / "q"))
        query = run_batches(stream, lambda batch, batch_id: batch.count())
        deadline = time.time() + 20
        while log.report().where(F.col("query") == str(query.id)).count() < 5:
            assert time.time() < deadline, (str(query.id), log.report().collect())
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    found = log.report().where(F.col("query") == str(query.id))
    assert sorted((r.batch, r.input_rows) for r in found.collect()) == [(i, 1) for i in range(5)]


def test_running_a_stream_leaves_its_schema_alone(spark):
    regions = table_stream(spark, SF, "region").select("r_name")
    run_to_table(regions, mode="update")
    assert [f.name for f in regions.schema.fields] == ["r_name"]


def test_output_modes(spark):
    events = table_stream(spark, SF, "events")
    for df, mode in [
        (running_count(events), "append"),
        (events.orderBy("ts"), "append"),
        (events.select("user_id"), "complete"),
    ]:
        with pytest.raises(AnalysisException):
            start(df, mode=mode, format="noop")
    for mode in ("update", "complete"):
        finish(start(running_count(events), mode=mode, format="noop"))


def test_sorted_aggregate_needs_complete_mode(spark):
    totals = count_by(table_stream(spark, SF, "events"), "event_type").orderBy(F.desc("count"))
    with pytest.raises(AnalysisException):
        start(totals, mode="update", format="noop")
    finish(start(totals, mode="complete", format="noop"))


def test_update_mode_keeps_one_folder_per_batch(spark, tmp_path):
    stream = replay_batches(spark, [[("a",)], [("a",), ("b",)]], "v string", str(tmp_path / "q"))
    counts = run_to_table(count_by(stream, "v"), "update")
    assert sorted(tuple(r) for r in counts.collect()) == [("a", 1, 0), ("a", 2, 1), ("b", 1, 1)]


@pytest.mark.parametrize("mode", ["append", "update", "complete"])
def test_empty_input_gives_an_empty_table(spark, tmp_path, mode):
    (tmp_path / "none").mkdir()
    stream = json_stream(spark, str(tmp_path / "none"), "v string")
    result = run_to_table(stream if mode == "append" else count_by(stream, "v"), mode)
    assert result.count() == 0 and result.columns[0] == "v"


def test_distinct_drops_repeats_across_batches(spark, tmp_path):
    stream = replay_batches(spark, [[("a",)], [("a",), ("b",)]], "v string", str(tmp_path / "q"))
    found = run_to_table(distinct_rows(stream, "v"), "complete")
    assert sorted(r.v for r in found.collect()) == ["a", "b"]


def test_complete_result_does_not_depend_on_how_input_is_cut(spark, tmp_path):
    rows = [(i % 3, float(i)) for i in range(12)]
    cuts = [[rows], [rows[:5], rows[5:]], [rows[8:], rows[3:8], rows[:3]]]
    results = []
    for i, batches in enumerate(cuts):
        stream = replay_batches(spark, batches, "k int, v double", str(tmp_path / f"q{i}"))
        totals = run_to_table(count_by(stream, "k"), "complete")
        mean = run_to_table(average(stream, "v", "mean"), "complete")
        results.append((sorted(map(tuple, totals.collect())), mean.first().mean))
    assert results[0] == results[1] == results[2]


def test_state_survives_a_restart(spark, tmp_path):
    folder = str(tmp_path / "q")
    paths = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for expected in (2, 4):
        stream = replay_batches(spark, [[(1,), (2,)]], "n int", folder)
        assert run_to_table(running_count(stream), "complete", *paths).first()[0] == expected


@pytest.mark.parametrize("keys", [[], ["event_type"]])
def test_stream_and_table_agree(spark, keys):
    with utc(spark):
        static = window_totals(
            table(spark, SF, "events"), "ts", "1 day", window_plans.row_count(), keys
        )
        stream = window_totals(
            table_stream(spark, SF, "events"), "ts", "1 day", window_plans.row_count(), keys
        )
        assert sorted(map(tuple, run_to_table(stream, "complete").collect())) == sorted(
            map(tuple, static.collect())
        )


def test_processing_time_is_one_value_per_batch(spark, tmp_path):
    stream = replay_batches(spark, [[("ab",), ("c",)]], schemas.LINE, str(tmp_path / "q"))
    arrived = run_to_table(with_arrival(stream))
    assert arrived.select("arrived").distinct().count() == 1


def test_triggers_and_bounded_runs(spark):
    events = table_stream(spark, SF, "events")
    query = finish(start(events, format="noop", trigger=every("1 second")), timeout=2)
    assert not query.isActive
    assert sum(p.numInputRows for p in query.recentProgress) == 1000
    assert continuous("1 second") == {"continuous": "1 second"}


def test_console_sink(spark):
    query = finish(show_stream(running_count(table_stream(spark, SF, "region")), "complete"))
    assert "ConsoleTable" in query.lastProgress.sink.description


def test_a_query_takes_exactly_one_sink(spark):
    with pytest.raises(ValueError):
        start(table_stream(spark, SF, "region"))


def test_settings_are_restored(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    with scoped_conf(spark, {"spark.sql.session.timeZone": "America/Sao_Paulo", "x.y": "1"}):
        assert spark.conf.get("x.y") == "1"
    assert spark.conf.get("spark.sql.session.timeZone") == before
    assert spark.conf.get("x.y", None) is None
    assert state_partitions(spark) == 4
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


# The worked example of the rolling mean. Fixed values.
CLICKS = [("a", i, float(v)) for i, v in enumerate([100, 200, 300, 400, 500, 600])]
CUTS = [[CLICKS], [CLICKS[:2], CLICKS[2:]], [[c] for c in CLICKS]]


@pytest.mark.parametrize("cut", range(len(CUTS)))
def test_rolling_mean_by_state(spark, tmp_path, cut):
    stream = replay_batches(spark, CUTS[cut], "s string, t long, v double", str(tmp_path / "q"))
    means = run_to_table(rolling_means_by_state(stream, "s", ["t"], "v", 3))
    assert sorted((r.s, r.t, r.v, r["mean"]) for r in means.collect()) == [
        ("a", 2, 300, 200), ("a", 3, 400, 300), ("a", 4, 500, 400), ("a", 5, 600, 500)
    ]


def test_state_puts_the_rows_of_a_batch_in_order(spark, tmp_path):
    batches = [[CLICKS[2], CLICKS[0], CLICKS[1]], [CLICKS[5], CLICKS[4], CLICKS[3]]]
    stream = replay_batches(spark, batches, "s string, t long, v double", str(tmp_path / "q"))
    means = run_to_table(rolling_means_by_state(stream, "s", ["t"], "v", 3))
    assert sorted((r.t, r["mean"]) for r in means.collect()) == [(2, 200), (3, 300), (4, 400), (5, 500)]


def test_late_rows_are_left_out_of_state(spark, tmp_path):
    batches = [[("a", t, float(t)) for t in (1, 3, 4, 5)], [("a", 2, 2.0)], [("a", 6, 6.0)]]
    stream = replay_batches(spark, batches, "s string, t long, v double", str(tmp_path / "q"))
    means = run_to_table(rolling_means_by_state(stream, "s", ["t"], "v", 3))
    assert sorted((r.t, round(r["mean"], 2)) for r in means.collect()) == [(4, 2.67), (5, 4), (6, 5)]


def test_state_treats_missing_values_as_sql_does(spark, tmp_path):
    batches = [[("a", 1, 1.0), ("a", 2, None)], [("a", 3, 3.0), ("a", 4, None), ("a", 5, None)]]
    stream = replay_batches(spark, batches, "s string, t long, v double", str(tmp_path / "q"))
    means = run_to_table(rolling_means_by_state(stream, "s", ["t"], "v", 2))
    assert sorted((r.t, r["mean"]) for r in means.collect()) == [(2, 1), (3, 3), (4, 3), (5, None)]


def test_idle_state_is_forgotten(spark, tmp_path):
    rows = replay_batches(spark, [[("a", 1, 1.0)]], "s string, t long, v double", str(tmp_path / "q"))
    means = rolling_means_by_state(rows, "s", ["t"], "v", 2, ttl_ms=1000)
    query = start(means, format="noop", trigger=every("500 milliseconds"), count_state=True)
    finish(query, timeout=6)
    held = [r.state_rows for r in progress_report(spark, query).orderBy("batch").collect()]
    assert max(held) == 1 and held[-1] == 0


@pytest.mark.parametrize("how", ["inner", "left_semi", "left"])
def test_joins_do_not_depend_on_the_number_of_batches(spark, how):
    def joined(slices):
        items = table(spark, SF, "lineitem").select(*joins.ITEM)
        orders = table(spark, SF, "orders").select(*joins.ORDER)
        return joins.match_in_time(
            in_time_order(items, "l_shipdate", slices), in_time_order(orders, "o_orderdate", slices), how
        )

    one, many = joined(1), joined(6)
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_replay_in_time_order(spark):
    df = spark.createDataFrame([(i, (i * 37) % 50) for i in range(200)] + [(999, None)], "i int, t int")
    seen = {}

    def collect(batch, batch_id):
        seen[batch_id] = [r.t for r in batch.collect()]

    run_batches(in_time_order(df, "t", 5), collect)
    assert len(seen) == 5 and sum(map(len, seen.values())) == 201 and None in seen[0]
    ends = [(min(x for x in seen[k] if x is not None), max(x for x in seen[k] if x is not None)) for k in sorted(seen)]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
