"""Joins, rolling means, windows and merges against brute force on small rows."""

import itertools
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from millrace.operators import changes, joins, windows
from millrace.operators.aggregates import approx_distinct, numeric_aggregate, ratio_of_sums
from millrace.operators.joins import heavy_keys, spread_join
from millrace.operators.rolling import last_rows, rolling_mean
from millrace.sources.replay import replay_batches
from millrace.sources.tables import table, table_stream
from millrace.streaming.runtime import run_to_table, start

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- joins -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    left = [(i, 7 if i % 3 == 0 else i % 11) for i in range(300)]
    right = [(k, f"n{k}") for k in range(9)]
    return (
        spark.createDataFrame(left, "id int, k int"),
        spark.createDataFrame(right, "rk int, name string"),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(skewed, how):
    left, right = skewed
    plain = left.join(right, F.col("k") == F.col("rk"), how)
    spread = spread_join(left, right, "k", "rk", how, hot={7: 0.39, 10: 0.06}, row_id=["id"], partitions=16)
    assert rows(spread) == rows(plain)


def test_spread_join_uses_several_tasks_for_a_hot_key(spark, skewed):
    left, right = skewed
    hint = right.hint("merge")
    joined = spread_join(left, hint, "k", "rk", hot={7: 0.39}, row_id=["id"], partitions=64)
    with_task = joined.filter("k = 7").select(F.spark_partition_id().alias("task"))
    setting = "spark.sql.adaptive.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        assert with_task.distinct().count() > 1
    finally:
        spark.conf.set(setting, before)


def test_spread_join_refuses_what_it_cannot_do(skewed):
    left, right = skewed
    with pytest.raises(ValueError):
        spread_join(left, right, "k", "rk", "full", hot={7: 0.5}, row_id=["id"])
    with pytest.raises(ValueError):
        spread_join(left, right, "k", "rk", hot={7: 0.5})


def test_heavy_keys(skewed, spark):
    left, _ = skewed
    count = left.filter("k = 7").count()
    assert heavy_keys(left, "k", min_share=0.3) == {7: count / 300}
    assert set(heavy_keys(left, "k")) == set(range(11))
    assert heavy_keys(left.filter("k < 0"), "k") == {}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_rows_without_a_key_are_spread_too(spark, how):
    left = spark.createDataFrame([(i, None if i % 2 else i % 5) for i in range(40)], "id int, k int")
    right = spark.createDataFrame([(0, "a"), (2, "b"), (None, "c")], "rk int, name string")
    hot = heavy_keys(left, "k", min_share=0.3)
    assert hot == {None: 0.5}
    spread = spread_join(left, right, "k", "rk", how, hot=hot, row_id=["id"], partitions=8)
    assert rows(spread) == rows(left.join(right, F.col("k") == F.col("rk"), how))


def test_spread_stream_join(spark):
    plain = spread_join(
        table_stream(spark, SF, "lineitem").select("l_orderkey", "l_linenumber"),
        table_stream(spark, SF, "orders").select("o_orderkey"),
        "l_orderkey", "o_orderkey", hot={1: 0.4, 2: 0.1, 3: 0.1},
        row_id=["l_linenumber"], partitions=8,
    )
    assert run_to_table(plain).count() == table(spark, SF, "lineitem").count()


@pytest.mark.parametrize("hot", [None, {3: 0.3, None: 0.1}])
def test_packed_join_over_several_batches(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(joins, "PACK_ROWS", 3)
    monkeypatch.setattr(joins, "PACK_BYTES", 500)
    rng = random.Random(5)

    def made(count):
        keys = [3, 3, None, *range(12)]
        return [(rng.choice(keys), rng.choice([None, "a", "\u00e9"]), rng.randrange(9)) for _ in range(count)]

    left, right = ([made(40), made(1), made(25)] for _ in range(2))
    streams = [
        replay_batches(spark, batches, schema, str(tmp_path / schema[0]))
        for batches, schema in ((left, "k long, s string, n int"), (right, "rk long, rs string, rn int"))
    ]
    got = spread_join(
        *streams, "k", "rk", hot=hot, row_id=["n"], partitions=8, within=F.expr("n <= rn"), packed=4
    )
    want = [x + y for x in sum(left, []) for y in sum(right, []) if None is not x[0] == y[0] and x[2] <= y[2]]
    assert got.columns == ["k", "s", "n", "rk", "rs", "rn"]
    assert rows(run_to_table(got)) == sorted(want, key=repr)


def test_packed_join_refuses_what_it_cannot_do(skewed):
    left, right = skewed
    with pytest.raises(ValueError, match="left join"):
        spread_join(left, right, "k", "rk", "left", packed=4)
    with pytest.raises(ValueError, match="one type"):
        spread_join(left, right.withColumn("rk", F.col("rk").cast("long")), "k", "rk", packed=4)


# Which joins Spark accepts between a stream and a table, and between two streams.
STREAM_TABLE = {"inner", "left", "left_semi", "left_anti"}
TABLE_STREAM = {"inner", "right"}
STREAM_STREAM = {"inner"}
BOUNDED_STREAMS = {"inner", "left", "right", "full", "left_semi"}
KINDS = ["inner", "left", "right", "full", "left_semi", "left_anti"]


def allowed(joined):
    try:
        query = start(joined, format="noop")
    except AnalysisException:
        return False
    query.stop()
    return True


@pytest.mark.parametrize("how", KINDS)
def test_join_rules(spark, how):
    def side(read, name):
        timed = read(spark, SF, "events").withColumn("ts", F.col("ts").cast("timestamp"))
        return timed.select(F.col("user_id").alias(f"u{name}"), F.col("ts").alias(f"t{name}"))

    same = F.col("u1") == F.col("u2")
    near = same & F.expr("t1 <= t2 AND t2 <= t1 + INTERVAL 1 HOUR")
    s1, s2 = side(table_stream, 1), side(table_stream, 2)
    b1, b2 = side(table, 1), side(table, 2)
    assert allowed(s1.join(b2, same, how)) == (how in STREAM_TABLE)
    assert allowed(b1.join(s2, same, how)) == (how in TABLE_STREAM)
    assert allowed(s1.join(s2, same, how)) == (how in STREAM_STREAM)
    marked = s1.withWatermark("t1", "1 hour").join(s2.withWatermark("t2", "1 hour"), near, how)
    assert allowed(marked) == (how in BOUNDED_STREAMS)


# --- rolling means ---------------------------------------------------------------------


def brute_means(data, n):
    by_key = defaultdict(list)
    for key, t, i, v in data:
        by_key[key].append((t, i, v))
    out = []
    for key, entries in by_key.items():
        entries.sort()
        for j in range(n - 1, len(entries)):
            frame = [v for _, _, v in entries[j - n + 1: j + 1]]
            out.append((key, entries[j][1], round(sum(frame) / n, 6)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [1, 2, 3, 7])
@pytest.mark.parametrize("segments", [2, 9, 60])
def test_split_keys_give_the_same_means(spark, n, segments):
    rng = random.Random(n * 100 + segments)
    data = [
        (rng.choice(["hot", "hot", "a", "b", None]), rng.randint(0, 60), i, float(rng.randint(0, 99)))
        for i in range(200)
    ] + [("few", i, 1000 + i, 1.0) for i in range(3)]
    df = spark.createDataFrame(data, "k string, t long, id long, v double")
    found = rolling_mean(df, "k", ["t", "id"], "v", n, segments=segments)
    got = sorted(((r.k, r.id, round(r["mean"], 6)) for r in found.collect()), key=repr)
    assert got == brute_means(data, n)


def test_a_missing_value_is_a_row_but_not_in_the_mean(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, None), ("a", 3, 3.0)], "k string, t int, v double")
    found = rolling_mean(df, "k", ["t"], "v", 2)
    assert rows(found.select("t", "mean")) == [(2, 1.0), (3, 3.0)]


def test_last_rows(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 1)], "k string, t int")
    assert rows(last_rows(df, ["k"], ["t"], 2)) == [("a", 3), ("a", 4), ("b", 1)]


def test_last_rows_are_cut_before_the_shuffle(spark):
    df = last_rows(table(spark, SF, "events").select("user_id", "ts"), ["user_id"], ["ts"], 2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


# --- windows ---------------------------------------------------------------------------


def test_buckets_and_direct_windows_agree(spark):
    events = table(spark, SF, "events")
    measures = {
        "n": ("count", F.lit(1)),
        "low": ("min", F.col("value")),
        "high": ("max", F.col("value")),
        "whole": ("sum", F.col("value").cast("decimal(18,2)")),
    }
    args = ("ts", "1 day", "6 hours", measures, ["event_type"])
    two_step = windows.sliding_totals(events, *args)
    direct = windows.window_totals(events, "ts", "1 day", measures, ["event_type"], "6 hours")
    assert rows(two_step) == rows(direct)


def test_sliding_windows_of_one_row(spark):
    df = spark.sql("SELECT timestamp_ntz'1970-01-01 00:00:07' AS ts, 'x' AS v")
    found = windows.window_rows(df, "ts", "10 seconds", "5 seconds")
    assert [r.start.second for r in found.orderBy("start").collect()] == [0, 5]


def test_top_item_of_a_tie_is_the_first_by_name(spark):
    totals = spark.createDataFrame(
        [(1, 2, "b", 5), (1, 2, "a", 5), (1, 2, "c", 4)], "start int, end int, item string, total int"
    )
    assert rows(windows.top_per_window(totals, "item", "total")) == [(1, 2, "a", 5)]
    assert [r.total for r in windows.ranked(totals, "total").collect()] == [5, 5, 4]


# --- aggregates ------------------------------------------------------------------------


@pytest.mark.parametrize(
    "function, expected",
    [(F.sum, 6), (F.mean, 2.0), (F.min, 1), (F.max, 3), (F.count, 3), (F.stddev, 1.0)],
)
def test_numeric_aggregates_skip_text(spark, function, expected):
    lines = spark.createDataFrame([("1",), ("x",), ("2",), ("3",), ("",)], "value string")
    assert numeric_aggregate(lines, function).first().result == expected


def test_ratio_of_totals(spark):
    df = spark.createDataFrame([("v", 1, 10), ("v", 3, 50), ("z", 0, 5)], "t string, n int, s int")
    assert rows(ratio_of_sums(df, "t", "s", "n", "mean")) == [("v", 15.0), ("z", None)]


def test_approximate_count_is_close(spark):
    events = table(spark, SF, "events")
    near = approx_distinct(events, "event_id", name="n").first().n
    assert abs(near - events.count()) <= 0.1 * events.count()


# --- change feeds ----------------------------------------------------------------------


def feed(spark, entries):
    return spark.createDataFrame(entries, "Op string, ID int, t int, AKEY string")


def brute_merge(target, change_rows):
    """Apply the changes one after another; of equal times a delete, an insert, an update."""
    merged = dict(target)
    for op, key, t, value in sorted(change_rows, key=lambda c: (c[2], "DIU".index(c[0]), c[3])):
        if op == "D":
            merged.pop(key, None)
        elif op == "I":
            merged.setdefault(key, ("I", t, value))
        elif key in merged:
            merged[key] = (merged[key][0], t, value)
    return sorted(((k, *v) for k, v in merged.items()), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_merge_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    target = {k: (None, 0, "old") for k in range(0, 30, 2)}
    change_rows = [
        (rng.choice("IUD"), rng.randrange(30), rng.randrange(9), rng.choice("xyz"))
        for _ in range(110)
    ]
    loaded = feed(spark, [(op, k, t, a) for k, (op, t, a) in target.items()])
    load, changed = changes.split_feed(
        loaded.unionByName(feed(spark, change_rows)), ["ID"]
    )
    merged = changes.merge_changes(load, changed, ["t"], "latest")
    got = rows(merged.select("value.ID", "Op", "value.t", "value.AKEY"))
    assert got == brute_merge(target, change_rows)


@pytest.mark.parametrize(
    "present, operations, expected",
    [
        (False, "ID", []),
        (False, "IU", [("I", 2)]),
        (True, "DI", [("I", 2)]),
        (False, "UI", [("I", 2)]),
        (True, "UIU", [(None, 3)]),
        (True, "DIUD", []),
        (True, "DU", []),
        (False, "II", [("I", 1)]),
        (True, "DIIU", [("I", 4)]),
    ],
)
def test_changes_apply_in_feed_order(spark, present, operations, expected):
    entries = [(op, 1, t, "new") for t, op in enumerate(operations, 1)]
    loaded = [(None, 1, 0, "old")] if present else []
    load, changed = changes.split_feed(feed(spark, [*loaded, *entries]), ["ID"])
    merged = changes.merge_changes(load, changed, ["t"], "latest")
    assert rows(merged.select("Op", "value.t")) == expected


SINGLE_CHANGES = {
    ("U", True): [(None, 1, 5, "new")],
    ("D", True): [],
    ("I", True): [(None, 1, 0, "old")],
    ("U", False): [],
    ("D", False): [],
    ("I", False): [("I", 1, 5, "new")],
}


@pytest.mark.parametrize("op, present", SINGLE_CHANGES)
def test_merge_rules(spark, op, present):
    loaded = [(None, 1, 0, "old")] if present else []
    load, changed = changes.split_feed(feed(spark, [*loaded, (op, 1, 5, "new")]), ["ID"])
    merged = changes.merge_changes(load, changed, ["t"])
    got = rows(merged.select("Op", "value.ID", "value.t", "value.AKEY"))
    assert got == SINGLE_CHANGES[op, present]


def test_conflicting_changes_fail_unless_resolved(spark):
    _, changed = changes.split_feed(feed(spark, [("U", 1, 1, "a"), ("D", 1, 2, "a")]), ["ID"])
    with pytest.raises(Exception, match="several changes for key"):
        changes.resolve(changed, ["t"]).collect()
    resolved = changes.resolve(changed, ["t"], "latest").first()
    assert resolved.deleted and resolved.update is None
    with pytest.raises(ValueError):
        changes.resolve(changed, ["t"], "newest")


def test_a_delete_comes_first_in_a_tie(spark):
    for order in itertools.permutations([("I", 1, 1, "z"), ("D", 1, 1, "a"), ("U", 1, 1, "u")]):
        _, changed = changes.split_feed(feed(spark, list(order)), ["ID"])
        resolved = changes.resolve(changed, ["t"], "latest").first()
        assert resolved.deleted and resolved.insert.AKEY == "z"
        assert resolved.update.AKEY == "u" and resolved.update_later


def test_deleted_flag_is_three_valued(spark):
    flagged = changes.flag_deletes(feed(spark, [("D", 1, 1, "a"), ("I", 2, 1, "a"), (None, 3, 1, "a")]))
    assert [r.deleted for r in flagged.orderBy("ID").collect()] == [True, False, None]


def test_feed_without_operations_is_all_load(spark):
    plain = spark.createDataFrame([(1, "a")], "ID int, AKEY string")
    load, changed = changes.split_feed(plain, ["ID"])
    assert changed is None and load.columns == ["ID", "AKEY"]


def test_largest_struct_compares_left_to_right(spark):
    df = spark.createDataFrame([(1, 9), (2, 1), (None, 99)], "a int, b int")
    key = F.struct(F.lit(1).alias("ID")).alias("key")
    packed = df.select(F.lit("U").alias("Op"), key, F.struct("a", "b").alias("value"))
    assert tuple(changes.latest_by_struct(packed).first().value) == (2, 1)
    assert tuple(changes.latest_by(packed, ["b"]).first().value) == (None, 99)
