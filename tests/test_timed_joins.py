"""Joins with watermarks whose rows wait packed, against Spark's own join of streams."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import timed_joins
from millrace.operators.joins import spread_join, stream_anti_join
from millrace.operators.timed_joins import Span
from millrace.plans import joins
from millrace.plans.registry import QUERIES
from millrace.session import scoped_conf
from millrace.sources.replay import replay_batches
from millrace.streaming.runtime import run_to_table

DAY = 86_400
SPAN = Span("lt", "rt", -5_000, 20_000)


def late_batches(seed):
    """Rows of both sides in batches of rising times, some late, some without a key or a time."""
    rng = random.Random(seed)

    def made(count, start):
        keys = [3, 3, 3, None, *range(6)]
        ticks = [None, *(start + rng.randrange(-60, 60) / 2 for _ in range(20))]
        return [(rng.choice(keys), rng.choice([None, 1.5]), rng.choice(ticks)) for _ in range(count)]

    return [[made(rng.choice([1, 12, 25]), 100 + 25 * k) for k in range(5)] for _ in range(2)]


def streams(spark, folder, batches):
    sides = []
    for side, rows in zip("lr", batches, strict=True):
        stream = replay_batches(spark, rows, f"{side}k long, {side}v double, t double", f"{folder}/{side}")
        stream = stream.withColumn(f"{side}t", F.timestamp_micros((F.col("t") * 1_000_000).cast("long")))
        sides.append(stream.drop("t").withWatermark(f"{side}t", "10 seconds"))
    return sides


def joined(spark, folder, batches, how, packed, hot=None):
    left, right = streams(spark, folder, batches)
    if how == "left_anti":
        return stream_anti_join(left, right, "lk", "rk", SPAN, packed=packed)
    return spread_join(
        left, right, "lk", "rk", how, hot=hot, row_id=["lt"], partitions=4, within=SPAN, packed=packed
    )


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize(
    "how, rule", [("inner", "true"), ("left_semi", "true"), ("left_anti", "true"), ("left", "true"), ("left", "false")]
)
def test_packed_join_cuts_its_state_as_sparks_join_does(spark, tmp_path, monkeypatch, how, rule):
    monkeypatch.setattr(timed_joins, "STEP", 3)
    monkeypatch.setattr(timed_joins, "OUT_BYTES", 100)
    monkeypatch.setattr(timed_joins, "PACK_BYTES", 100)
    batches = late_batches(11)
    hot = {3: 0.4} if how in ("inner", "left_semi") else None
    with scoped_conf(spark, {"spark.sql.streaming.statefulOperator.allowMultiple": rule}):
        want = run_to_table(joined(spark, tmp_path / "spark", batches, how, None))
        got = joined(spark, tmp_path / "packed", batches, how, 3, hot)
        assert got.columns == want.columns
        got = run_to_table(got)
        assert rows_of(got) == rows_of(want) and want.count()


@pytest.mark.parametrize("kind", ["string", "double"])
def test_packed_join_refuses_keys_that_it_cannot_compare(spark, tmp_path, kind):
    left, right = streams(spark, tmp_path, [[[(1, 1.0, 1.0)]]] * 2)
    left, right = (df.withColumn(k, F.col(k).cast(kind)) for df, k in ((left, "lk"), (right, "rk")))
    with pytest.raises(ValueError, match="whole numbers"):
        spread_join(left, right, "lk", "rk", within=SPAN, packed=3)


@pytest.mark.parametrize("name", ["interval", "anti", "semi", "left"])
def test_rows_that_wait_are_one_entry_a_bucket(spark, tmp_path, monkeypatch, name):
    rng = random.Random(7)
    items = [(k % 60, k, 1, 2, 800_000_000 + rng.randrange(400) * DAY) for k in range(600)]
    orders = [(k, k % 7, 800_000_000 + rng.randrange(400) * DAY) for k in range(60)]
    for table, rows, columns, time in (
        ("lineitem", items, joins.ITEM, "l_shipdate"), ("orders", orders, joins.ORDER, "o_orderdate"),
    ):
        stamp = F.timestamp_seconds(F.col(time)).cast("timestamp_ntz")
        df = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in columns)).withColumn(time, stamp)
        df.coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    monkeypatch.setattr(joins, "TIMED_BUCKETS", 5, raising=False)
    checkpoint = str(tmp_path / "checkpoint")

    def recorded(df, **kwargs):
        return run_to_table(df, path=str(tmp_path / "out"), checkpoint=checkpoint, **kwargs)

    monkeypatch.setattr(joins, "run_to_table", recorded)
    got = QUERIES[f"stream_stream_{name}"](spark, str(tmp_path)).collect()
    pairs = [
        i[1] for i in items for o in orders if i[0] == o[0] and 0 <= i[4] - o[2] <= 90 * DAY
    ]
    mark = min(max(i[4] for i in items), max(o[2] for o in orders)) - 10 * DAY
    alone = [i[1] for i in items if i[1] not in pairs and i[4] < mark]
    want = {"interval": pairs, "semi": set(pairs), "anti": alone, "left": pairs + alone}[name]
    assert sorted(row["l_linenumber"] for row in got) == sorted(want) and want
    assert 0 < spark.read.format("statestore").load(checkpoint).count() <= 5
