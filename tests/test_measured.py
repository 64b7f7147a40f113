"""Row counts and sums measured on the smallest tables. Fixed values."""

import __spark_entry__  # noqa: F401  registers the queries
import pytest
from pyspark.sql import functions as F

from millrace.operators.joins import spread_join
from millrace.plans.registry import QUERIES
from millrace.sources.tables import table_stream
from millrace.streaming.runtime import run_to_table

SF = "/root/testdata/sf0.001"


def test_sliding_windows(spark):
    assert QUERIES["window_sliding_sum"](spark, SF).count() == 743


def test_rolling_means(spark):
    for name in ("rolling_mean_batch", "rolling_mean_stream"):
        means = QUERIES[name](spark, SF).agg(F.count("mean"), F.sum("mean")).first()
        assert means[0] == 970 and means[1] == pytest.approx(48525.73, abs=0.01)


def test_closed_windows(spark):
    closed = QUERIES["watermark_window_count"](spark, SF)
    assert closed.select("start").distinct().count() == 528
    assert str(closed.agg(F.max("end")).first()[0]) == "2024-01-30 20:00:00"


@pytest.mark.parametrize("hot", [None, {3: 0.2, 5: 0.1}])
def test_clicks_joined_with_purchases(spark, hot):
    def kind(name, column):
        events = table_stream(spark, SF, "events").filter(F.col("event_type") == name)
        return events.select(F.col("user_id").alias(column), F.col("event_id").alias(f"{column}_id"))

    joined = spread_join(
        kind("click", "c"), kind("purchase", "p"), "c", "p", hot=hot, row_id=["c_id"]
    )
    assert run_to_table(joined).count() == 2784
