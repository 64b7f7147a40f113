"""Session settings that queries need, applied for a limited scope and then restored."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# State lives in RocksDB: it spills to local disk instead of filling executor heap, all
# stores of an executor share one memory budget, and the changelog keeps each commit
# proportional to the rows that changed.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


@contextmanager
def scoped_conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Set session options for a block and put the earlier values back."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def utc(spark: SparkSession):
    """Pin the session to UTC, so that day windows start at UTC midnight."""
    return scoped_conf(spark, {"spark.sql.session.timeZone": "UTC"})


def state_partitions(spark: SparkSession) -> int:
    """Partition count for a new stateful query; it stays fixed for the checkpoint's life.

    A value chosen by the user is kept. Spark's untouched default of 200 is replaced by
    the cluster's parallelism: AQE does not resize stateful shuffles.
    """
    name = "spark.sql.shuffle.partitions"
    current = int(spark.conf.get(name))
    chosen = spark.sparkContext.getConf().contains(name) or current != 200
    return current if chosen else spark.sparkContext.defaultParallelism


def state_settings(
    spark: SparkSession, count_rows: bool = False, idle_batches: bool = True
) -> dict[str, str]:
    """Settings for a stateful query. Counting state rows costs a read before each write."""
    return STATE_STORE | {
        "spark.sql.streaming.noDataMicroBatches.enabled": str(idle_batches).lower(),
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": str(count_rows).lower(),
        "spark.sql.shuffle.partitions": str(state_partitions(spark)),
    }


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Without that setting a local-mode session uses its warehouse folder; a cluster must be
    told, since no folder of the driver's machine is known to be shared.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and spark.sparkContext.master.split("[")[0] == "local":
        named = spark.conf.get("spark.sql.warehouse.dir")
    if named:
        return named.rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other query uses."""
    return f"{shared_dir(spark)}/millrace/{label}-{uuid.uuid4().hex}"
