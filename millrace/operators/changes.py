"""Apply a change feed to a table.

A feed row has an operation (``I``, ``U``, ``D``, or NULL for a full-load row) and data
columns. Tables and change sets have the columns ``Op``, ``key`` (a struct) and ``value``
(a struct of all data columns).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.tables import stored

INSERT, UPDATE, DELETE = "I", "U", "D"


def flag_deletes(feed: DataFrame) -> DataFrame:
    """Add ``deleted``; it is NULL where the operation is NULL."""
    return feed.withColumn("deleted", F.col("Op") == DELETE)


def keyed(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pack a feed into ``Op, key, value``."""
    data = [c for c in feed.columns if c != "Op"]
    return feed.select("Op", F.struct(*keys).alias("key"), F.struct(*data).alias("value"))


def split_feed(feed: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """Full-load rows and change rows; a feed without ``Op`` is all full load."""
    if "Op" not in feed.columns:
        return feed, None
    packed = keyed(flag_deletes(feed), keys)
    return packed.filter(F.col("Op").isNull()), packed.filter(F.col("Op").isNotNull())


def latest_by_struct(changes: DataFrame) -> DataFrame:
    """Largest ``value`` per key and operation, fields compared from left to right.

    This is the newest row only when the ordering column is the first field that differs.
    """
    return _per_key(changes, F.max("value").alias("value"), also=["Op"]).select(
        "Op", "key", "value"
    )


def latest_by(changes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Newest row per key and operation by named fields of ``value``."""
    newest = F.max(_ordered(order, "value")).alias("_newest")
    return _per_key(changes, newest, also=["Op"]).select(
        "Op", "key", F.col("_newest.value").alias("value")
    )


def _per_key(df: DataFrame, *aggregates: Column, also: Sequence[str] = ()) -> DataFrame:
    """Group by the fields of ``key``: plain columns sort and hash faster than a struct."""
    names = df.schema["key"].dataType.names
    fields = [f"_key{i}" for i in range(len(names))]
    keys = [F.col("key")[name].alias(field) for name, field in zip(names, fields)]
    key = F.struct(*[F.col(field).alias(name) for name, field in zip(names, fields)])
    grouped = df.groupBy(*keys, *also).agg(*aggregates)
    return grouped.select(key.alias("key"), *[c for c in grouped.columns if c not in fields])


def _same_key(names: Sequence[str]) -> Column:
    """Keys of the aliases ``t`` and ``c`` agree; no field of a key may be NULL."""
    same = F.lit(True)
    for name in names:
        same = same & (F.col("t.key")[name] == F.col("c.key")[name])
    return same


def change_set(
    changes: DataFrame, updates: DataFrame, order: Sequence[str], ordered: bool = False
) -> DataFrame:
    """All inserts and deletes with the latest updates, sorted in feed order if asked for.

    A merge does not need the sort. The key is part of it so that rows sharing one time stamp
    can still be divided between range partitions.
    """
    rows = changes.filter(F.col("Op").isin(INSERT, DELETE)).unionByName(updates)
    return rows.orderBy(*[F.col(f"value.{c}") for c in order], "key") if ordered else rows


def _ordered(order: Sequence[str], *payload: str) -> Column:
    """Order fields first, so that ``max`` picks the newest and carries the payload along.

    Rows that tie on the order fields are decided by the payload, the same way every time.
    """
    return F.struct(*[F.col(f"value.{c}").alias(f"_{c}") for c in order], *payload)


# At equal order fields a delete comes first, then an insert, then an update.
RANKS = ((DELETE, 0), (INSERT, 1), (UPDATE, 2))


def resolve(changes: DataFrame, order: Sequence[str], on_conflict: str = "error") -> DataFrame:
    """One row per changed key: what its changes, taken in feed order, leave to be done.

    Rows up to the last delete do not matter, so ``deleted`` says that there was one. Of the
    rows after it (all rows without one), ``insert`` is the first insert, ``update`` the last
    update, and ``update_later`` whether that update follows the insert.

    Rows that agree on ``order`` go by operation (delete, insert, update) and then by the
    fields of ``value`` from left to right, so that the order is total.

    Several updates or deletes of a key, or several inserts, are a conflict. ``"error"``
    fails the query then; ``"latest"`` goes by ``order``.
    """
    if on_conflict not in ("error", "latest"):
        raise ValueError(f"unknown on_conflict: {on_conflict}")
    names = changes.schema["key"].dataType.names
    rank = F.lit(None).cast("int")
    for operation, number in RANKS:
        rank = F.when(F.col("Op") == operation, number).otherwise(rank)
    at = F.struct(*[F.col(f"value.{c}").alias(f"_{c}") for c in order], rank.alias("_rank"))
    placed = changes.filter(rank.isNotNull()).select("Op", "key", "value", at.alias("_at"))

    deletes = _per_key(
        placed,
        F.max(F.when(F.col("Op") == DELETE, F.col("_at"))).alias("_deleted"),
        F.count(F.when(F.col("Op") == INSERT, 1)).alias("_inserts"),
        F.count(F.when(F.col("Op") != INSERT, 1)).alias("_changes"),
    )
    if on_conflict == "error":
        clash = (F.col("_changes") > 1) | (F.col("_inserts") > 1)
        message = F.concat(F.lit("several changes for key "), F.to_json("key"))
        deletes = deletes.filter(F.when(clash, F.raise_error(message)).otherwise(F.lit(True)))
    later = (
        placed.alias("t").join(deletes.alias("c"), _same_key(names), "left")
        .filter(F.col("_deleted").isNull() | (F.col("_at") >= F.col("_deleted")))
        .select("t.Op", "t.key", "t.value", "_at", F.col("_deleted").isNotNull().alias("_gone"))
    )
    row = F.struct("_at", "value")
    # The last delete itself is among the rows, so that its key is not lost.
    resolved = _per_key(
        later,
        F.max("_gone").alias("deleted"),
        F.min(F.when(F.col("Op") == INSERT, row)).alias("_insert"),
        F.max(F.when(F.col("Op") == UPDATE, row)).alias("_update"),
    )
    return resolved.select(
        "key",
        "deleted",
        F.col("_insert.value").alias("insert"),
        F.col("_update.value").alias("update"),
        (F.col("_update._at") > F.col("_insert._at")).alias("update_later"),
    )


def merge_changes(
    target: DataFrame, changes: DataFrame, order: Sequence[str], on_conflict: str = "error"
) -> DataFrame:
    """The next version of ``target``, whose keys are unique, after all changes in feed order.

    Key present: a delete removes the row, an update replaces its value (``Op`` stays as it
    was), an insert is ignored. Key absent: an insert adds the row, anything else is
    ignored. Keys with a NULL field match nothing in the target. How the two sides are
    joined is left to Spark.
    """
    resolved = stored(resolve(changes, order, on_conflict), "changes")
    same = _same_key(target.schema["key"].dataType.names)
    both = target.alias("t").join(resolved.alias("c"), same, "full")
    # The row is still there, as opposed to never there or deleted.
    present = F.col("t.key").isNotNull() & ~F.coalesce(F.col("c.deleted"), F.lit(False))
    added = F.col("c.insert").isNotNull()
    changed = F.when(F.col("c.update_later"), F.col("c.update")).otherwise(F.col("c.insert"))
    return both.filter(present | added).select(
        F.when(present, F.col("t.Op")).otherwise(F.lit(INSERT)).alias("Op"),
        F.coalesce("t.key", "c.key").alias("key"),
        F.when(present, F.coalesce("c.update", "t.value")).otherwise(changed).alias("value"),
    )


def newest_first(table: DataFrame, order: str, condition: Column | None = None) -> DataFrame:
    """Flat rows of a keyed table, newest first, optionally those matching ``condition``.

    The condition may use any field of ``value``; it is applied before the projection.
    """
    rows = table if condition is None else table.filter(condition)
    return rows.orderBy(F.col(f"value.{order}").desc(), "key").select("Op", "value.*")


# --- a table in buckets of its keys -----------------------------------------------------------


def bucket_of(key: Column, names: Sequence[str], buckets: int) -> Column:
    """Bucket of a key struct; all NULL keys share one."""
    return F.pmod(F.xxhash64(*[key[name] for name in names]), F.lit(buckets)).cast("int")


def write_buckets(table: DataFrame, path: str, buckets: int) -> None:
    """First version of a keyed table, laid out in one folder per bucket of its keys."""
    _put(table, path, buckets, table.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")))


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where("key IS NOT NULL").drop("bucket")


def _put(rows: DataFrame, path: str, buckets: int, touched: DataFrame) -> None:
    """Replace the touched buckets. Each gets a row without a key, so that one that has lost all
    its rows is replaced as well."""
    names = rows.schema["key"].dataType.names
    placed = rows.withColumn("bucket", bucket_of(F.col("key"), names, buckets))
    marks = touched.select(
        *[F.lit(None).cast(field.dataType).alias(field.name) for field in rows.schema.fields], "bucket"
    )
    (
        placed.unionByName(marks).repartition("bucket").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    )


def merge_buckets(
    spark: SparkSession, path: str, changes: DataFrame, order: Sequence[str], buckets: int,
    on_conflict: str = "error",
) -> list[int]:
    """Apply changes to a table written by ``write_buckets``, as ``merge_changes`` does, reading
    and rewriting only the buckets that hold a changed key; the other folders keep their files.

    Returns those buckets, of which there are at most ``buckets``. The new rows are stored
    before the old ones are replaced, so a failed write can be repeated. Choose the number of
    buckets so that one bucket is a good size for a task's file.
    """
    names = changes.schema["key"].dataType.names
    placed = changes.withColumn("bucket", bucket_of(F.col("key"), names, buckets))
    touched = sorted(row.bucket for row in placed.select("bucket").distinct().collect())
    if not touched:
        return []
    current = spark.read.parquet(path).where(F.col("bucket").isin(touched) & F.col("key").isNotNull())
    merged = stored(merge_changes(current.drop("bucket"), changes, order, on_conflict), "merged")
    _put(merged, path, buckets, spark.createDataFrame([(b,) for b in touched], "bucket int"))
    return touched
