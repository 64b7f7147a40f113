"""Mixing sources to target weights by Pfair scheduling.

The documents of each source are put in a fixed pseudo-random order and cut into blocks of
equal size. In a fluid schedule all sources with blocks left are served at once, at rates that
are their weights scaled to a sum of one; a source that runs out leaves its rate to the others.
A block is released at the slot in which the fluid schedule starts it and due by the end of the
slot in which it is finished: with weight w and no source run out, floor((i - 1) / w) and
ceil(i / w) for i = 1, 2, ... In each slot the released block with the earliest deadline goes
first. Every block then gets a slot in its window (for unit blocks on one line this order finds
a schedule whenever there is one, and the fluid schedule shows that there is), so that after
any number of slots every source is off its exact target by less than one block.

Weights are never rounded and nothing is periodic, so no error adds up. The driver holds a few
numbers a source, and the heap those of sources with several blocks; slots are written as they
are found, and all rows get theirs by joins. No document is dropped or repeated.
"""

from __future__ import annotations

import heapq
from array import array
from bisect import bisect_left
from collections.abc import Iterator, Mapping, Sequence
from itertools import islice
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import free_name, written
from millrace.session import new_folder

#: Characters in a block. A longer document takes up several blocks.
BLOCK_SIZE = 1 << 16
#: Fluid times this near to a whole number are that number.
NEAR = 1e-6
#: Slots that are sent to Spark at a time.
PIECE = 200_000
#: Rows that one task numbers together.
BUCKET_ROWS = 1_000


def tempered(size: Column, power: float = 0.5) -> Column:
    """Target weight: sizes to a power below one raise small sources and lower large ones."""
    return F.pow(F.greatest(size, F.lit(1)).cast("double"), F.lit(power))


def slots_of(blocks: Sequence[int], weights: Sequence[float]) -> Iterator[tuple[int, int, int, int]]:
    """(source, block, release, due) of slots 0, 1, 2, ...; sources and blocks count from 0."""
    n, w = np.asarray(blocks, np.int64), np.asarray(weights, np.float64)
    by_end = np.argsort(n / w, kind="stable")
    # At virtual time v sources that end before v have all their blocks, the others v * w.
    ends = array("d", (n / w)[by_end].tobytes())
    ended = np.concatenate([[0], np.cumsum(n[by_end])])
    active = np.concatenate([np.cumsum(w[by_end][::-1])[::-1], [0.0]])

    def fluid(v: float) -> float:
        k = bisect_left(ends, v)
        t = float(ended[k] + v * active[k])
        return float(round(t)) if abs(t - round(t)) < NEAR else t

    first = np.argsort(-w, kind="stable")  # first blocks in order of their deadline
    ready: list[tuple[float, int, int, int]] = []  # (virtual deadline, source, block, release)
    waiting: list[tuple[int, int, int]] = []  # (release, source, block)
    at = 0
    for slot in range(int(n.sum())):
        while waiting and (waiting[0][0] <= slot or not ready and at == len(first)):
            release, s, block = heapq.heappop(waiting)
            heapq.heappush(ready, ((block + 1) / w[s], s, block, release))
        fresh = (1 / w[first[at]], int(first[at]), 0, 0) if at < len(first) else None
        if fresh and (not ready or fresh < ready[0]):
            v, s, block, release = fresh
            at += 1
        else:
            v, s, block, release = heapq.heappop(ready)
        end = fluid(v)
        yield s, block, release, ceil(end)
        if block + 1 < n[s]:
            heapq.heappush(waiting, (floor(end), s, block + 1))


def schedule(
    docs: DataFrame, weights: Mapping[str, float] | None = None, source: str = "source",
    key: str = "doc_id", text: str = "text", block_size: int = BLOCK_SIZE,
) -> DataFrame:
    """``docs`` with source_block, release, due, slot and place (its order inside the block).

    ``weights`` has a positive weight per source; without it the square roots of the sizes.
    A source without a weight is refused. A null source is the source ''. There may be any
    number of sources; the driver keeps some 100 bytes of each, more of those with several blocks. Sizes are in
    characters, and a null or empty text has size 1. ``release`` and ``due`` are slots. A
    document stands at the block in which it starts. Equal rows get places of their own; copies of
    one row, equal in all columns, are numbered together. Map columns are left out of the order.
    Columns of ``docs`` named like a result column are replaced. An empty table gives none.
    """
    names = ("source_block", "release", "due", "slot", "place")
    own = [c for c in docs.columns if c.lower() not in names]
    name, size, order, bucket, before, rank, start, slots = (
        free_name(docs, n)
        for n in ("m_source", "m_size", "m_order", "m_bucket", "m_before", "m_rank", "m_start", "m_slots")
    )
    rows = docs.select(
        *own,
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias(name),
        F.greatest(F.length(F.coalesce(F.col(text).cast("string"), F.lit(""))), F.lit(1)).cast("long").alias(size),
        # Of the whole row, so that the rows of a repeated or null key are spread too.
        F.xxhash64(*[f"`{f.name}`" for f in docs.schema if "map<" not in f.dataType.simpleString()]).alias(order),
    )
    total = docs.select(F.lit(1)).count()
    buckets = max(1, -(-total // BUCKET_ROWS))
    # The order inside a source is that of a hash; its upper bits are the bucket.
    rows = rows.withColumn(
        bucket, F.floor((F.shiftrightunsigned(F.col(order), 33) * F.lit(buckets)) / F.lit(1 << 31)).cast("int")
    )
    counts = written(rows.groupBy(name, bucket).agg(F.sum(size).alias("n")), "sizes")
    sources = _sources(counts.groupBy(name).agg(F.sum("n").alias("n")), weights, name, block_size)
    inside = Window.partitionBy(name, bucket).orderBy(order, key)
    earlier = Window.partitionBy(name).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(name, bucket, "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(start))
    # The slots of a bucket's blocks come with the bucket, so that texts are not dealt out again.
    of_bucket = (
        starts.join(sources.select(name, "number"), name)
        .withColumn(
            "block",
            F.explode(
                F.sequence(F.floor(F.col(start) / block_size), F.floor((F.col(start) + F.col("n") - 1) / block_size))
            ),
        )
        .join(_slots_table(sources), ["number", "block"])
        .groupBy(name, bucket, start)
        .agg(F.array_sort(F.collect_list(F.struct("block", "release", "due", "slot"))).alias(slots))
    )
    placed = (
        rows.withColumn(before, F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col(size))
        .withColumn(rank, F.row_number().over(inside))
        .join(of_bucket, [name, bucket])
        .withColumn(before, F.col(before) + F.col(start))
        .withColumn("source_block", F.floor(F.col(before) / F.lit(block_size)).cast("long"))
    )
    found = F.element_at(slots, (F.col("source_block") - F.col(slots)[0]["block"] + 1).cast("int"))
    return placed.select(
        *own, "source_block", *[found[n].alias(n) for n in ("release", "due", "slot")],
        # Blocks are in order of size before, so that this orders the documents of a block.
        (F.col(before) - F.col("source_block") * block_size).cast("long").alias("place"),
    )


def _sources(sizes: DataFrame, weights: Mapping[str, float] | None, name: str, block_size: int) -> DataFrame:
    """Each source with its number, blocks and target weight ``w``."""
    if weights is None:
        table = sizes.withColumn("w", tempered(F.col("n")))
    else:
        given = [(s, float(w)) for s, w in weights.items()]
        table = sizes.join(sizes.sparkSession.createDataFrame(given, f"`{name}` string, w double"), name, "left")
        for row in table.where("w is null or not (w > 0 and w < double('inf'))").limit(1).collect():
            raise KeyError(row[name]) if row["w"] is None else ValueError(f"weight of {row[name]!r}: {row['w']}")
    table = table.withColumn("blocks", F.ceil(F.col("n") / block_size)).drop("n")
    # Numbers are in order of names, for equal results every time.
    return written(table.orderBy(name).withColumn("number", F.monotonically_increasing_id()), "sources")


def _slots_table(sources: DataFrame) -> DataFrame:
    """One row per block: number of the source, block, release, due and slot."""
    spark, folder = sources.sparkSession, new_folder(sources.sparkSession, "slots")
    kind = pa.schema([(c, pa.int64()) for c in ("number", "block", "release", "due", "slot")])
    numbers, blocks, weights = array("q"), array("q"), array("d")
    for number, n, w in sources.select("number", "blocks", "w").orderBy("number").toLocalIterator():
        numbers.append(number)
        blocks.append(n)
        weights.append(w)
    found, slot = slots_of(blocks, weights), 0
    while True:
        piece = np.array(list(islice(found, PIECE)), np.int64).reshape(-1, 4)
        if not len(piece) and slot:
            break
        columns = [np.asarray(numbers, np.int64)[piece[:, 0]], *piece[:, 1:].T, np.arange(slot, slot + len(piece))]
        table = pa.table([pa.array(c, pa.int64()) for c in columns], schema=kind)
        spark.createDataFrame(table).write.mode("append").parquet(folder)
        slot += len(piece)
        if len(piece) < PIECE:
            break
    return spark.read.schema("number long, block long, release long, due long, slot long").parquet(folder)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with its own columns only, written in the order of the schedule.

    Rows are range-partitioned by slot and sorted inside each partition, so that reading the
    partitions in turn gives the mixture.
    """
    ordered = schedule(docs, **options).repartitionByRange("slot", "place")
    return ordered.sortWithinPartitions("slot", "place").select(*docs.columns)
