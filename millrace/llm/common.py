"""Helpers that several operators of this package share."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import new_folder

#: A word is a longest run of characters other than the six ASCII white-space characters.
BLANKS = r"[\x20\x09-\x0D]+"


def written(df: DataFrame, label: str) -> DataFrame:
    """Store a DataFrame in the shared folder and read it back.

    This cuts the lineage: a lost executor costs only the tasks of the current step.
    """
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8 with A-Z in lower case; a null text has none.

    ``bytes.split`` and ``bytes.lower`` know ASCII only, which is the definition used here.
    """
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()


def texts_in(batch: pa.RecordBatch, name: str = "text") -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that no column of ``df`` has, compared without case as Spark does."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"{wanted}_{uuid.uuid4().hex[:8]}"
    return wanted


def crc_remainder(key: Column, divisor: int) -> Column:
    """crc32 of an id written as text, modulo a number; a null id counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % divisor


def hash_below(code: Column, wanted: int, total: int) -> Column:
    """Whether a row with this 64-bit hash is among about ``wanted`` of ``total`` rows.

    Unlike the first rows of a sort, of which every task would send the wanted number to the
    driver, this sends about the wanted number in all.
    """
    if total <= wanted:
        return F.lit(True)
    return F.shiftrightunsigned(code, 1) < F.lit(int((1 << 63) * (wanted / total)))


def ragged_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``range(start, start + length)`` over all pairs."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each linked id other than the smallest of its component, with that smallest id.

    At most one link per id leaves a task, however many links connect the ids inside it.
    """
    if not len(left):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    ids, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = at[: len(left)], at[len(left):]
    root = np.arange(len(ids))
    while True:
        # Hook the larger root onto the smaller, then halve the paths.
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            break
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(up := root[root], root):
            root = up
    moved = root != np.arange(len(ids))
    return ids[moved], ids[root[moved]]


def components(links: DataFrame) -> DataFrame:
    """Smallest id reachable from each linked id, as (node, component).

    ``links`` has integer columns ``a`` and ``b``. Large-star and small-star steps (Kiveris
    and others, 2014) are repeated until the links no longer change; each step is written to
    the shared folder. A hub's rows come out of a map-side minimum and an equi-join whose
    large partitions Spark splits, so that no task holds a hub's neighbours together.
    """
    links = links.select(F.col("a").cast("long"), F.col("b").cast("long"))
    links = written(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    seen = None
    while True:
        mark = links.agg(
            F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.expr("sum(b % 1000003)")
        ).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        links = written(_small_star(_large_star(links)), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a").toDF("a", "b"))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    links = links.distinct()
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
