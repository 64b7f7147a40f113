"""SimHash near-duplicates found through anchor points of a covering code.

A fingerprint has 64 bits; two are linked at ``distance`` or fewer differing bits. The bits
are cut into parts with a budget each so that any linked pair is within the budget in at
least one part (the budgets plus one sum to more than the distance). In each part the
codewords of a covering code are the anchors. A fingerprint is at home at the anchor that
decodes its part, at most the covering radius away, and it visits every anchor within the
covering radius plus the part's budget: whatever lies within the budget is at home at one of
those. Comparison takes place per anchor, homes against visitors, on distinct fingerprints.

An anchor with many fingerprints is cut into blocks of homes by blocks of visitors, so that
a task holds two blocks at a time whatever the size of the group. Each task returns a
spanning forest of the links it finds, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import (
    components, forest, free_name, ragged_ranges, texts_in, words_of, written,
)

SHINGLE = 4
DISTANCE = 4
SEED = 42
BITS = 64
#: Homes or visitors of an anchor that one comparison holds.
BLOCK = 2048
#: Pairs that one numpy step compares.
STEP = 1 << 21

#: Parts as (first bit, bits, code, budget). The first two are 23 bits wide, the length of
#: the binary Golay code, which is perfect with covering radius 3. The rest is its own code
#: of radius 0. Budgets 1 + 1 + 0 leave out at most (1 + 1) + (1 + 1) + 0 = 4 = DISTANCE bits.
PARTS = ((0, 23, "golay", 1), (23, 23, "golay", 1), (46, 18, "all", 0))
# The generator polynomial of the binary Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GOLAY = 0b101011100011


# --- fingerprints ---------------------------------------------------------------------------


def fingerprint(words: list[bytes], shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority of the XXH64 bits of all word shingles, repeats included.

    Fewer words than a shingle: their sequence is the only shingle. No word: 0.
    """
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, seed)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    view, digest = memoryview(line), xxhash.xxh64_intdigest
    pairs = zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    hashes = np.fromiter((digest(view[i:j], seed) for i, j in pairs), "<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        rows = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(0, dtype=np.int64)
    majority = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int.from_bytes(majority.tobytes(), "little")


def with_fingerprints(
    docs: DataFrame, text: str = "text", name: str = "fp", shingle: int = SHINGLE
) -> DataFrame:
    """``docs`` without the text, with the fingerprint as a signed long in ``name``."""
    others = [c for c in docs.columns if c != text]
    schema = docs.select(*others, F.lit(0).cast("long").alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            prints = np.array(
                [fingerprint(words_of(x), shingle) for x in texts_in(batch, text)], "<u8"
            )
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            names = [n for n in batch.schema.names if n != text]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(prints.view("<i8"))], names=[*names, name]
            )

    return docs.mapInArrow(run, schema)


# --- anchors --------------------------------------------------------------------------------


@lru_cache
def golay_leaders() -> np.ndarray:
    """The error pattern of each of the 2^11 syndromes: all words of weight 3 or less."""
    words = np.arange(1 << 23, dtype=np.uint32)
    light = words[np.bitwise_count(words) <= 3]
    leaders = np.empty(1 << 11, np.uint32)
    leaders[golay_syndrome(light)] = light
    return leaders


def golay_syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder by the generator polynomial."""
    rest = words.astype(np.uint32)
    for bit in range(22, 10, -1):
        rest = np.where(rest >> np.uint32(bit) & np.uint32(1), rest ^ np.uint32(GOLAY << (bit - 11)), rest)
    return rest


@lru_cache
def flips(bits: int, budget: int) -> np.ndarray:
    """All words of ``bits`` bits with at most ``budget`` ones."""
    found = {0}
    for _ in range(budget):
        found |= {word ^ (1 << bit) for word in found for bit in range(bits)}
    return np.array(sorted(found), np.uint32)


def anchors(prints: np.ndarray, part: tuple[int, int, str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, is home): the home of each fingerprint and all anchors it visits.

    The anchors within radius + budget that can be the home of a word within the budget are
    the homes of the words that differ in up to ``budget`` bits.
    """
    first, bits, code, budget = part
    words = (prints >> np.uint64(first) & np.uint64((1 << bits) - 1)).astype(np.uint32)
    near = words[:, None] ^ flips(bits, budget)[None, :]
    if code == "golay":
        near = near ^ golay_leaders()[golay_syndrome(near.ravel())].reshape(near.shape)
        home = words ^ golay_leaders()[golay_syndrome(words)]
    else:
        home = words
    rows = np.repeat(np.arange(len(prints), dtype=np.int64), near.shape[1])
    visits = np.unique(rows << bits | near.ravel())
    rows, anchor = visits >> bits, visits & ((1 << bits) - 1)
    return rows, anchor, anchor == home[rows]


def _route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        prints = batch["fp"].to_numpy(np.int64).view(np.uint64)
        for number, part in enumerate(PARTS):
            rows, anchor, home = anchors(prints, part)
            yield pd.DataFrame(
                {
                    "anchor": anchor * len(PARTS) + number,
                    "fp": prints[rows].view(np.int64),
                    "home": home,
                }
            )


# --- comparison -----------------------------------------------------------------------------


def _linked(
    homes: np.ndarray, home_keys: np.ndarray, visits: np.ndarray, visit_keys: np.ndarray, distance: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links between homes and visitors of equal keys; both sides are sorted by key."""
    lo = np.searchsorted(home_keys, visit_keys, "left")
    n = np.searchsorted(home_keys, visit_keys, "right") - lo
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    ends = np.cumsum(n)
    at = 0
    while at < len(visits):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + STEP, "right")))
        a = np.repeat(visits[at:to], n[at:to])
        b = homes[ragged_ranges(lo[at:to], n[at:to])]
        close = (np.bitwise_count(a ^ b) <= distance) & (a < b)
        # Keep a forest: the number of links of a block stays below its fingerprints.
        x, y = a[close].view(np.int64), b[close].view(np.int64)
        left.append(x)
        right.append(y)
        if sum(map(len, left)) > STEP:
            x, y = forest(np.concatenate(left), np.concatenate(right))
            left, right = [x], [y]
        at = to
    return forest(np.concatenate(left), np.concatenate(right))


def _compare(distance: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows arrive sorted by key; the last key of a batch may go on in the next.
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            last = batch["key"].iloc[-1]
            done = (batch["key"] != last).to_numpy()
            if done.any():
                yield links([*held, batch[done]])
                held = []
            elif held and held[-1]["key"].iloc[-1] != last:
                yield links(held)
                held = []
            held.append(batch[~done])
        if held:
            yield links(held)

    def links(parts: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(parts, ignore_index=True)
        key = rows["key"].to_numpy(np.int64)
        fp = rows["fp"].to_numpy(np.int64).view(np.uint64)
        home = rows["home"].to_numpy(bool)
        a, b = _linked(fp[home], key[home], fp[~home], key[~home], distance)
        return pd.DataFrame({"a": a, "b": b})

    return run


def fingerprint_links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within ``distance`` bits.

    ``prints`` has distinct non-null longs in ``fp``; the ids of the links are fingerprints.
    """
    if sum(budget + 1 for *_, budget in PARTS) <= distance:
        raise ValueError("the parts do not cover this distance")
    routed = written(prints.mapInPandas(_route, "anchor long, fp long, home boolean"), "anchors")
    # Anchors whose homes and visitors do not fit one block each; the counts are combined in
    # each task, and Spark decides from their size how to join them back.
    sizes = (
        routed.groupBy("anchor")
        .agg(F.count(F.when(F.col("home"), 1)).alias("h"), F.count(F.lit(1)).alias("v"))
        .where("h > 0 and v > 1")
        .select(
            "anchor",
            F.ceil(F.col("h") / BLOCK).cast("int").alias("home_blocks"),
            F.ceil(F.col("v") / BLOCK).cast("int").alias("visit_blocks"),
        )
    )
    placed = routed.join(sizes, "anchor")
    spread = F.expr("pmod(xxhash64(fp), 1048573)")
    homes = placed.where("home").select(
        "anchor", "fp", F.lit(True).alias("home"),
        (spread % F.col("home_blocks")).alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("visit_blocks") - 1)).alias("j"),
    )
    visits = placed.select(
        "anchor", "fp", F.lit(False).alias("home"),
        F.explode(F.sequence(F.lit(0), F.col("home_blocks") - 1)).alias("i"),
        (spread % F.col("visit_blocks")).alias("j"),
    )
    keyed = homes.union(visits).select(
        F.xxhash64("anchor", "i", "j").alias("key"), "fp", "home"
    )
    # Keys of different blocks that share a hash would only add comparisons.
    return (
        keyed.repartition("key").sortWithinPartitions("key")
        .mapInPandas(_compare(distance), "a long, b long")
    )


def _classes(
    docs: DataFrame, key: str, text: str, distance: int
) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all rows (k, code, fp), and the component of each fingerprint.

    ``code`` is a hash of the whole row, which tells apart rows that share a key.
    """
    hashable = [f"`{f.name}`" for f in docs.schema if "map<" not in f.dataType.simpleString()]
    slim = docs.select(
        F.col(key).alias("k"), F.xxhash64(*hashable).alias("code"),
        F.col(text).cast("string").alias("text"),
    )
    prints = written(with_fingerprints(slim), "fingerprints")
    distinct = written(prints.select("fp").distinct(), "classes")
    linked = components(fingerprint_links(distinct, distance))
    named = distinct.join(linked, distinct["fp"] == linked["node"], "left").select(
        "fp", F.coalesce("component", "fp").alias("component")
    )
    return prints, named


def _least(prints: DataFrame, named: DataFrame) -> DataFrame:
    """The row that stands for each component: its smallest key, nulls last, then code."""
    order = F.struct(F.col("k").isNull().alias("n"), "k", "code")
    # Twice, so that a component's rows meet only as one row per fingerprint.
    each = prints.groupBy("fp").agg(F.min(order).alias("least"))
    return each.join(named, "fp").groupBy("component").agg(F.min("least").alias("least"))


def groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE
) -> DataFrame:
    """One row per row of ``docs``: key, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest key reachable over links. Null and empty texts have
    fingerprint zero and are linked like any other. Rows with equal fingerprints form one
    class whatever their number; repeated keys keep their rows. A row with a null key takes
    part in the linking but names a component only if all keys of it are null. An empty table
    gives an empty result.
    """
    prints, named = _classes(docs, key, text, distance)
    ids = named.join(_least(prints, named), "component").select(
        "fp", F.col("least.k").alias("component_id")
    )
    return prints.join(ids, "fp").select(
        F.col("k").alias(key),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def deduplicated(
    docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE
) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest key.

    Of equal rows with that key one stays; rows that differ in map columns only count as equal.
    Nulls are treated as in ``groups``.
    """
    k, code = free_name(docs, "kept_key"), free_name(docs, "kept_code")
    hashable = [f"`{f.name}`" for f in docs.schema if "map<" not in f.dataType.simpleString()]
    prints, named = _classes(docs, key, text, distance)
    kept = _least(prints, named).select(
        F.coalesce(F.col("least.k").cast("string"), F.lit("")).alias(k),
        F.col("least.code").alias(code),
    )
    rows = docs.select(
        "*", F.coalesce(F.col(key).cast("string"), F.lit("")).alias(k),
        F.xxhash64(*hashable).alias(code),
    )
    return rows.join(kept, [k, code], "left_semi").dropDuplicates([k, code]).select(*docs.columns)
