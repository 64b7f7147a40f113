"""Frequent phrases of two to four words per language, and those whose words hold together.

Each position of a text starts a suffix, of which at most four words matter and which ends with
its piece. A suffix is a pointer into the word numbers of its block. Suffixes are routed by
their leading word to one of many parts; inside a part a multikey three-way quicksort orders
the pointers word by word. The middle part of each split, the suffixes that equal the pivot,
is as large as its phrase is frequent, and goes on to the next word; parts that have become
smaller than the least count are given up at once. The sort treats all open ranges of one
round together, as array operations.

A leading word, pair or triple with a large share of all positions would fill a part. Suffixes
below such a prefix are routed by one word more, and the prefix itself is counted from one sum
per block. Equal suffixes of a block leave it as one pointer with a count. So no part holds
more than the suffixes of rare prefixes and one row per block of each frequent one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import free_name, written

LONGEST = 4
LEAST = 30
TOP = 2000
#: A prefix with more than this share of all positions is always routed by one word more, so that
#: there are at most 4096 of each length; with fewer parts a larger share is enough.
HOT_SHARE = 1 / 4096
#: Shares of the mean part that one prefix may have.
PART_SHARES = 4
#: Positions in a block, text taken at a time, and suffixes a part is meant to hold.
BLOCK_WORDS = 1 << 20
CHUNK_BYTES = 2 << 20
PART_WORDS = 1 << 20
TAB = b"\t"
#: Ends a piece; it cannot be a word, since every separator does.
BREAK = b"."
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + SEPARATORS,
    b"abcdefghijklmnopqrstuvwxyz" + BREAK * len(SEPARATORS),
)

#: By language and number of words, hashes of prefixes and the prefixes.
Hot = dict[str, dict[int, tuple[np.ndarray, set[tuple[bytes, ...]]]]]

BLOCK = "lang string, n long, bytes long, vocabulary binary, codes binary, hot binary"
ROUTED = "part int, lang string, vocabulary binary, codes binary, weights binary, depths binary"
COUNTED = "lang string, words array<string>, f long"


def _packed(values: np.ndarray) -> bytes:
    return zstandard.compress(values.tobytes(), 1)


def _unpacked(blob: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob), kind)


def _joined(words: Sequence[bytes]) -> bytes:
    # A word never holds a blank.
    return zstandard.compress(b" ".join(words), 1)


def _split(blob: bytes) -> list[bytes]:
    return zstandard.decompress(blob).split(b" ") if blob else []


def tokens(text: bytes) -> list[bytes]:
    """Words of a text with A-Z in lower case, and BREAK at every separator."""
    return text.translate(FOLD).replace(BREAK, b" . ").split()


def _chunks(text: bytes) -> Iterator[bytes]:
    """A long text in pieces that are cut at blanks, so that words stay whole."""
    at = 0
    while len(text) - at > CHUNK_BYTES:
        ends = [text.rfind(blank, at, at + CHUNK_BYTES) for blank in (b" ", b"\n", b"\t")]
        end = max(ends)
        if end <= at:
            # A word longer than a chunk.
            later = [p for p in (text.find(b, at + CHUNK_BYTES) for b in (b" ", b"\n", b"\t")) if p > 0]
            if not later:
                break
            end = min(later)
        yield text[at:end + 1]
        at = end + 1
    yield text[at:]


class _Block:
    """Word numbers of texts of one language; number 0 ends a piece."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {BREAK: 0}
        self.codes: list[np.ndarray] = []
        self.waiting: list[bytes] = []
        self.held = 0
        self.size = 0

    def add(self, text: bytes) -> None:
        for chunk in _chunks(text):
            self.waiting.append(chunk)
            self.held += len(chunk)
            if self.held >= CHUNK_BYTES:
                self._number()
        self.waiting.append(b" . ")

    def _number(self) -> None:
        found = tokens(b"".join(self.waiting))
        self.waiting, self.held = [], 0
        if not found:
            return
        at, distinct = pd.factorize(np.array(found, dtype=object))
        numbers = self.numbers
        known = np.array([numbers.setdefault(w, len(numbers)) for w in distinct], np.int32)
        self.codes.append(known[at])
        self.size += len(at)

    def row(self, lang: str) -> dict | None:
        self._number()
        if not self.codes:
            return None
        codes = np.concatenate([*self.codes, np.zeros(LONGEST, np.int32)])
        words = list(self.numbers)
        length = int((codes != 0).sum())
        return {
            "lang": lang, "n": length, "bytes": len(codes), "vocabulary": _joined(words),
            "codes": _packed(codes), "hot": _joined(_frequent(codes, words, length)),
        }


def _frequent(codes: np.ndarray, words: Sequence[bytes], total: int) -> list[bytes]:
    """Prefixes of up to three words with a large share of the block, as words and a count."""
    found = []
    for columns, weights in _prefixes(_suffixes(codes), LONGEST - 1):
        for row in np.flatnonzero(weights > total * HOT_SHARE):
            prefix = [words[c] for c in columns[row]]
            found.append(TAB.join([*prefix, str(weights[row]).encode()]))
    return found


def _suffixes(codes: np.ndarray) -> np.ndarray:
    """The first words of the suffix at each word, zeros from the end of its piece on."""
    starts = np.flatnonzero(codes)
    rows = np.zeros((len(starts), LONGEST), np.int32)
    inside = np.ones(len(starts), bool)
    for k in range(LONGEST):
        values = codes[np.minimum(starts + k, len(codes) - 1)]
        inside &= values != 0
        rows[:, k] = np.where(inside, values, 0)
    return rows


def _merged(rows: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows with the sums of their weights."""
    if not len(rows):
        return rows, np.zeros(0, np.int64)
    key = rows[:, 0].astype(np.int64)
    for k in range(1, rows.shape[1]):
        width = int(rows[:, k].max()) + 1
        if (int(key.max()) + 1) * width >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        key = key * width + rows[:, k]
    _, first, at = np.unique(key, return_index=True, return_inverse=True)
    if weights is None:
        return rows[first], np.bincount(at, minlength=len(first)).astype(np.int64)
    sums = np.zeros(len(first), np.int64)
    np.add.at(sums, at, weights)
    return rows[first], sums


def _prefixes(rows: np.ndarray, upto: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct prefixes of 1, 2, .. whole words of the rows, with their counts."""
    levels = []
    held, weights = _merged(rows[:, :upto])
    for k in range(upto, 0, -1):
        held, weights = _merged(held[:, :k], weights)
        whole = held[:, k - 1] != 0
        levels.append((held[whole], weights[whole]))
    yield from reversed(levels)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_: dict[str, _Block] = {}

    def close(lang: str) -> Iterator[pa.RecordBatch]:
        row = open_.pop(lang).row(lang)
        if row:
            yield pa.RecordBatch.from_pylist([row], BLOCK_SCHEMA)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            lang = "und" if lang is None else lang
            block = open_.setdefault(lang, _Block())
            block.add((text or "").encode("utf-8", "surrogatepass"))
            if block.size >= BLOCK_WORDS:
                yield from close(lang)
            elif sum(b.size + b.held for b in open_.values()) >= 2 * BLOCK_WORDS + 4 * CHUNK_BYTES:
                # Many languages at once: the largest goes first.
                yield from close(max(open_, key=lambda k: open_[k].size + open_[k].held))
    for lang in list(open_):
        yield from close(lang)


BLOCK_SCHEMA = pa.schema([
    ("lang", pa.string()), ("n", pa.int64()), ("bytes", pa.int64()),
    ("vocabulary", pa.binary()), ("codes", pa.binary()), ("hot", pa.binary()),
])


def _hash_words(words: Sequence[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


def _mixed(code: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        code = (code ^ word) * np.uint64(0x9E3779B97F4A7C15)
        return code ^ (code >> np.uint64(29))


def _prefix_codes(lang: str, rows: np.ndarray, hashes: np.ndarray) -> Iterator[np.ndarray]:
    """A hash of the first 1, 2, .. words of each row."""
    mark = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))
    code = np.full(len(rows), mark, np.uint64)
    for k in range(rows.shape[1]):
        code = _mixed(code, hashes[rows[:, k]])
        yield code


def _hot_runs(
    rows: np.ndarray, code: np.ndarray, k: int, words: Sequence[bytes], hot: Hot, lang: str
) -> Iterator[tuple[np.ndarray, tuple[bytes, ...]]]:
    """Rows of each hot prefix of k words. The rows are in order; hashes only find the few rows
    whose words are then compared."""
    known, prefixes = hot[lang][k]
    found = np.flatnonzero(np.isin(code, known))
    if len(found):
        cuts = np.flatnonzero((np.diff(rows[found, :k], axis=0) != 0).any(axis=1)) + 1
        for run in np.split(found, cuts):
            prefix = tuple(words[c] for c in rows[run[0], :k])
            if prefix in prefixes:
                yield run, prefix


def _route(
    lang: str, rows: np.ndarray, words: Sequence[bytes], hot: Hot, parts: int
) -> tuple[np.ndarray, np.ndarray]:
    """Part of each suffix and the number of leading words it was found by. The rows are in order."""
    depth = np.ones(len(rows), np.int8)
    place = np.zeros(len(rows), np.uint64)
    for k, code in enumerate(_prefix_codes(lang, rows, _hash_words(words)), 1):
        place = np.where(depth >= k, code, place)
        if k < LONGEST and lang in hot:
            for run, _ in _hot_runs(rows, code, k, words, hot, lang):
                # A prefix is below a hot one only if all its shorter ones are hot.
                depth[run[depth[run] == k]] = k + 1
    return (place % np.uint64(parts)).astype(np.int32), depth


def hot_index(prefixes: dict[str, set[tuple[bytes, ...]]]) -> Hot:
    """Per language and number of words: hashes of the hot prefixes, and the prefixes."""
    index: Hot = {}
    for lang, found in prefixes.items():
        index[lang] = {}
        for k in range(1, LONGEST):
            some = sorted(p for p in found if len(p) == k)
            vocabulary = [w for p in some for w in p]
            rows = np.arange(len(vocabulary)).reshape(-1, k)
            codes = list(_prefix_codes(lang, rows, _hash_words(vocabulary)))[-1]
            index[lang][k] = (codes, set(some))
    return index


def _deal(hot: Hot, parts: int):
    """Suffixes of each block, equal ones once, as one row per part."""

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block in frame.itertuples(index=False):
                words = _split(block.vocabulary)
                rows, weights = _merged(_suffixes(_unpacked(block.codes, np.int32)))
                if not len(rows):
                    continue
                part, depth = _route(block.lang, rows, words, hot, parts)
                order = np.argsort(part, kind="stable")
                rows, weights, depth, part = rows[order], weights[order], depth[order], part[order]
                cuts = np.flatnonzero(np.diff(part, prepend=-1, append=parts))
                out = []
                for lo, hi in zip(cuts[:-1], cuts[1:]):
                    used, own = np.unique(rows[lo:hi], return_inverse=True)
                    # Number 0, the end of a piece, keeps its place.
                    shift = 0 if used[0] == 0 else 1
                    own = (own.reshape(-1, LONGEST) + shift).astype(np.int32)
                    out.append((
                        int(part[lo]), block.lang, _joined([words[c] for c in used if c]),
                        # Word by word, which compresses better than suffix by suffix.
                        _packed(np.ascontiguousarray(own.T)),
                        _packed(weights[lo:hi]), _packed(depth[lo:hi]),
                    ))
                    if len(out) == 64:
                        yield pd.DataFrame(out, columns=ROUTED_NAMES)
                        out = []
                yield pd.DataFrame(out, columns=ROUTED_NAMES)

    return deal


ROUTED_NAMES = [f.split()[0] for f in ROUTED.split(", ")]


def sorted_phrases(
    rows: np.ndarray, weights: np.ndarray, depths: np.ndarray, least: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Prefixes of the rows with at least this weight, as (prefixes, weights) per length.

    A multikey three-way quicksort of pointers to the rows, all open ranges at once: each range
    has a word position and takes the word of its middle pointer as the pivot. Pointers to
    smaller and larger words form ranges of the same position; those to equal words form a
    range of the next one, whose weight is the count of its prefix. Ranges below ``least`` are
    given up. A prefix shorter than the depth that its rows were routed by is not complete
    here and is left out.
    """
    pointers = np.arange(len(rows))
    bounds = np.array([0, len(rows)] if len(rows) else [0], np.int64)
    level = np.zeros(len(bounds) - 1, np.int8)
    if len(rows) and weights.sum() < least:
        return
    while len(level):
        sizes = np.diff(bounds)
        owner = np.repeat(np.arange(len(level)), sizes)
        values = rows[pointers, level[owner]]
        pivots = values[bounds[:-1] + sizes // 2]
        side = np.sign(values - pivots[owner]).astype(np.int8) + 1
        # Move the pointers of each range to its smaller, equal and larger part, in order.
        slot = owner * 3 + side
        counts = np.bincount(slot, minlength=3 * len(level))
        starts = np.cumsum(counts) - counts
        moved = np.empty_like(pointers)
        for which in range(3):
            chosen = np.flatnonzero(side == which)
            mine = counts[which::3]
            inner = np.arange(len(chosen)) - np.repeat(np.cumsum(mine) - mine, mine)
            moved[np.repeat(starts[which::3], mine) + inner] = pointers[chosen]
        total = np.concatenate([[0], np.cumsum(weights[moved])])
        ends = starts + counts
        mass = total[ends] - total[starts]
        part_level = np.repeat(level, 3)
        equal = np.tile([False, True, False], len(level))
        stopped = equal & (np.repeat(pivots, 3) == 0)
        keep = (mass >= least) & (counts > 0) & ~stopped
        part_level = part_level + equal
        for length in range(1, LONGEST + 1):
            done = np.flatnonzero(keep & equal & (part_level == length))
            if len(done):
                first = moved[starts[done]]
                whole = depths[first] <= length
                yield rows[first[whole], :length], mass[done[whole]]
        keep &= part_level < LONGEST
        sizes = counts[keep]
        at = np.repeat(starts[keep], sizes) + (
            np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        )
        pointers, level = moved[at], part_level[keep]
        bounds = np.concatenate([[0], np.cumsum(sizes)])


def _count(least: int):
    """Phrases of one part, a language at a time; rows come in order of part and language."""

    def finished(lang: str, blobs: list) -> pd.DataFrame:
        vocabularies = [_split(v) for v, *_ in blobs]
        every = np.array([w for words in vocabularies for w in words], dtype=object)
        at, words = pd.factorize(every)
        rows, offset = [], 0
        for own, (_, codes, _, _) in zip(vocabularies, blobs):
            known = np.concatenate([[0], at[offset:offset + len(own)] + 1]).astype(np.int32)
            rows.append(known[_unpacked(codes, np.int32).reshape(LONGEST, -1).T])
            offset += len(own)
        rows = np.concatenate(rows)
        weights = np.concatenate([_unpacked(w, np.int64) for _, _, w, _ in blobs])
        depths = np.concatenate([_unpacked(d, np.int8) for _, _, _, d in blobs])
        found = [
            (lang, [words[c - 1].decode("utf-8", "surrogatepass") for c in prefix], int(f))
            for prefixes, counts in sorted_phrases(rows, weights, depths, least)
            for prefix, f in zip(prefixes, counts)
        ]
        return pd.DataFrame(found, columns=["lang", "words", "f"])

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, blobs = None, []
        for frame in frames:
            for row in frame.itertuples(index=False):
                if blobs and (row.part, row.lang) != current:
                    yield finished(current[1], blobs)
                    blobs = []
                current = (row.part, row.lang)
                blobs.append((row.vocabulary, row.codes, row.weights, row.depths))
        if blobs:
            yield finished(current[1], blobs)

    return count


def _hot_prefixes(blocks: DataFrame, least: int) -> dict[str, set[tuple[bytes, ...]]]:
    """Prefixes with more than ``least`` occurrences in the blocks where they are frequent."""

    def listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for lang, blob in zip(frame.lang, frame.hot):
                for item in _split(blob):
                    if item:
                        prefix, _, weight = item.rpartition(TAB)
                        found.append((lang, prefix, int(weight)))
            yield pd.DataFrame(found, columns=["lang", "prefix", "weight"])

    rows = (
        blocks.select("lang", "hot").mapInPandas(listed, "lang string, prefix binary, weight long")
        .groupBy("lang", "prefix").agg(F.sum("weight").alias("weight"))
        .where(F.col("weight") > least)
        .collect()
    )
    hot: dict[str, set[tuple[bytes, ...]]] = {}
    for row in rows:
        hot.setdefault(row.lang, set()).add(tuple(bytes(row.prefix).split(TAB)))
    return hot


def _count_hot(hot: Hot):
    """Counts of the hot prefixes in each block."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for block in frame.itertuples(index=False):
                words = _split(block.vocabulary)
                if block.lang not in hot:
                    continue
                rows, weights = _merged(_suffixes(_unpacked(block.codes, np.int32)))
                codes = _prefix_codes(block.lang, rows, _hash_words(words))
                for k, code in zip(range(1, LONGEST), codes):
                    for run, prefix in _hot_runs(rows, code, k, words, hot, block.lang):
                        spelled = [w.decode("utf-8", "surrogatepass") for w in prefix]
                        found.append((block.lang, spelled, int(weights[run].sum())))
            yield pd.DataFrame(found, columns=["lang", "words", "f"])

    return count


def counted(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Occurrences of all frequent word sequences up to four words, and words per language.

    ``docs`` has ``lang`` (null: und) and ``text`` (null: empty). Returns (lang, words, f) with
    f >= ``least``, and (lang, n).
    """
    spark = docs.sparkSession
    blocks = written(
        docs.select(F.col("lang").cast("string"), F.col("text").cast("string"))
        .mapInArrow(_blocks, BLOCK),
        "phrase-blocks",
    )
    totals = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    total = blocks.agg(F.sum("n").alias("n")).first().n or 0
    parts = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        spark.sparkContext.defaultParallelism, -(-total // PART_WORDS),
    )
    share = max(HOT_SHARE, 1 / (PART_SHARES * parts))
    hot = hot_index(_hot_prefixes(blocks, int(total * share)))  # at most 3 / HOT_SHARE prefixes
    single = blocks.select("lang", "vocabulary", "codes")
    routed = single.mapInPandas(_deal(hot, parts), ROUTED).repartition(parts, "part")
    found = routed.sortWithinPartitions("part", "lang").mapInPandas(_count(least), COUNTED)
    if hot:
        common = (
            single.mapInPandas(_count_hot(hot), COUNTED)
            .groupBy("lang", "words").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
        )
        found = found.unionByName(common)
    return written(found, "phrase-counts"), totals


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The phrases of two to four words that hold together best, per language.

    A phrase with a >= ``least`` occurrences is cut after its first k words; l and r are the
    occurrences of the two sides and the score of the cut is floor(2000000 * a / (l + r)). The
    lowest score counts, of equal ones that of the smallest k. A phrase inside a longer one
    with at least 80 percent of its occurrences is left out. Returns the first ``top`` of each
    language by score, occurrences (both falling) and phrase (byte order) as lang, rank,
    phrase, a, l, r, n, score.

    Null texts are empty, null languages are ``und``. Repeated rows count again. An empty
    table, or one without words, gives no rows. Texts of any length are read whole; other
    columns are not read.
    """
    counts, totals = counted(docs, least)
    whole = counts.where(F.size("words") > 1).select("lang", "words", F.col("f").alias("a"))
    cuts = whole.select(
        "lang", "words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    ).select(
        "*", F.expr("slice(words, 1, k)").alias("head"),
        F.expr("slice(words, k + 1, size(words) - k)").alias("tail"),
    )
    left = counts.select("lang", F.col("words").alias("head"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("words").alias("tail"), F.col("f").alias("r"))
    # Decimals: the product of a count may pass 64 bits.
    score = F.expr("cast(2000000 * cast(a as decimal(20, 0)) div cast(l + r as decimal(20, 0)) as long)")
    best = (
        cuts.join(left, ["lang", "head"]).join(right, ["lang", "tail"])
        .groupBy("lang", "words")
        .agg(F.first("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    )
    inner = (
        whole.where(F.size("words") > 2)
        .select(
            "lang", F.col("a").alias("longer"),
            F.explode(F.expr("""flatten(transform(sequence(2, size(words) - 1), m ->
                transform(sequence(1, size(words) - m + 1), i -> slice(words, i, m))))""")).alias("words"),
        )
        .groupBy("lang", "words").agg(F.max("longer").alias("longer"))
    )
    hidden = F.expr("100 * cast(longer as decimal(20, 0)) >= 80 * cast(a as decimal(20, 0))")
    kept = (
        best.join(inner, ["lang", "words"], "left")
        .where(F.col("longer").isNull() | ~hidden)
        .select(
            "lang", F.concat_ws(" ", "words").alias("phrase"), "a", "cut.l", "cut.r", "cut.score"
        )
    )
    # First within shares of a language, so that no task sorts a whole language.
    order = "order by score desc, a desc, phrase"
    share = free_name(kept, "share")
    first = (
        kept.withColumn(share, F.pmod(F.xxhash64("phrase"), F.lit(64)))
        .withColumn("rank", F.expr(f"row_number() over (partition by lang, {share} {order})"))
        .where(F.col("rank") <= top)
        .withColumn("rank", F.expr(f"cast(row_number() over (partition by lang {order}) as long)"))
        .where(F.col("rank") <= top)
    )
    return first.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
