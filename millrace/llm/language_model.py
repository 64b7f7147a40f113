"""A word bigram model of the corpus in Elias-Fano tries, and the score of every text under it.

The texts are read once and kept as blocks of word numbers. Word counts and bigram counts go
to buckets as sorted arrays, one row per block and bucket; a bucket sees each word or bigram of
a block once, however often it occurs, and bigrams are dealt by their context, a frequent
context by parts of its second words. A bucket of bigrams merges the counts of the training texts,
builds a trie (context, word) with quantised smoothed probabilities, maps its file into memory,
and looks up the bigrams of all texts, seen in training or not. Sums per text go back to the
block; bigrams that many texts of a block share go back as one number per block instead.

Probabilities: p(w) = (c(w) + 1/2) / (N + (V + 1) / 2) over training tokens, and
p(w | v) = (c(v w) + M p(w)) / (c(v) + M), Dirichlet smoothing with M = STRENGTH. The trie
holds log10 p(w | v) of the bigrams seen; for others the first term is zero and the rest is
known without the trie. The first word's context is the start of a text, and a text ends with
an end token.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import crc_remainder, ragged_ranges, words_of, written
from millrace.llm.elias_fano import Trie

STRENGTH = 200.0
#: Text in a block and tokens per bucket; both bound what a task holds.
BLOCK_BYTES = 8 << 20
BUCKET_TOKENS = 3 << 18
#: A context with more training tokens is divided by its second words.
CONTEXT_TOKENS = 1 << 16
#: A bigram in more texts of a block than this goes back as one number for the block.
LISTED = 16
#: Word numbers and codes of the end of a text. Codes of words are their XXH64.
END_CODE = 0
LEVELS = (1 << 16) - 1


# --- arrays in bytes ------------------------------------------------------------------------


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed blob: whole numbers in the smallest type that holds them and
    byte by byte of all of them, so that the upper bytes compress well."""
    parts = [np.array([len(arrays)], np.int64).tobytes()]
    for array in arrays:
        if array.dtype.kind in "iu":
            top = int(array.max()) if len(array) else 0
            array = array.astype(next(t for t in ("<u1", "<u2", "<u4", "<u8") if top <= np.iinfo(t).max))
        parts += [array.dtype.str.encode().ljust(4), np.int64(len(array)).tobytes(), _turned(array)]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unsqueeze(blob: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    out, at = [], 8
    for _ in range(int(np.frombuffer(data, np.int64, 1)[0])):
        kind = np.dtype(data[at : at + 4].decode().strip())
        n = int(np.frombuffer(data[at + 4 : at + 12], np.int64)[0])
        size = kind.itemsize
        planes = np.frombuffer(data, np.uint8, n * size, at + 12).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += 12 + n * size
    return out


def _turned(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).view(np.uint8).reshape(len(array), -1).T.tobytes() if len(array) else b""


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that occurs with the places of its members, in their order."""
    order = np.argsort(bucket, kind="stable")
    bounds = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0, True])
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        if hi > lo:
            yield int(bucket[order[lo]]), order[lo:hi]


def word_bucket(upper: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of words by the upper half of their codes."""
    return (upper.astype(np.uint64) % np.uint64(buckets)).astype(np.int64)


def pair_bucket(
    one: np.ndarray, two: np.ndarray, count_one: np.ndarray, context_tokens: int, buckets: int
) -> np.ndarray:
    """Bucket of bigrams: by context, and a frequent context by parts of its second words. The
    count of the context is that of the corpus, so all blocks agree."""
    parts = (1 + count_one // context_tokens).astype(np.uint64)
    part = mixed_hash(two, np.zeros_like(two)) % parts
    return (mixed_hash(one, part) % np.uint64(buckets)).astype(np.int64)


def mixed_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ b.astype(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


# --- blocks of texts ------------------------------------------------------------------------


def _blocks(block_bytes: int):
    """One row per block: word numbers of its texts, and the codes of the words.

    Columns come as key, learn, text. Number 0 is the end of a text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 32, 0
        numbers: dict[bytes, int] = {b"": 0}
        keys, learn, tokens, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal numbers, keys, learn, tokens, held, made
            codes = np.array([END_CODE, *(xxhash.xxh64_intdigest(w) for w in list(numbers)[1:])], np.uint64)
            sizes = np.array(list(map(len, tokens)), np.int64)
            upper, lower = codes >> np.uint64(32), codes & np.uint64(0xFFFFFFFF)
            blob = squeeze(np.concatenate(tokens), sizes, np.array(learn, np.uint8), upper)
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([first + made], pa.int64()),
                    pa.array([int(sizes.sum())], pa.int64()),
                    pa.array([keys], pa.list_(pa.int64())),
                    pa.array([blob], pa.binary()),
                    # Only the counting of words needs the whole codes.
                    pa.array([squeeze(lower)], pa.binary()),
                ],
                names=["block", "n_tokens", "keys", "payload", "lower"],
            )
            numbers, keys, learn, tokens, held, made = {b"": 0}, [], [], [], 0, made + 1
            return row

        for batch in batches:
            for key, own, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                of = numbers
                tokens.append(np.array([*(of.setdefault(w, len(of)) for w in words), 0], np.uint32))
                keys.append(key)
                learn.append(bool(own))
                held += len((text or "").encode("utf-8", "surrogatepass"))
                if held >= block_bytes:
                    yield block()
        if keys:
            yield block()

    return run


def _word_rows(buckets: int):
    """The words of each block with their counts in training texts, by bucket."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, payload, lower in zip(batch["block"], batch["payload"], batch["lower"], strict=True):
                tokens, sizes, learn, upper = unsqueeze(payload)
                codes = upper.astype(np.uint64) << np.uint64(32) | unsqueeze(lower)[0]
                taken = tokens[np.repeat(learn.astype(bool), sizes)]
                counts = np.bincount(taken, minlength=len(codes))
                rows = [
                    (bucket, block, squeeze(codes[at], counts[at]))
                    for bucket, at in by_bucket(word_bucket(upper, buckets))
                ]
                yield pd.DataFrame(rows, columns=["bucket", "block", "payload"])

    return run


def _count_words(buckets: int):
    """Numbers and counts over the corpus for the words of one bucket, back to each block."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        bucket = int(rows["bucket"].iloc[0])
        parts = [unsqueeze(p) for p in rows["payload"]]
        sizes = [len(codes) for codes, _ in parts]
        known, at = np.unique(np.concatenate([codes.astype(np.uint64) for codes, _ in parts]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([c for _, c in parts]), len(known)).astype(np.int64)
        numbers = np.arange(len(known)) * buckets + bucket
        ends = np.cumsum(sizes)
        out = [
            (block, bucket, squeeze(numbers[own], counts[own]))
            for block, own in zip(rows["block"], np.split(at, ends[:-1]), strict=True)
        ]
        out = pd.DataFrame(out, columns=["block", "bucket", "payload"])
        first = np.arange(len(out)) == 0
        return out.assign(
            n=np.where(first, counts.sum(), 0), v=np.where(first, (counts > 0).sum(), 0)
        )

    return run


# --- bigrams --------------------------------------------------------------------------------


def _pair_rows(n: int, v: int, buckets: int, listed_texts: int, context_tokens: int):
    """The bigrams of one block by bucket, and the block's own figures in a bucket below 0."""

    def run(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        block = int(blocks["block"].iloc[0])
        tokens, sizes, learn, upper = unsqueeze(blocks["payload"].iloc[0])
        sizes = sizes.astype(np.int64)
        numbers, counts = np.empty(len(upper), np.int64), np.empty(len(upper), np.int64)
        got = dict(zip(answers["bucket"], answers["payload"], strict=True))
        for bucket, at in by_bucket(word_bucket(upper, buckets)):
            numbers[at], counts[at] = unsqueeze(got[bucket])
        base = np.log10((counts + 0.5) / (n + 0.5 * (v + 1)))
        ends = np.cumsum(sizes)
        text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        base_score = np.add.reduceat(base[tokens], ends - sizes)
        known = np.add.reduceat((counts > 0)[tokens].astype(np.int64), ends - sizes)
        # Contexts are the words before; number 0, the end, stands for the start as well.
        before = np.r_[0, tokens[:-1]].astype(np.uint64)
        before[ends - sizes] = 0
        pair = before << np.uint64(32) | tokens
        order = np.argsort(pair, kind="stable")
        pair, text = pair[order], text[order]
        del order, before
        new_pair = np.r_[True, np.diff(pair) != 0]
        new_text = new_pair | np.r_[True, np.diff(text) != 0]
        starts, text_starts = np.flatnonzero(new_pair), np.flatnonzero(new_text)
        taken = learn[text].astype(np.int64)
        learned = np.add.reduceat(taken, starts)
        del taken
        times = np.diff(np.r_[text_starts, len(pair)])
        texts = text[text_starts]
        first_text = np.searchsorted(text_starts, starts)
        n_texts = np.diff(np.r_[first_text, len(text_starts)])
        a, b = (pair[starts] >> np.uint64(32)).astype(np.int64), (pair[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        one, two = numbers[a], numbers[b]
        out = []
        shared: list[list[np.ndarray]] = []
        for bucket, at in by_bucket(pair_bucket(one, two, counts[a], context_tokens, buckets)):
            at = at[np.lexsort((two[at], one[at]))]
            listed = n_texts[at] <= listed_texts
            sizes_here = np.where(listed, n_texts[at], 0)
            own = ragged_ranges(first_text[at], sizes_here)
            # Contexts are in order: their steps, and the count of each once.
            step = np.diff(one[at], prepend=0)
            first = np.r_[True, step[1:] > 0]
            out.append(
                (
                    bucket, block,
                    squeeze(
                        step, two[at], learned[at], counts[a[at]][first], counts[b[at]], sizes_here,
                        texts[own], times[own], np.array([len(sizes)]),
                    ),
                )
            )
            many = at[~listed]
            if len(many):
                own = ragged_ranges(first_text[many], n_texts[many])
                shared.append([np.full(len(many), bucket), n_texts[many], texts[own], times[own]])
        shared_arrays = [np.concatenate(c) for c in zip(*shared, strict=True)] if shared else [np.zeros(0, np.int64)] * 4
        keys = blocks["keys"].iloc[0]
        missing = np.array([key is None or key != key for key in keys], np.uint8)
        ids = np.array([0 if gone else int(key) for key, gone in zip(keys, missing, strict=True)], np.int64)
        own = squeeze(ids.view(np.uint64), missing, learn, sizes, known, base_score, *shared_arrays)
        out.append((-1 - block, block, own))
        return pd.DataFrame(out, columns=["bucket", "block", "payload"])

    return run


def _score_pairs(n: int, v: int):
    """Build the trie of a bucket, look up every bigram, and sum per text.

    Returns per block its sums per text and the numbers of the bigrams it asked for.
    """
    columns = ["block", "bucket", "payload"]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        bucket = int(rows["bucket"].iloc[0])
        if bucket < 0:
            return rows[columns]
        parts = [unsqueeze(p) for p in rows["payload"]]
        for part in parts:
            step = part[0].astype(np.int64)
            part[0] = np.cumsum(step)
            part[3] = part[3][np.cumsum(np.r_[0, step[1:] > 0])]
        one, two, learned, count_one, count_two = (
            np.concatenate([p[k] for p in parts]).astype(np.int64) for k in range(5)
        )
        order = np.lexsort((two, one))
        fresh = np.r_[True, (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)]
        at = np.empty(len(order), np.int64)
        at[order] = np.cumsum(fresh) - 1
        pick = order[fresh]
        total = np.bincount(at, learned, len(pick)).astype(np.int64)
        base = (count_two[pick] + 0.5) / (n + 0.5 * (v + 1))
        log_p = np.log10((total + STRENGTH * base) / (count_one[pick] + STRENGTH))
        seen = total > 0
        trie, low, step = plant(one[pick][seen], two[pick][seen], log_p[seen])
        with tempfile.NamedTemporaryFile() as file:  # this task's own, gone when it is answered
            file.write(trie)
            file.flush()
            mapped = Trie.read(np.memmap(file.name, np.uint8, "r"))
            place = mapped.find([one[pick], two[pick]])
            hit = place >= 0
            # A bigram that is not in the trie has no count of its own.
            log_p[hit] = low + step * mapped.codes[place[hit]].astype(np.float64)
            del mapped
        out = []
        for block, part, own in zip(
            rows["block"], parts, np.split(at, np.cumsum([len(p[0]) for p in parts])[:-1]), strict=True
        ):
            sizes, texts, times, n_texts = part[5].astype(np.int64), part[6], part[7], int(part[8][0])
            sums = np.bincount(texts, np.repeat(log_p[own], sizes) * times, n_texts)
            out.append((block, bucket, squeeze(sums.astype(np.float32), log_p[own][sizes == 0])))
        return pd.DataFrame(out, columns=columns)

    return run


def plant(one: np.ndarray, two: np.ndarray, log_p: np.ndarray) -> tuple[bytes, float, float]:
    """A trie of sorted bigrams with 16-bit codes, and what a code stands for: low + step * code."""
    low = float(log_p.min()) if len(log_p) else 0.0
    step = (float(log_p.max()) - low) / LEVELS if len(log_p) else 0.0
    codes = np.rint((log_p - low) / step) if step else np.zeros(len(log_p))
    return Trie.build([one, two], codes.astype(np.uint16)), low, step


def _assemble(rows: pd.DataFrame) -> pd.DataFrame:
    """The scores of the texts of one block."""
    mine = rows["bucket"].to_numpy() < 0
    ids, missing, learn, sizes, known, base_score, bucket, n_texts, texts, times = unsqueeze(
        rows["payload"][mine].iloc[0]
    )
    keys = pd.array(ids.astype(np.uint64).view(np.int64), "Int64")
    keys[missing.astype(bool)] = pd.NA
    score = np.zeros(len(sizes))
    asked = {}
    for b, payload in zip(rows["bucket"][~mine], rows["payload"][~mine], strict=True):
        sums, asked[b] = unsqueeze(payload)
        score += sums
    if len(bucket):
        # The shared bigrams stand by bucket, in the order in which they were asked for.
        order = np.flatnonzero(np.r_[True, np.diff(bucket.astype(np.int64)) != 0])
        log_p = np.concatenate([asked[int(b)] for b in bucket[order]])
        score += np.bincount(texts, np.repeat(log_p, n_texts.astype(np.int64)) * times, len(sizes))
    return pd.DataFrame(
        {
            "key": keys, "learned": learn.astype(bool), "n_tokens": sizes.astype(np.int64),
            "n_known": known.astype(np.int64), "base_score": base_score, "score": score,
        }
    )


SCHEMA = "key long, learned boolean, n_tokens long, n_known long, base_score double, score double"


def scored(docs: DataFrame, key: str = "doc_id", text: str = "text", fold: int = 5) -> DataFrame:
    """One row per row of ``docs``: key, held_out, n_tokens, n_known, train_tokens, base_score,
    score.

    The model learns from the texts whose crc32 of the id (as text) modulo ``fold`` is not 1. A
    null or empty text is one end token. A null id counts as the empty text. Rows with the same
    id are texts of their own. Without training texts N and V are 0. Other columns are not read.
    Ids must be whole numbers or text of such. One huge text is one block, which one task holds.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    learn = crc_remainder(F.col(key), fold) != 1
    slim = docs.select(F.col(key).cast("long"), learn, F.col(text).cast("string"))
    blocks = written(
        slim.mapInArrow(
            _blocks(BLOCK_BYTES),
            "block long, n_tokens long, keys array<long>, payload binary, lower binary",
        ),
        "text-blocks",
    )
    tokens = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    buckets = max(1, -(-tokens // BUCKET_TOKENS))
    words = written(
        blocks.select("block", "payload", "lower")
        .mapInPandas(_word_rows(buckets), "bucket long, block long, payload binary")
        .groupBy("bucket")
        .applyInPandas(
            _count_words(buckets), "block long, bucket long, payload binary, n long, v long"
        ),
        "words",
    )
    n, v = (int(x or 0) for x in words.agg(F.sum("n"), F.sum("v")).first())
    pairs = (
        blocks.select("block", "keys", "payload")
        .groupBy("block")
        .cogroup(words.select("block", "bucket", "payload").groupBy("block"))
        .applyInPandas(
            _pair_rows(n, v, buckets, LISTED, CONTEXT_TOKENS),
            "bucket long, block long, payload binary",
        )
    )
    result = (
        pairs.groupBy("bucket")
        .applyInPandas(_score_pairs(n, v), "block long, bucket long, payload binary")
        .groupBy("block")
        .applyInPandas(_assemble, SCHEMA)
    )
    return result.select(
        F.col("key").alias(key), (~F.col("learned")).alias("held_out"), "n_tokens", "n_known",
        F.lit(n).cast("long").alias("train_tokens"), "base_score", "score",
    )
