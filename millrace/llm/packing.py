"""Harmonic packing of token sequences.

The length classes are reciprocals of the capacity: class k holds pieces of capacity // k
tokens, and a bin of class k is filled with exactly k pieces. A document is cut from its start
into the largest class length that fits, again and again, so that every piece has the exact
length of its class and a full bin leaves at most k - 1 tokens free; class lengths that leave
more than a thousandth of the capacity free are not used. Every task fills its own bins from
its own rows, in one pass and without a shuffle. The bins that are still open at its end are
put together in order; what then fills no sequence is cut at powers of two, which need no
padding.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import texts_in

CAPACITY = 1024
END = 0
#: Texts that are encoded at a time.
TEXTS = 256
#: Sequences of one task are numbered from its partition number times this.
SPAN = 1 << 40
PIECE_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
    " sequence_id long, offset long"
)
SPECIAL = "<|endoftext|>"
LONG_RUN = 10_000
BLANK_RUN = re.compile(r"\s{%d}" % LONG_RUN)


@lru_cache
def encoder(path: str):
    """A function from texts to token ids, equal to ``encode(add_special_tokens=False)``.

    The vocabulary file is the one of the ``tokenizers`` library; byte-level BPE itself is
    run by tiktoken with the ranks of that file, seven times as fast with the same ids. Texts
    that contain the special token or a very long run, which the backtracking pattern of
    tiktoken cannot take, go through ``tokenizers``, and so do all texts if the file asks for
    other steps than plain byte-level BPE.
    """
    import json

    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    model, steps = parts["model"], parts.get("pre_tokenizer") or {}
    slow = Tokenizer.from_file(path)
    if (
        steps.get("type") != "ByteLevel" or steps.get("add_prefix_space") or not steps.get("use_regex", True)
        or parts.get("normalizer") or model.get("type", "BPE") != "BPE"
    ):
        return lambda texts: [slow.encode(text, add_special_tokens=False).ids for text in texts]
    visible = byte_letters()
    special = {SPECIAL}
    ranks = {
        bytes(visible[c] for c in word): number
        for word, number in model["vocab"].items() if word not in special
    }
    # The pattern of byte-level BPE with English contractions.
    pattern = (
        r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    )
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> list[list[int]]:
        return [
            slow.encode(text, add_special_tokens=False).ids if SPECIAL in text or long_run(text)
            else fast.encode_ordinary(text)
            for text in texts
        ]

    return encode


def long_run(text: str) -> bool:
    """Whether white space or anything else goes on for LONG_RUN characters."""
    if len(text) < LONG_RUN:
        return False
    return BLANK_RUN.search(text) is not None or max(map(len, text.split()), default=0) >= LONG_RUN


@lru_cache
def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for the letters from 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(byte): byte for byte in own}
    others = (byte for byte in range(256) if byte not in own)
    return letters | {chr(256 + n): byte for n, byte in enumerate(others)}


@lru_cache
def class_lengths(capacity: int) -> np.ndarray:
    """Piece lengths from the capacity down to 1, each capacity // k for its class k."""
    counts = np.arange(1, capacity + 1)
    lengths = capacity // counts
    full = (capacity - lengths * counts) * 1000 <= capacity
    return np.unique(np.concatenate([lengths[full], [1]]))[::-1]


def cuts(tokens: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document, the largest class length first."""
    whole, rest = divmod(tokens, capacity)
    return [capacity] * whole + list(_rest_cuts(rest, capacity))


@lru_cache(maxsize=1 << 14)
def _rest_cuts(rest: int, capacity: int) -> tuple[int, ...]:
    pieces = []
    for length in class_lengths(capacity).tolist():
        n, rest = divmod(rest, length)
        pieces += [length] * n
    return tuple(pieces)


def powers(tokens: int) -> list[int]:
    """``tokens`` as a sum of falling powers of two."""
    return [1 << b for b in range(tokens.bit_length() - 1, -1, -1) if tokens >> b & 1]


class Bins:
    """The open bins of one task, one per class; holds fewer than k pieces for class k."""

    def __init__(self, capacity: int, first: int) -> None:
        self.capacity = capacity
        self.next = first
        self.open: dict[int, list[tuple]] = {}

    def add(self, piece: tuple) -> Iterator[tuple]:
        """A piece is (doc_id, start, ids, doc_tokens); yields the rows of a filled bin."""
        length = len(piece[2])
        held = self.open.setdefault(length, [])
        held.append(piece)
        if len(held) == self.capacity // length:
            yield from self.close(held)
            del self.open[length]

    def close(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids, total in pieces:
            yield doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next, offset
            offset += len(ids)
        self.next += 1

    def finish(self) -> Iterator[tuple]:
        """Pack what is left: pieces are cut wherever a sequence ends."""
        left = [piece for _, held in sorted(self.open.items(), reverse=True) for piece in held]
        self.open = {}
        total = sum(len(piece[2]) for piece in left)
        whole, rest = divmod(total, self.capacity)
        room = [self.capacity] * whole + powers(rest)
        filled: list[tuple] = []
        free = room.pop(0) if room else 0
        for doc, start, ids, tokens in left:
            while len(ids):
                part, ids = ids[:free], ids[free:]
                filled.append((doc, start, part, tokens))
                start += len(part)
                free -= len(part)
                if not free:
                    yield from self.close(filled)
                    filled, free = [], room.pop(0) if room else 0


def pack(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY,
) -> DataFrame:
    """Every token of every document in exactly one piece of one sequence.

    Returns per piece: doc_id, start (the document's ids before it), length, ids_crc32 (of its
    ids as little-endian unsigned 32-bit numbers), doc_tokens, sequence_id and offset. A
    document is its ids and the end id; a null or empty text is the end id alone. Rows with a
    null or repeated key are packed as documents of their own. Keys must be whole numbers or text
    of such. Other columns are not read.
    ``tokenizer`` is a vocabulary file that every executor has. An empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        bins = Bins(capacity, TaskContext.get().partitionId() * SPAN)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                some = batch.slice(at, TEXTS)
                keys = some.column(0).to_pylist()
                texts = [x or "" for x in texts_in(some, "text")]
                rows = []
                for doc, ids in zip(keys, encode(texts), strict=True):
                    ids = np.array([*ids, END], "<u4")
                    start = 0
                    for length in cuts(len(ids), capacity):
                        rows += bins.add((doc, start, ids[start : start + length], len(ids)))
                        start += length
                if rows:
                    yield batch_of(rows)
        if rows := list(bins.finish()):
            yield batch_of(rows)

    names = [part.split()[0] for part in PIECE_SCHEMA.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    slim = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(run, PIECE_SCHEMA)
