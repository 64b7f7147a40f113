"""Elias-Fano sequences and an n-gram trie on top of them, read in place from one buffer.

A sequence of n rising numbers below u is stored in about n * (2 + log2(u / n)) bits: the low
bits of each number as they are, the high bits as gaps in unary. Any element is read without
decoding the others, so that a memory-mapped file serves as it is. All reads take and return
arrays.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

WORDS_PER_BLOCK = 4
#: Queries that are answered together; their arrays fit a core's cache.
STEP = 1 << 14
U = np.uint64


class EliasFano:
    """A rising (not strictly) sequence of numbers from 0."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ranks: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.ranks = n, low_bits, low, high, ranks
        self._zeros: np.ndarray | None = None

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        bits = values.astype(U)
        low = np.zeros(-(-n * low_bits // 64) + 1, U)
        if low_bits and n:
            at = np.arange(n, dtype=np.int64) * low_bits
            rest = bits & U((1 << low_bits) - 1)
            shift = (at & 63).astype(U)
            np.bitwise_or.at(low, at >> 6, rest << shift)
            over = (at & 63) + low_bits > 64
            np.bitwise_or.at(low, (at[over] >> 6) + 1, rest[over] >> (U(64) - shift[over]))
        ones = (bits >> U(low_bits)).astype(np.int64) + np.arange(n)
        n_words = (int(ones[-1]) >> 6) + 1 if n else 0
        n_words = -(-n_words // WORDS_PER_BLOCK) * WORDS_PER_BLOCK
        high = np.zeros(n_words, U)
        np.bitwise_or.at(high, ones >> 6, U(1) << (ones & 63).astype(U))
        counts = np.bitwise_count(high).astype(np.int64).reshape(-1, WORDS_PER_BLOCK).sum(1)
        return cls(n, low_bits, low, high, np.cumsum(counts) - counts)

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.low_bits, len(self.low), len(self.high), len(self.ranks)], np.int64)
        return b"".join(x.tobytes() for x in (head, self.low, self.high, self.ranks.astype(np.int64)))

    @classmethod
    def read(cls, buffer: np.ndarray, at: int) -> tuple[EliasFano, int]:
        """The sequence at byte ``at`` of a buffer of bytes, and where it ends. Nothing is copied."""
        n, low_bits, *sizes = (int(x) for x in buffer[at : at + 40].view(np.int64))
        at += 40
        parts = []
        for size, kind in zip(sizes, (U, U, np.int64), strict=True):
            parts.append(buffer[at : at + 8 * size].view(kind))
            at += 8 * size
        return cls(n, low_bits, *parts), at

    def get(self, index: np.ndarray) -> np.ndarray:
        """Elements at the given places, all of which must exist."""
        index = np.asarray(index, np.int64)
        value = (self._select(index) - index) << self.low_bits
        if not self.low_bits:
            return value
        at = index * self.low_bits
        word, shift = at >> 6, (at & 63).astype(U)
        low = self.low[word] >> shift
        # A shift by 64 is not defined; shifting in two steps gives 0 where nothing spills over.
        low |= self.low[np.minimum(word + 1, len(self.low) - 1)] << U(1) << (U(63) - shift)
        return value | (low & U((1 << self.low_bits) - 1)).astype(np.int64)

    def _select(self, index: np.ndarray) -> np.ndarray:
        """Position of the one with the given number in the high bits."""
        block = np.searchsorted(self.ranks, index, "right") - 1
        return self._within(block, index - self.ranks[block], U(0))

    def _select_zero(self, index: np.ndarray) -> np.ndarray:
        """Position of the zero with the given number, which must exist."""
        block = np.searchsorted(self.zeros, index, "right") - 1
        return self._within(block, index - self.zeros[block], ~U(0))

    @property
    def zeros(self) -> np.ndarray:
        """Zeros before each block of the high bits."""
        if self._zeros is None:
            self._zeros = 64 * WORDS_PER_BLOCK * np.arange(len(self.ranks)) - self.ranks
        return self._zeros

    def _within(self, block: np.ndarray, left: np.ndarray, flip: np.uint64) -> np.ndarray:
        word = block * WORDS_PER_BLOCK
        for _ in range(WORDS_PER_BLOCK - 1):
            ones = np.bitwise_count(self.high[word] ^ flip).astype(np.int64)
            on = left >= ones
            left = left - ones * on
            # Once a word holds the bit, left is below its count and stays there.
            word = word + on
        bits = self.high[word] ^ flip
        place = word << 6
        for width in (32, 16, 8, 4, 2, 1):
            ones = np.bitwise_count(bits & U((1 << width) - 1)).astype(np.int64)
            on = left >= ones
            left = left - ones * on
            bits = bits >> (U(width) * on)
            place = place + width * on
        return place

    def bucket(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the elements that have the same high bits as each value, as ranges. The
        successor of the value is in its range or just behind it."""
        high = np.asarray(value, np.int64) >> self.low_bits
        # In unary the elements of high part h stand between the zeros h - 1 and h.
        last = 64 * len(self.high) - self.n - 1  # number of the last zero
        lo, hi = np.zeros(len(high), np.int64), np.full(len(high), self.n, np.int64)
        some = np.flatnonzero((high > 0) & (high - 1 <= last))
        lo[some] = self._select_zero(high[some] - 1) - (high[some] - 1)
        lo[high - 1 > last] = self.n
        some = np.flatnonzero(high <= last)
        hi[some] = self._select_zero(high[some]) - high[some]
        return lo, hi


def successor(sequence: EliasFano, lo: np.ndarray, hi: np.ndarray, target: np.ndarray) -> np.ndarray:
    """First place in [lo, hi) whose element is at least the target, else hi."""
    first, end = sequence.bucket(target)
    lo, hi = np.clip(first, lo, hi), np.clip(end, lo, hi)
    open_ = np.flatnonzero(lo < hi)
    while len(open_):
        middle = (lo[open_] + hi[open_]) >> 1
        below = sequence.get(middle) < target[open_]
        lo[open_[below]] = middle[below] + 1
        hi[open_[~below]] = middle[~below]
        open_ = open_[lo[open_] < hi[open_]]
    return lo


class Trie:
    """Sorted n-grams of one order, with a code for each.

    Level k has a node for every distinct prefix of k words, in order. The words of a level
    are stored relative to their context: the words of one parent are raised by the last
    stored number of the parent before, which makes the whole level rise. Pointers to the
    first child of each node rise anyway.
    """

    def __init__(self, words: list[EliasFano], pointers: list[EliasFano], codes: np.ndarray):
        self.words, self.pointers, self.codes = words, pointers, codes

    @staticmethod
    def build(columns: Sequence[np.ndarray], codes: np.ndarray) -> bytes:
        """Bytes of a trie. ``columns`` has one array per word of the n-grams, which are in
        order and distinct; words are numbers from 0."""
        n = len(codes)
        fresh = np.zeros(n, bool)
        parts, starts = [], np.zeros(1, np.int64)
        head = [len(columns), n]
        parent_starts = np.zeros(min(n, 1), np.int64)
        for k, column in enumerate(columns):
            changed = np.r_[True, np.diff(column) != 0] if n else fresh
            fresh = fresh | changed[:n]
            nodes = np.flatnonzero(fresh)
            if k:
                starts = np.searchsorted(nodes, parent_starts)
                parts.append(EliasFano.of(np.r_[starts, len(nodes)]))
            else:
                starts = np.zeros(min(n, 1), np.int64)
            own = np.asarray(column, np.int64)[nodes]
            ends = np.r_[starts[1:], len(nodes)] if len(starts) else starts
            last = own[ends - 1] + 1 if len(starts) else own
            raised = own + np.repeat(np.cumsum(last) - last, ends - starts)
            parts.append(EliasFano.of(raised))
            parent_starts = nodes
        blob = [np.array(head, np.int64).tobytes(), *(p.to_bytes() for p in parts)]
        return b"".join([*blob, np.asarray(codes, np.uint16).tobytes()])

    @classmethod
    def read(cls, buffer: np.ndarray) -> Trie:
        """A trie in a buffer of bytes, such as a memory-mapped file."""
        order, n = (int(x) for x in buffer[:16].view(np.int64))
        words, pointers, at = [], [], 16
        for k in range(order):
            if k:
                sequence, at = EliasFano.read(buffer, at)
                pointers.append(sequence)
            sequence, at = EliasFano.read(buffer, at)
            words.append(sequence)
        return cls(words, pointers, buffer[at : at + 2 * n].view(np.uint16))

    def find(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """Place of each n-gram in the last level, or -1. Sorted queries are answered fastest."""
        columns = [np.asarray(c, np.int64) for c in columns]
        size = len(columns[0])
        parts = [self._find([c[at : at + STEP] for c in columns]) for at in range(0, size, STEP)]
        return np.concatenate(parts) if parts else np.empty(0, np.int64)

    def _find(self, columns: list[np.ndarray]) -> np.ndarray:
        place = np.full(len(columns[0]), -1, np.int64)
        # Neighbours with the same first word look for it once.
        first = columns[0]
        starts = np.flatnonzero(np.r_[True, np.diff(first) != 0])
        level, n = self.words[0], self.words[0].n
        at = successor(level, np.zeros(len(starts), np.int64), np.full(len(starts), n), first[starts])
        hit = at < n
        hit[hit] = level.get(at[hit]) == first[starts][hit]
        sizes = np.diff(np.r_[starts, len(first)])
        alive = np.flatnonzero(np.repeat(hit, sizes))
        node, lo, hi = np.repeat(at, sizes)[alive], None, None
        for k, level in enumerate(self.words[1:], 1):
            lo, hi = self.pointers[k - 1].get(node), self.pointers[k - 1].get(node + 1)
            target = columns[k][alive]
            inner = np.flatnonzero(lo > 0)
            target[inner] += level.get(lo[inner] - 1) + 1
            at = successor(level, lo, hi, target)
            hit = at < hi
            hit[hit] = level.get(at[hit]) == target[hit]
            alive, node = alive[hit], at[hit]
        place[alive] = node
        return place
