"""Groups of spelling variants: each word with the more frequent word that differs in one character.

The index is of grams of variable length. A dictionary holds grams of SHORTEST to LONGEST
characters of words between two marks: a gram is in it if the grams it extends are frequent,
so that it takes rare grams at their shortest and frequent ones only as parts of longer ones.
A word is decomposed into the longest dictionary gram at each position (the gram of
SHORTEST characters where there is none) without those that lie inside an earlier one.

One edit touches the grams that contain its place, and those beside it that another character
there could lengthen or swallow, which the prefixes and suffixes of the dictionary tell. The
largest number of grams that an edit at any place of a word can touch is the word's bound.
Words one edit apart share all but so many grams; so each shares at least one gram of its
bound + 1 rarest ones with the other, and only these go into the lists that are merged. A
word that one edit could change in all its grams is looked up by all its grams of SHORTEST
characters as well, of which an edit touches only SHORTEST.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import hash_below, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: One in this many runs of a document loses a character.
THINNED = 97
SHORTEST, LONGEST = 2, 4
#: Words in a list below which a gram is not extended, and words that the dictionary is made of.
RARE = 50
SAMPLE_WORDS = 50_000
#: Distinct words a task holds before it passes them on.
HELD_WORDS = 300_000
LEAST_LENGTH, LEAST_COUNT = 5, 3
LEFT, RIGHT = "^", "$"


# --- words ------------------------------------------------------------------------------------


def spelled(key: str, text: str | None) -> Counter:
    """Runs of letters of a text with A-Z in lower case, some without one character."""
    found: Counter = Counter()
    if text is None:
        return found
    start = zlib.crc32(f"{key}:".encode("utf-8", "surrogatepass"))
    for run, n in Counter(RUN.findall(text.translate(FOLD))).items():
        code = zlib.crc32(run.encode(), start)
        if code % THINNED == 0:
            gone = code % len(run)
            run = run[:gone] + run[gone + 1:]
        if len(run) >= LEAST_LENGTH:
            found[run] += n
    return found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def sent() -> pa.RecordBatch:
        words = list(held)
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array([held[w] for w in words], pa.int64())],
            names=["word", "n"],
        )

    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1)):
            held.update(spelled(key.as_py(), text.as_py()))
            if len(held) >= HELD_WORDS:
                yield sent()
                held = Counter()
    yield sent()


def counted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of the words with enough characters and occurrences."""
    rows = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")), F.col(text).cast("string")
    )
    return (
        rows.mapInArrow(_count, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)
    )


# --- grams ------------------------------------------------------------------------------------


class Grams:
    """A dictionary of variable-length grams, with its prefixes and suffixes."""

    def __init__(self, counts: dict[str, int]) -> None:
        #: How often each gram of the dictionary is in the sampled words.
        self.counts = counts
        self.prefixes = {g[:k] for g in counts for k in range(1, len(g))}
        self.suffixes = {g[k:] for g in counts for k in range(1, len(g))}

    @classmethod
    def of(cls, words: Iterable[str], rare: int = RARE) -> Grams:
        """Grams whose shorter form is in more than ``rare`` of the words, and those shorter forms."""
        marked = [LEFT + w + RIGHT for w in words]
        counts: dict[str, int] = {}
        frequent: set[str] = set()
        for size in range(SHORTEST, LONGEST + 1):
            level = Counter(
                w[i:i + size] for w in marked for i in range(len(w) - size + 1)
                if size == SHORTEST or w[i:i + size - 1] in frequent
            )
            counts.update(level)
            frequent = {g for g, n in level.items() if n > rare}
        return cls(counts)

    def split(self, word: str) -> list[tuple[int, int]]:
        """Start and end of each gram of the marked word."""
        marked = LEFT + word + RIGHT
        found, last = [], 0
        for start in range(len(marked) - SHORTEST + 1):
            end = start + SHORTEST
            for size in range(min(LONGEST, len(marked) - start), SHORTEST, -1):
                if marked[start:start + size] in self.counts:
                    end = start + size
                    break
            if end > last:
                found.append((start, end))
                last = end
        return found

    def bound(self, word: str, spans: list[tuple[int, int]]) -> int:
        """The most grams of the word that one inserted, deleted or replaced character touches.

        A gram left of the place is touched if the text from its start, or from an earlier
        start, up to the place begins a longer gram: that one may swallow it. A gram right of
        the place is touched if the text from the place up to its end, or to a later end, is
        the end of a longer gram. Grams are in order of starts and of ends, so the touched ones
        are a range.
        """
        marked = LEFT + word + RIGHT
        starts = [s for s, _ in spans]
        ends = [e for _, e in spans]
        most = 0
        for place in range(1, len(marked)):
            left = place
            for start in range(max(0, place - LONGEST + 1), place):
                if marked[start:place] in self.prefixes:
                    left = start
                    break
            first = min(bisect.bisect_left(starts, left), bisect.bisect_right(ends, place))
            # A character inserted before `place`, then the one at `place` deleted or replaced.
            for after in (place, place + 1):
                if after == len(marked):
                    break
                right = after
                for end in range(min(len(marked), after + LONGEST - 1), after, -1):
                    if marked[after:end] in self.suffixes:
                        right = end
                        break
                until = max(bisect.bisect_right(ends, right), bisect.bisect_left(starts, after))
                most = max(most, until - first)
        return most

    def listed(self, word: str) -> list[tuple[str, int]]:
        """The grams, with their starts, under which a word is put into the lists."""
        marked = LEFT + word + RIGHT
        spans = self.split(word)
        bound = self.bound(word, spans)
        found = _rarest([(marked[s:e], s) for s, e in spans], bound + 1, self.counts)
        if len({marked[s:e] for s, e in spans}) <= bound:
            plain = [(marked[i:i + SHORTEST], i) for i in range(len(marked) - SHORTEST + 1)]
            found += [(LEFT + g, i) for g, i in _rarest(plain, SHORTEST + 1, self.counts)]
        return found


def _rarest(grams: list[tuple[str, int]], most: int, counts: dict[str, int]) -> list[tuple[str, int]]:
    """All places of the rarest so many grams; equally rare ones in code-point order."""
    chosen = set(sorted({g for g, _ in grams}, key=lambda g: (counts.get(g, 0), g))[:most])
    return [(g, at) for g, at in grams if g in chosen]


# --- pairs ------------------------------------------------------------------------------------


def fitted(words: DataFrame) -> Grams:
    """A dictionary from about SAMPLE_WORDS words, drawn by hash. It decides the length of the
    lists, not which pairs are found."""
    total = words.count()
    rows = words.where(hash_below(F.xxhash64("word"), SAMPLE_WORDS, total)).select("word").collect()
    return Grams.of([row.word for row in rows])


def near_pairs(words: DataFrame, grams: Grams) -> DataFrame:
    """(a, b) of all words that differ by one inserted, deleted or replaced character, a once.

    ``words`` has distinct values in ``word``, each of at least LEAST_LENGTH characters. A gram
    that the edit leaves alone stands at the same place in both words or, in the longer one,
    one further on; so a list is of one gram at one place in words of one length.
    """
    sent = words.sparkSession.sparkContext.broadcast(grams)  # grams of SAMPLE_WORDS words

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = sent.value
        for frame in frames:
            listed = [own.listed(word) for word in frame.word]
            yield pd.DataFrame({
                "word": frame.word,
                "grams": [[g for g, _ in some] for some in listed],
                "places": [[at for _, at in some] for some in listed],
            })

    listed = words.select("word").mapInPandas(split, "word string, grams array<string>, places array<int>")
    rows = written(
        listed.select(
            "word", F.char_length("word").alias("size"), F.explode(F.arrays_zip("grams", "places")).alias("at")
        ).select("word", "size", F.col("at.grams").alias("gram"), F.col("at.places").alias("place")),
        "variant-grams",
    )
    # A list is named by a hash; two lists under one name cost time, not pairs.
    right = rows.select(F.xxhash64("gram", "size", "place").alias("list"), F.col("word").alias("b"))
    asked = F.array(
        F.struct("size", "place"), F.struct((F.col("size") + 1).alias("size"), "place"),
        F.struct((F.col("size") + 1).alias("size"), (F.col("place") + 1).alias("place")),
    )
    left = rows.select("word", "size", "gram", F.explode(asked).alias("asked")).select(
        F.xxhash64("gram", "asked.size", "asked.place").alias("list"), F.col("word").alias("a")
    )
    longer = F.char_length("a") < F.char_length("b")
    return (
        left.join(right, "list")
        .where((longer | ((F.char_length("a") == F.char_length("b")) & (F.col("a") < F.col("b")))))
        .where(F.levenshtein("a", "b", 1) == 1)
        .select("a", "b").distinct()
    )


def grouped(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of distinct words with counts (word, n).

    Of the near words (those one edit away) the most frequent one, of equals the first in
    code-point order, is the form if it is at least twice as frequent as the word, which else
    has none. ``root`` is where the forms lead from the word. A word without near words has
    n_near 0 and is its own root; an empty table gives an empty result.
    """
    words = written(words.select("word", "n"), "variant-words")
    pairs = written(near_pairs(words, fitted(words)), "variant-pairs")
    both = pairs.union(pairs.select("b", "a"))
    rated = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("near_n")), "b")
    best = rated.groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("fewer"), F.col("b").alias("form"))).alias("best"),
    )
    near_n = -F.col("best.fewer")
    has = near_n >= 2 * F.col("n")
    known = written(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(has, F.col("best.form")).alias("form"), F.when(has, near_n).alias("form_n"),
        ),
        "variant-forms",
    )
    roots = _roots(known.where("form is not null").select("word", F.col("form").alias("root")))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(steps: DataFrame) -> DataFrame:
    """The end of each chain: every round doubles the steps taken. Counts at least double with
    each step, so that chains are short and have no circles."""
    while True:
        following = steps.select(F.col("word").alias("root"), F.col("root").alias("later"))
        moved = steps.join(following, "root", "left")
        steps = written(
            moved.select("word", F.coalesce("later", "root").alias("root"), F.col("later").isNotNull().alias("went")),
            "variant-roots",
        )
        if not steps.where("went").limit(1).count():
            return steps.select("word", "root")
        steps = steps.select("word", "root")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Spelling variants among the words of all texts; see ``counted`` and ``grouped``.

    A null text has no words, a null id counts as an empty one, repeated rows count again.
    Texts of any length are read whole; other columns are not read.
    """
    return grouped(counted(docs, key, text))
