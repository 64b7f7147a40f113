"""The language of a text: the one whose dictionary compresses it best.

Each learned language has a raw-content zstandard dictionary of labelled text. A text is cut
into windows of equal length, each window is compressed with every dictionary, and the language
with the smallest sum wins. A window is followed by a run of zeros, which costs the same under
every dictionary and lets zstandard use short matches even in a text of a few words, which it
would otherwise store as it is. Narrow margins between the two best are marked as rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import crc_remainder, free_name, hash_below

UNKNOWN = "und"
#: Bounds of the sample: rows and characters drawn per language, rows of all languages, and
#: bytes of a dictionary and of all dictionaries.
SAMPLE_ROWS = 400
SAMPLE_CHARS = 1000
ALL_ROWS = 40_000
DICTIONARY_BYTES = 64 << 10
ALL_BYTES = 16 << 20
#: Bytes of text compressed at a time.
WINDOW = 1000
FILL = b"\0" * 100
#: Bytes per window by which the two best must differ, and those that divide their odds by e.
MARGIN = 1.0
SCALE = 4.0
LETTER = re.compile(r"[^\W\d_]")
SETTINGS = {
    "strategy": zstandard.STRATEGY_LAZY2, "min_match": 4, "search_log": 3, "target_length": 16,
    "window_log": 17, "chain_log": 17, "hash_log": 17,
    "write_content_size": 0, "write_checksum": 0, "write_dict_id": 0,
}

Dictionaries = dict[str, bytes]


def learn(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    divisor: int = 4, held_out: int = 2,
) -> Dictionaries:
    """A dictionary per language from a sample of the documents that are not held out.

    Documents without a text or language teach nothing. From each language about SAMPLE_ROWS
    documents are drawn by a hash of id and text (fewer if there are more than ALL_ROWS /
    SAMPLE_ROWS languages), equal ones once, and from each one passage of SAMPLE_CHARS
    characters, whose place in the text is drawn by the same hash, for texts of any length.
    The languages themselves come to the driver and must be a list of bounded length.
    """
    known = docs.where(
        (crc_remainder(F.col(key), divisor) != held_out) & F.col(lang).isNotNull()
        & (F.length(F.col(text).cast("string")) > 0)
    ).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("body"),
        F.xxhash64(F.col(key).cast("string"), F.col(text).cast("string")).alias("place"),
    )
    totals = {row.lang: row["count"] for row in known.groupBy("lang").count().collect()}
    if not totals:
        return {}
    wanted = max(1, min(SAMPLE_ROWS, ALL_ROWS // len(totals)))
    drawn = F.lit(False)
    common = {name: n for name, n in totals.items() if n > wanted}
    if len(common) < len(totals):
        # Languages of which everything is taken.
        drawn = ~F.col("lang").isin(list(common)) if common else F.lit(True)
    for name, n in common.items():
        drawn = drawn | ((F.col("lang") == name) & hash_below(F.col("place"), wanted, n))
    free = F.greatest(F.length("body") - SAMPLE_CHARS, F.lit(0))
    start = (F.pmod(F.xxhash64("place"), free + 1) + 1).cast("int")
    rows = (
        known.where(drawn)
        .select("lang", "place", F.substring("body", start, F.lit(SAMPLE_CHARS)).alias("passage"))
        .groupBy("lang", "place").agg(F.min("passage").alias("passage"))
        .collect()
    )
    size = min(DICTIONARY_BYTES, ALL_BYTES // len(totals))
    found: dict[str, list[bytes]] = {}
    for row in sorted(rows, key=lambda r: (r.lang, r.place)):
        found.setdefault(row.lang, []).append(row.passage.lower().encode("utf-8", "surrogatepass"))
    return {name: b"\n".join(passages)[:size] for name, passages in found.items()}


def compressors(dictionaries: Dictionaries) -> dict[str, zstandard.ZstdCompressor]:
    """A compressor per language, in alphabetical order."""
    found = {}
    for name in sorted(dictionaries):
        settings = zstandard.ZstdCompressionParameters(**SETTINGS)
        content = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(compression_params=settings)
        found[name] = zstandard.ZstdCompressor(compression_params=settings, dict_data=content)
    return found


def sizes_of(text: str, known: dict[str, zstandard.ZstdCompressor]) -> np.ndarray:
    """Bytes of the whole text under each compressor."""
    data = text.lower().encode("utf-8", "surrogatepass")
    windows = [data[at:at + WINDOW] + FILL for at in range(0, len(data), WINDOW)]
    return np.array([sum(len(c.compress(w)) for w in windows) for c in known.values()], float)


def judge(text: str | None, known: dict[str, zstandard.ZstdCompressor]) -> tuple[str, float, bool]:
    """Language, score and whether the margin is too narrow."""
    if not known or text is None or not LETTER.search(text):
        return UNKNOWN, 0.0, True
    sizes = sizes_of(text, known)
    best = int(sizes.argmin())
    windows = -(-len(text.encode("utf-8", "surrogatepass")) // WINDOW)
    margin = np.partition(sizes, 1)[1] - sizes[best] if len(sizes) > 1 else np.inf
    score = float(1 / np.exp(-np.minimum((sizes - sizes[best]) / SCALE, 700)).sum())
    return list(known)[best], score, bool(margin < MARGIN * windows)


def identified(docs: DataFrame, dictionaries: Dictionaries, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and rejected.

    ``lang_pred`` is ``und`` for a text that is null or has no letter, and for every text if
    nothing was learned; the score is 0 then. Equal sizes go to the language that comes first
    by name. ``rejected`` marks those and texts whose two best languages differ by less than
    MARGIN bytes a window; take ``und`` for them where a doubtful language is worse than none.
    Texts are read whole. Other columns pass through unread; columns of these three names are
    replaced. An empty table gives an empty result.
    """
    own = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "rejected")]
    body = free_name(docs, "judged_text")
    rows = docs.select(*own, F.col(text).cast("string").alias(body))
    schema = docs.select(
        *own, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected")
    ).schema
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)  # at most ALL_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = compressors(sent.value)
        for batch in batches:
            judged = [judge(value.as_py(), known) for value in batch.column(batch.num_columns - 1)]
            names, scores, rejected = zip(*judged) if judged else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1], pa.array(names, pa.string()),
                    pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_()),
                ],
                names=[*own, "lang_pred", "score", "rejected"],
            )

    return rows.mapInArrow(run, schema)
