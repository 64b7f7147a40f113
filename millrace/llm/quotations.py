"""Quotation linking: conversations in reply order, without the text they quote.

A message's lines have a quote level, the number of leading ``>`` marks. Runs of lines with
one level, up to a blank line or another level, are passages. A passage is normalised (marks
and white space dropped, lower case) and hashed, and so is each of its lines, since quotes are
often cut. Quoted hashes are joined to the unquoted passages and lines of earlier messages of
the conversation. A message replies to the message that holds most of what it quotes at the
shallowest level of which anything is found, the latest of equals. So a message whose direct
parent is missing, or that quotes at ``> >`` only, still joins its thread. If it quotes nothing
that is found, it starts a thread.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import written

MARKS = re.compile(r"[ \t]*((?:>[ \t]?)+)")
#: How mail programs end the line that introduces a quotation.
WROTE = ("wrote", "schrieb", "a écrit", "escribió")
#: Characters before that ending, unless the line starts with the word "on".
BEFORE = 200
#: Turns of a conversation that one task orders together.
SPAN = 4096


def quote_level(line: str) -> tuple[int, str]:
    """Number of leading quote marks and the rest of the line."""
    marks = MARKS.match(line)
    if not marks:
        return 0, line
    return marks[1].count(">"), line[marks.end() :]


def introduces(line: str) -> bool:
    """Whether a line only introduces a quotation, as in "On Monday A wrote:"."""
    line = line.strip().lower()
    if not line.endswith(":"):
        return False
    line = line[:-1].rstrip()
    for verb in WROTE:
        start = line.removesuffix(verb)
        if start != line and not re.search(r"\w\Z", start[-1:]):
            return len(start) <= BEFORE or re.match(r"on\b", start) is not None
    return False


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def passages(text: str | None) -> list[tuple[int, list[str]]]:
    """Levels and lines of all passages. A blank line belongs to none."""
    out: list[tuple[int, list[str]]] = []
    fresh = True
    for line in (text or "").split("\n"):
        level, rest = quote_level(line)
        if not rest.strip():
            fresh = True
        elif fresh or out[-1][0] != level:
            out.append((level, [rest]))
            fresh = False
        else:
            out[-1][1].append(rest)
    return out


def own_text(text: str | None) -> str:
    """The text without quoted lines and without the lines that introduce them."""
    lines = [(quote_level(line)[0], line) for line in (text or "").split("\n")]
    if not any(level for level, _ in lines):
        return text or ""
    kept: list[str] = []
    for level, line in lines:
        if not level:
            kept.append(line)
            continue
        while kept and not kept[-1].strip():
            kept.pop()
        if kept and introduces(kept[-1]):
            kept.pop()
        if kept and kept[-1] != "":
            kept.append("")
    return "\n".join(kept).strip("\n")


def hashes(text: str | None) -> list[tuple[int, int, int]]:
    """(level, hash, words) of every passage and of every line of a longer passage."""
    out = []
    for level, lines in passages(text):
        for part in [lines, *([line] for line in lines if len(lines) > 1)]:
            body = normalised(" ".join(part))
            if level == 0 and len(part) == 1 and introduces(part[0]):
                continue
            out.append((level, xxhash.xxh64_intdigest(body.encode()) - (1 << 63), body.count(" ") + 1))
    return out


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [
            (conv, turn, *found)
            for conv, turn, text in zip(batch["conv"], batch["turn"], batch["text"], strict=True)
            for found in hashes(text)
        ]
        yield pd.DataFrame(rows, columns=["conv", "turn", "level", "hash", "words"])


def _strip(bodies: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in bodies:
        yield batch.map(own_text, na_action=None)


def parents(messages: DataFrame) -> DataFrame:
    """(conv, turn, parent) of the messages whose quotations are found in an earlier message.

    ``messages`` has conv, turn and text, without nulls in the first two. Only passages that
    some message of the conversation quotes are kept. The latest earlier message with a
    passage is found within spans of turns and carried from span to span, so that a passage
    that a whole conversation repeats is no group of its own.
    """
    parsed = written(
        messages.mapInPandas(_parse, "conv long, turn long, level int, hash long, words int"),
        "passages",
    )
    quoted = parsed.where("level > 0").groupBy("conv", "turn", "hash").agg(
        F.min("level").alias("level"), F.max("words").alias("words")
    )
    wanted = quoted.select("conv", "hash").distinct()
    held = (
        parsed.where("level = 0").select("conv", "hash", "turn").distinct()
        .join(wanted, ["conv", "hash"], "left_semi")
    )
    none = F.lit(None)
    events = held.select(
        "conv", "hash", "turn", F.col("turn").alias("at"), none.cast("int").alias("level"), none.cast("int").alias("words")
    ).union(
        quoted.select("conv", "hash", "turn", none.cast("long").alias("at"), "level", "words")
    ).withColumn("span", F.floor(F.col("turn") / SPAN))
    last = events.groupBy("conv", "hash", "span").agg(F.max("at").alias("last"))
    spans = Window.partitionBy("conv", "hash").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    before = last.select("conv", "hash", "span", F.max("last").over(spans).alias("before"))
    # Strictly earlier turns: equal turns are peers and stay out of the range.
    inside = Window.partitionBy("conv", "hash", "span").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    found = (
        events.withColumn("near", F.max("at").over(inside))
        .where("words is not null")
        .join(before, ["conv", "hash", "span"])
        .select("conv", "turn", "level", "words", F.coalesce("near", "before").alias("parent"))
        .where("parent is not null")
    )
    votes = found.groupBy("conv", "turn", "level", "parent").agg(F.sum("words").alias("words"))
    best = F.max(F.struct((-F.col("level")).alias("depth"), "words", "parent")).alias("best")
    return votes.groupBy("conv", "turn").agg(best).select(
        "conv", "turn", F.col("best.parent").alias("parent")
    )


def threads(links: DataFrame) -> DataFrame:
    """(conv, turn, root) of the messages with a parent, by doubling of the path upwards."""
    up = written(links.select("conv", "turn", F.col("parent").alias("root")), "threads")
    while True:
        above = up.select("conv", F.col("turn").alias("root"), F.col("root").alias("next"))
        step = written(
            up.join(above, ["conv", "root"], "left")
            .select("conv", "turn", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "threads",
        )
        if not step.where("moved").limit(1).count():
            return step.drop("moved")
        up = step.drop("moved")


def conversations(
    messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text"
) -> DataFrame:
    """``messages`` with parent_turn, thread_turn, position and body.

    ``body`` is the text without quotations (null becomes empty). ``position`` counts from 0
    in each conversation: threads by the turn that starts them, and inside by turn, so that a
    reply always follows what it answers. Rows of one turn, equal rows too, have positions of
    their own. Rows with a null conversation or turn are linked with nothing; a null is a
    conversation of its own, and a null turn stands first. Columns named like a result column are replaced.
    An empty table gives an empty result.
    """
    names = ("parent_turn", "thread_turn", "position", "body")
    own = [c for c in messages.columns if c.lower() not in names]
    slim = messages.select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.col(text).cast("string").alias("text"),
    ).where("conv is not null and turn is not null")
    links = written(parents(slim), "parents")
    placed = links.join(threads(links), ["conv", "turn"]).select(
        F.col("conv").alias("q_conv"), F.col("turn").alias("q_turn"), "parent", "root"
    )
    rows = messages.select(
        F.struct(*own).alias("row"), F.col(conv).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"), F.col(text).cast("string").alias("body"),
        F.xxhash64(*[c for c in own if "map<" not in messages.schema[c].dataType.simpleString()]).alias("tie"),
    )
    rows = rows.join(placed, (F.col("conv") == F.col("q_conv")) & (F.col("turn") == F.col("q_turn")), "left")
    strip = F.pandas_udf(_strip, "string")
    rows = rows.select(
        "row", "conv", "turn", strip("body").alias("body"), "tie", "parent",
        F.coalesce("root", "turn").alias("root"),
    )
    # Position: order all rows by range partitions, then add up what earlier partitions hold
    # of a conversation. No conversation is ordered by one task.
    order = ["conv", "root", "turn", "tie"]
    ranged = written(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id()),
        "ordered",
    )
    counts = ranged.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("conv", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part", "conv").orderBy("root", "turn", "tie")
    numbered = ranged.withColumn("inside", F.row_number().over(inside) - 1)
    offsets = offsets.select(F.col("conv").alias("o_conv"), F.col("part").alias("o_part"), "offset")
    return numbered.join(
        offsets, (F.col("part") == F.col("o_part")) & F.col("conv").eqNullSafe(F.col("o_conv"))
    ).select(
        *[f"row.`{c}`" for c in own], F.col("parent").alias("parent_turn"),
        F.col("root").alias("thread_turn"),
        (F.col("offset") + F.col("inside")).cast("long").alias("position"), "body",
    )
