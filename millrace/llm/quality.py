"""Quality rules as a ledger of failure bits, policies over the bits, and ablations.

Every rule is evaluated once per text. The ledger keeps the measurements and one long whose
bit n says that rule n failed. A policy is a version and a mask of bits, so that a new policy
or an ablation reads the ledger and never the texts. All steps are DataFrame functions, and
measuring needs no shuffle: each text is one row from start to end.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import BLANKS

#: Words in a window that counts as repeated.
WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A rule fails where its SQL condition over the measurements is true."""

    bit: int
    name: str
    fails: str

    @property
    def mask(self) -> int:
        return 1 << self.bit


#: A bit is never given to another rule, so that old ledgers stay readable.
RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "many_symbols", "10 * n_symbols > word_chars"),
    Rule(3, "repeated_lines", "n_lines >= 4 and 2 * n_dup_lines > n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 20 * n_words"),
)
BASE = 0b11


@dataclass(frozen=True)
class Policy:
    """The rules that decide, as a mask of their bits."""

    version: int
    mask: int


POLICIES = {1: Policy(1, BASE), 2: Policy(2, sum(rule.mask for rule in RULES))}
CURRENT = POLICIES[2]


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` as a struct column ``row`` beside the measurements of its text.

    Words are runs without ASCII white space; a null or blank text has none and all its
    measurements are 0. ``n_dup_lines`` counts lines with a word that equal an earlier line
    of the text; ``n_repeat_words`` counts words inside five-word windows that occur twice or
    more. Windows are compared as words, not as hashes: the hashes only find the texts in
    which a comparison is needed at all.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = docs.select(
        F.struct("*").alias("row"),
        F.array_remove(F.split(body, BLANKS, -1), "").alias("words"),
        lines.alias("lines"),
        F.length(F.regexp_replace(body, BLANKS, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
    )
    counts = [
        F.size("words").cast("long").alias("n_words"),
        F.col("word_chars"),
        F.col("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    ]
    names = MEASURES[:-1]
    step = step.select(
        "row", "words", *counts,
        F.transform("words", lambda word: F.xxhash64(word)).alias("codes"),
    )
    window_code = ", ".join(f"codes[i + {k}]" for k in range(WINDOW))
    step = step.select(
        "row", "words", *names,
        F.expr(
            f"case when size(codes) > {WINDOW} then transform("
            f"sequence(0, size(codes) - {WINDOW}), i -> xxhash64({window_code})) else array() end"
        ).alias("hashes"),
    )
    step = step.select(
        "row", *names,
        F.expr(
            "case when size(array_distinct(hashes)) < size(hashes) then sort_array(transform("
            f"sequence(1, size(hashes)), i -> struct(slice(words, i, {WINDOW}) as w, i as i)))"
            " end"
        ).alias("windows"),
    )
    step = step.select(
        "row", *names,
        F.expr(
            "case when windows is not null then sort_array(transform(filter("
            "sequence(0, size(windows) - 1), k -> (k > 0 and windows[k].w = windows[k - 1].w)"
            " or (k < size(windows) - 1 and windows[k].w = windows[k + 1].w)),"
            " k -> windows[k].i)) end"
        ).alias("starts"),
    )
    # Sorted starts: each window adds the words up to the next window, at most its own.
    covered = (
        "case when size(starts) > 0 then aggregate(sequence(0, size(starts) - 1), 0L,"
        f" (sum, k) -> sum + case when k = size(starts) - 1 then {WINDOW}"
        f" else least({WINDOW}, starts[k + 1] - starts[k]) end) else 0L end"
    )
    return step.select("row", *names, F.expr(covered).alias("n_repeat_words"))


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``measure`` with the failure bits of all rules in ``failed_bits``."""
    measured = measure(docs, text)
    bits = F.lit(0).cast("long")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(rule.mask)).otherwise(F.lit(0)).cast("long"))
    entry = measured.select("row", *MEASURES, bits.alias("failed_bits"))
    # A generator of one row: filters on the ledger stay above it. Without it they would be
    # moved below the measurements, each of which would then be computed many times.
    names = [*MEASURES, "failed_bits"]
    return entry.select("row", F.stack(F.lit(1), *names).alias(*names))


def passes(policy: Policy, bits: str = "failed_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def judged(docs: DataFrame, policy: Policy = CURRENT, text: str = "text") -> DataFrame:
    """One row per document with its columns, measurements, bits and verdict.

    ``base_failed`` is the verdict of the first two rules alone. ``sole_bits`` holds the bit
    of the only rule of the policy that rejected the row, else 0. Columns of ``docs`` named
    like a result column are replaced; null ids and repeated rows are judged like any other.
    """
    results = [*MEASURES, "failed_bits", "sole_bits", "base_failed", "kept"]
    own = [f"row.`{c}`" for c in docs.columns if c.lower() not in results]
    relevant = F.col("failed_bits").bitwiseAND(F.lit(policy.mask).cast("long"))
    return ledger(docs, text).select(
        *own, *MEASURES, "failed_bits",
        F.when(F.bit_count(relevant) == 1, relevant).otherwise(F.lit(0).cast("long")).alias("sole_bits"),
        (~passes(POLICIES[1])).alias("base_failed"),
        passes(policy).alias("kept"),
    )


def kept_documents(docs: DataFrame, policy: Policy = CURRENT, text: str = "text") -> DataFrame:
    """The documents that pass, with exactly the columns of ``docs``."""
    return ledger(docs, text).where(passes(policy)).select(*[f"row.`{c}`" for c in docs.columns])


def ablations(entries: DataFrame, policy: Policy = CURRENT, bits: str = "failed_bits") -> DataFrame:
    """For each rule of the policy: rows that fail it, rows that only it rejects, and the rows
    kept with and without it. ``entries`` is a ledger or any table with its bits.

    Rows are first counted per distinct value of the bits, so that the shuffle carries at most
    2^rules rows per task. An empty ledger gives zeros.
    """
    mask = F.lit(policy.mask).cast("long")
    groups = (
        entries.groupBy(F.col(bits).bitwiseAND(mask).alias("bits"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rules = [rule for rule in RULES if rule.mask & policy.mask]

    def rows(condition: str) -> Column:
        return F.coalesce(F.sum(F.when(F.expr(condition), F.col("n"))), F.lit(0)).cast("long")

    totals = groups.agg(
        F.array(
            *[
                F.struct(
                    F.lit(policy.version).alias("policy"), F.lit(rule.name).alias("rule"),
                    rows(f"bits & {rule.mask} != 0").alias("n_failed"),
                    rows(f"bits = {rule.mask}").alias("n_only"),
                    rows("bits = 0").alias("n_kept"),
                    rows(f"bits & {policy.mask & ~rule.mask} = 0").alias("n_kept_without"),
                )
                for rule in rules
            ]
        ).alias("rules")
    )
    return totals.select(F.inline("rules"))
