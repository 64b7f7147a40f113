"""URL filter rules: host-suffix and path-prefix expressions joined on short hash prefixes.

Every distinct (host, path) is expanded into expressions ``host suffix + path prefix``. Only
path prefixes as long as some rule's path are made. The first 32 bits of an expression's
SHA-256 are the join key; a match counts only if the full digests agree. Among the rules
that fit, the longest (host and path together) wins, then the longer host, then block.

Everything is DataFrame functions. The rules are a table and may be large: their side is
joined by key, and broadcast only if Spark's own size check allows.
"""

from __future__ import annotations

from collections.abc import Iterable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import free_name

ALLOW, BLOCK = "allow", "block"
RULE_SCHEMA = "host string, path string, verdict string"


def rules_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Rules as (host, path, verdict)."""
    return spark.createDataFrame(list(rules), RULE_SCHEMA)


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased.

    Empty for null and for a text without ``://``. Only ASCII letters change.
    """
    return _lowered(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def _lowered(host: Column) -> Column:
    return F.translate(host, ascii_uppercase, ascii_lowercase)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty where the host is."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))


def host_suffixes(host: Column) -> Column:
    """The host and every domain above it: ``a.b.c``, ``b.c``, ``c``."""
    labels = F.split(host, r"\.", -1)
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def _digest(host: Column, path: Column) -> Column:
    # A line feed cannot stand in a host that was cut from a rule, so pairs stay apart.
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _short(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def match_rules(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """The rows of ``urls`` with host, path, rule and verdict.

    Null urls and urls without ``://`` have an empty host and path and fit no rule with a
    host. Rules with a null host, path or verdict are ignored; a repeated rule counts once,
    and if it is repeated with both verdicts it blocks. A-Z in rule hosts are lower-cased too. A url that no rule fits is allowed
    and its rule is null. Columns of ``urls`` named like a result column are replaced.
    An empty table gives an empty result.
    """
    kept = [c for c in urls.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    host_name, path_name = free_name(urls, "url_host"), free_name(urls, "url_path")
    source = F.col(url).cast("string")
    parsed = urls.select(
        *kept, url_host(source).alias(host_name), url_path(source).alias(path_name)
    )

    rules = (
        rules.where("host is not null and path is not null and verdict is not null")
        .groupBy(_lowered(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"))
        .agg(F.max("verdict").alias("rule_verdict"))  # 'block' sorts after 'allow'
        .withColumn("rule_digest", _digest(F.col("rule_host"), F.col("rule_path")))
        .withColumn("short", _short(F.col("rule_digest")))
    )
    # The distinct lengths of rule paths, one value.
    lengths = rules.agg(F.array_sort(F.collect_set(F.length("rule_path"))))

    places = parsed.select(F.col(host_name).alias("u_host"), F.col(path_name).alias("u_path")).distinct()
    expressions = (
        places.withColumn("suffix", F.explode(host_suffixes(F.col("u_host"))))
        .withColumn("length", F.explode(lengths.scalar()))
        .where(F.length("u_path") >= F.col("length"))
        .select("u_host", "u_path",
                _digest(F.col("suffix"), F.expr("substring(u_path, 1, length)")).alias("digest"))
        .withColumn("short", _short(F.col("digest")))
    )
    best = (
        expressions.join(rules, "short")
        # Written as a prefix test, or Spark would shuffle by the digests too.
        .where(F.col("digest").startswith(F.col("rule_digest")))
        .groupBy("u_host", "u_path")
        .agg(
            F.max(
                F.struct(
                    F.length(F.concat("rule_host", "rule_path")), F.length("rule_host"),
                    F.col("rule_verdict"), F.concat("rule_host", "rule_path").alias("rule"),
                )
            ).alias("best")
        )
        .select("u_host", "u_path", F.col("best.rule").alias("u_rule"), F.col("best.rule_verdict").alias("u_verdict"))
    )
    joined = parsed.join(
        best,
        (parsed[host_name] == best["u_host"]) & (parsed[path_name] == best["u_path"]),
        "left",
    )
    return joined.select(
        *kept,
        F.col(host_name).alias("host"),
        F.col(path_name).alias("path"),
        F.col("u_rule").alias("rule"),
        F.coalesce("u_verdict", F.lit(ALLOW)).alias("verdict"),
    )
