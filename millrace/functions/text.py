"""Lines, words, delimited records and paths."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def explode_parts(
    df: DataFrame, column: str, separator: str, part: str, keep_empty: bool = False
) -> DataFrame:
    """One row per piece of ``column``, empty pieces if asked for; other columns are repeated."""
    others = [c for c in df.columns if c != column]
    pieces = F.split(F.col(column), re.escape(separator))
    rows = df.select(*others, F.explode(pieces).alias(part))
    return rows if keep_empty else rows.filter(F.col(part) != "")


def words(df: DataFrame, column: str = "value", word: str = "word") -> DataFrame:
    """Split on single spaces, as a plain whitespace tokeniser of typed lines would."""
    return explode_parts(df, column, " ", word)


def lines(df: DataFrame, column: str, line: str = "value") -> DataFrame:
    """Turn multi-line text into the one-column line shape of a line source.

    Blank lines are lines too.
    """
    return explode_parts(df, column, "\n", line, keep_empty=True)


def short_lines(df: DataFrame, limit: int = 5, column: str = "value") -> DataFrame:
    return df.filter(F.length(column) <= limit)


def upper_lines(df: DataFrame, column: str = "value") -> DataFrame:
    return df.withColumn(column, F.upper(column))


def typed_field(raw: Column, type_name: str, date_format: str | None = None) -> Column:
    """Convert text without failing: a value that does not parse becomes NULL."""
    if type_name == "date" and date_format:
        return F.try_to_date(raw, date_format)
    return raw.try_cast(type_name)


def parse_delimited(
    df: DataFrame,
    schema: str,
    separator: str = ",",
    column: str = "value",
    date_format: str | None = None,
    valid: str | None = None,
) -> DataFrame:
    """Delimited text to typed columns, one record per line.

    Missing or malformed fields become NULL and the row is kept. With ``valid`` given, a
    boolean column of that name says whether every field was present and parsed, so bad
    lines can be routed elsewhere instead of stopping the query.
    """
    fields = StructType.fromDDL(schema).fields
    # get() past the end of the array is NULL, where indexing would raise under ANSI.
    parts = F.split(F.col(column), re.escape(separator))
    typed = [
        typed_field(F.get(parts, F.lit(i)), f.dataType.simpleString(), date_format).alias(f.name)
        for i, f in enumerate(fields)
    ]
    kept = [c for c in df.columns if c != column]
    parsed = df.select(*kept, *typed)
    if valid is None:
        return parsed
    complete = F.lit(True)
    for field in fields:
        complete = complete & F.col(field.name).isNotNull()
    return parsed.withColumn(valid, complete)


def path_segments(df: DataFrame, column: str, segments: dict[int, str]) -> DataFrame:
    """Pick numbered ``/`` segments of a path; a segment that is not there is NULL."""
    parts = F.split(F.col(column), "/")
    picked = [F.get(parts, F.lit(i)).alias(name) for i, name in segments.items()]
    return df.select(*[c for c in df.columns if c != column], *picked)


def json_records(df: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Parse a JSON column and expand its fields; malformed text gives NULL fields."""
    kept = [c for c in df.columns if c != column]
    fields = StructType.fromDDL(schema).names
    parsed = df.select(*kept, F.from_json(F.col(column), schema).alias("record"))
    return parsed.select(*kept, *[F.col(f"record.{name}").alias(name) for name in fields])


def explode_columns(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """One output row per listed column of each input row."""
    return df.select(F.explode(F.array(*columns)).alias(name))


