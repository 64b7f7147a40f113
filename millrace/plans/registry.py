"""Registration of named queries and their SQL counterparts."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name; it runs with the session in UTC.

    Time zones are fixed when a DataFrame is built, so the setting may be restored before
    the caller evaluates the result.
    """

    def register(build: Query) -> Query:
        @functools.wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            with utc(spark):
                return build(spark, sf_dir)

        QUERIES[build.__name__] = run
        if sql is not None:
            SQL[build.__name__] = sql
        return run

    return register
