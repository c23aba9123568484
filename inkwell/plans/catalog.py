"""Registry of the queries exposed through ``__spark_entry__``.

Each entry is a Spark callable ``(spark, sf_dir) -> DataFrame`` and, where the
result is expressible in SQL, the equivalent DuckDB query over the driver's
tables. Output columns carry the same names and types on both sides: integers
as BIGINT, doubles rounded to 6 places, arrays joined with '|'.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def big(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def r6(c) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), 6)


def joined(c) -> Column:
    return F.array_join(F.col(c) if isinstance(c, str) else c, "|")


def load_all() -> None:
    """Import every module that registers queries."""
    from inkwell.plans import (q_text, q_ingest, q_tfidf, q_langid, q_models,  # noqa: F401
                               q_scoring, q_run, q_marked)


FLAGSHIP = "corpus_summary"
