"""Query registry: key → callable(spark, sf_dir) → DataFrame, and key → DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register a Spark query under ``key`` with its DuckDB oracle text (None = no SQL twin)."""

    def wrap(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return wrap
