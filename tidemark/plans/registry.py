"""Registry of queries: a function (spark, sf_dir) -> DataFrame, and its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
#: The moment that stands for "now" in all checked queries.
NOW = "2024-01-31 00:00:00"


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql.replace("{NOW}", f"TIMESTAMP '{NOW}'")
        return f

    return add
