"""Registered queries: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and, where the
operator is SQL-expressible, ``SQL[name]`` — the DuckDB statement that checks it.

Every query reads the given tables (or data Spark derives from them) in full.
Doubles are rounded to 4 decimals on both sides before comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def load_all() -> None:
    # imported for their registrations
    from tidemark.catalog import bars, dataset, health, models, registry, storage, streams  # noqa: F401
