"""Registry of named queries over the test tables.

Each registered query is a function ``(spark, sf_dir) -> DataFrame`` built from
the library's operators, plus (when the result is expressible in SQL) the
equivalent ANSI SQL for DuckDB over the same parquet tables. Column names and
types are aligned between the two.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Registered:
    name: str
    fn: QueryFn
    sql: str | None
    ops: str


REGISTRY: dict[str, Registered] = {}


def register(name: str, sql: str | None = None, ops: str = ""):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Registered(name, fn, sql.strip() if sql else None, ops)
        return fn

    return deco


def load_all() -> dict[str, Registered]:
    # import for side effects: every module registers its queries
    from . import documents, evals, files, llmops, more, retrieval, stores, streams  # noqa: F401

    return REGISTRY
