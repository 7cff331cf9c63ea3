"""Query registry: each entry is a Spark query over a scale-factor folder and,
where one exists, the equivalent SQL the DuckDB oracle runs on the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    # importing the modules fills the registry
    from tessera.plans import (  # noqa: F401
        q_relational, q_text, q_graph, q_ml, q_parse, q_stream, q_stored, q_catalog,
    )
