"""Queries of the subpackage, filled by importing the operator modules."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import workers_import

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            workers_import(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql.strip()
        return run
    return deco


def load_all() -> tuple[dict, dict]:
    from tessera.llm import (  # noqa: F401
        bpe, decontam, html_extract, lm_score, nra, prefix_trie, quality, sharding, simhash, suffix_dedup, token_counts, token_output, warc,
    )
    return dict(QUERIES), dict(ORACLE)
