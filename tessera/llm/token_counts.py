"""Token counts by a two-tier lookup on the map side.

Tier one is a table of the frequent pre-tokens (white-space pieces, see
``word_tokens``) and their token counts, packed and broadcast to every worker. It
comes from all documents: each task keeps a bounded summary of its most frequent
pieces (Misra-Gries, pruned in batches), the summaries are added up, and the
``table_size`` largest are encoded once. Tier two is a bounded cache per worker, in
which the pieces that miss tier one are put, encoded by the library. No
pre-token is shuffled; only summaries of ``summary_size`` rows a task move.

The tables only save time: the counts are those of the library for every text.

Defined cases. A null text is empty: 0 bytes, 0 tokens. Special strings inside
texts count as the library's default has it. Repeated rows and null ids are
counted each; extra columns may have any name; an empty table gives none.
"""

from __future__ import annotations

import functools
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import col, no_gc, table
from tessera.llm.registry import query
from tessera.llm.word_tokens import encode_pieces, pieces

LIMIT = 2048
TABLE_SIZE = 65_536
SUMMARY_SIZE = 8_192
CACHE_SIZE = 1_000_000
MAX_PIECE = 64  # longer pieces are not kept in the broadcast table, which bounds it


class Lengths:
    """Tier one: packed for the broadcast, a dict in the worker."""

    def __init__(self, words: list[bytes], lengths: list[int]):
        self.blob = b" ".join(words)  # pieces contain no white space
        self.lengths = np.array(lengths, np.uint16).tobytes()

    @functools.cached_property
    def table(self) -> dict[bytes, int]:
        return dict(zip(self.blob.split(b" "), np.frombuffer(self.lengths, np.uint16).tolist())) if self.lengths else {}

    def __getstate__(self):
        return {"blob": self.blob, "lengths": self.lengths}


class Tiers(dict):
    """Piece -> number of tokens; misses are encoded and kept."""

    def __init__(self, path: str, first: dict[bytes, int], limit: int):
        super().__init__(first)
        self.path, self.first, self.limit = path, first, limit

    @no_gc()
    def learn(self, seen: set[bytes]) -> None:
        if len(self) > len(self.first) + self.limit:
            self.clear()
            self.update(self.first)
        todo = list(seen.difference(self))
        for at in range(0, len(todo), 20_000):
            part = todo[at:at + 20_000]
            self.update(zip(part, map(len, encode_pieces(self.path, part))))


_tiers: dict = {}


def _worker_tiers(path: str, lengths: Lengths, limit: int) -> Tiers:
    """One per worker process; a new table replaces it."""
    if _tiers.get("of") is not lengths:
        _tiers.update(of=lengths, tiers=Tiers(path, lengths.table, limit))
    return _tiers["tiers"]


def _summaries(summary_size: int):
    """mapInArrow function: texts to the most frequent pieces of the task."""

    def run(batches):
        top: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                top.update(pieces(t))
                if len(top) > 16 * summary_size:
                    floor = sorted(top.values(), reverse=True)[4 * summary_size]
                    top = Counter({w: n - floor for w, n in top.items() if n > floor})
        best = [(w, n) for w, n in top.most_common(summary_size) if len(w) <= MAX_PIECE]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in best], pa.binary()),
                                          pa.array([n for _, n in best], pa.int64())], ["piece", "n"])

    return run


def frequent(docs: DataFrame, path: str, text_col: str = "text", table_size: int = TABLE_SIZE,
             summary_size: int = SUMMARY_SIZE) -> Lengths:
    """Tier one for ``docs``: at most ``table_size`` pieces of ``MAX_PIECE`` bytes."""
    text = docs.select(col(docs, text_col).alias("text"))
    rows = text.mapInArrow(_summaries(summary_size), "piece binary, n long") \
        .groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(table_size).collect()
    words = [bytes(r["piece"]) for r in rows]
    return Lengths(words, [len(x) for x in encode_pieces(path, words)])


def token_count(text: Column, path: str, tier_one, cache_size: int = CACHE_SIZE) -> Column:
    """Number of tokens of a text; ``tier_one`` is a broadcast ``Lengths``."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        tiers = _worker_tiers(path, tier_one.value, cache_size)
        out = []
        values = texts.tolist()
        for at in range(0, len(values), 512):
            rows = [pieces(t) for t in values[at:at + 512]]
            tiers.learn({p for r in rows for p in r})
            out += [sum(map(tiers.__getitem__, r)) for r in rows]
        return pd.Series(out, dtype="int64")

    return of(text)


def counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT,
           table_size: int = TABLE_SIZE, cache_size: int = CACHE_SIZE) -> DataFrame:
    """One row per document: (id, n_bytes, n_tokens, over_limit)."""
    tier_one = docs.sparkSession.sparkContext.broadcast(frequent(docs, path, text_col, table_size))
    text = col(docs, text_col)
    return docs.select(col(docs, id_col).alias("id"),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
                       token_count(text, path, tier_one, cache_size).alias("n_tokens")) \
        .withColumn("over_limit", F.col("n_tokens") > limit)


@query("op6_token_counts")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by word_bpe_49k.json; the limit is 2,048."""
    c = counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return c.withColumnRenamed("id", "doc_id")
