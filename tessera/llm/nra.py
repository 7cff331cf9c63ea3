"""Ranked lexical search by NRA (no random access) over impact-sorted postings.

A document's score for a query is the sum of whole-number impacts of the query's
terms in it. The index holds, per shard of the documents and term, the postings by
falling impact. A query reads its terms' lists from the top, a block of each at a time,
and keeps for every document met a score interval: the lower end adds up the impacts
read, the upper end adds, for each list where the document has not been met, the last
impact read from that list. Documents not met at all are bounded by the sum of
those. Reading goes on until the ``k`` highest documents are certain: everything outside
falls short of the k-th lower end, and whatever could still reach it, ties included,
has an interval of one number. No posting is looked up by document.

Shards hold whole documents, so each shard's answer is exact and the answer of the
corpus is the best ``k`` of the shards' answers.

Defined cases. Null texts and texts without a term are no documents: they count in no
statistic and are never found. Null, empty and unknown queries find nothing. Repeated
rows are documents of their own, ranked one after the other; equal scores go by id,
null ids last. Repeated items are answered each. A term found twice in an item counts
twice. Other columns are ignored. Empty tables give an empty result.

Scale: one scan of the texts per block of queries (``QUERY_BYTES`` of item texts; the
items of a block and their weights are all that is broadcast), which keeps only
the block's terms. Shards have about ``SHARD`` postings whatever the number of documents,
dealt by the hash of the row, so neither a frequent term nor a source gathers
in one task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import col, stored, table, trim_memory
from tessera.llm.registry import query

TOP = 20
FIRST_BLOCK = 128
SHARD = 2_000_000
QUERY_BYTES = 4 << 20

# fixed by the contract: what separates terms; of the rest A-Z is lower-cased
_SEPARATORS = {*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)}
_FOLD = bytes(0x20 if b in _SEPARATORS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def term_counts(text: str | None) -> Counter:
    """How often each term occurs in a text."""
    c = Counter((text or "").encode().translate(_FOLD).split(b" "))
    c.pop(b"", None)
    return c


def nra(lists: list[tuple[np.ndarray, np.ndarray]], order: np.ndarray, k: int = TOP,
        block: int = FIRST_BLOCK) -> list[tuple[int, int]]:
    """(document, score) of the ``k`` best with a score above 0, best first, equal
    scores by ``order``, a number per document. ``lists``: (documents, impacts),
    impacts falling."""
    n_docs = len(order)
    lower = np.zeros(n_docs, np.int64)
    met = np.zeros(n_docs, bool)
    live = None  # once no new document can get in: those that still can
    at = 0
    while True:
        rest = 0
        for docs, impacts in lists:  # sequential reads: each list from where it was left
            d, x = docs[at:at + block], impacts[at:at + block]
            if live is not None:
                own = live[d]
                d, x = d[own], x[own]
            lower[d] += x
            met[d] = True
            if at + block < len(impacts):
                rest += int(impacts[at + block - 1])
        at += block
        block *= 2
        cand = np.flatnonzero(met if live is None else live)
        low = lower[cand]
        if rest == 0:
            break
        if len(cand) < k:
            continue
        kth = np.partition(low, len(low) - k)[len(low) - k]
        if kth <= 0 or rest >= kth and live is None:
            continue
        # upper ends: the last impact of every open list that has not shown the document
        gap = np.zeros(n_docs, np.int64)
        for docs, impacts in lists:
            if at < len(impacts):
                gap[docs[:at]] -= impacts[at - 1]
        up = low + rest + gap[cand]
        reach = up >= kth
        cand, low, up = cand[reach], low[reach], up[reach]
        if (low == up).all():
            break
        live = np.zeros(n_docs, bool)
        live[cand] = True
    best = np.lexsort((order[cand], -low))[:k]
    return [(int(cand[i]), int(low[i])) for i in best if low[i] > 0]


def _count_rows(names: dict[bytes, int]):
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("t", pa.list_(pa.int32())), ("tf", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, n, t, tf = [], [], [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                c = term_counts(text.as_py())
                if not c:
                    continue
                own = c.keys() & names.keys()
                ids.append(i)
                n.append(sum(c.values()))
                t.append([names[w] for w in own])
                tf.append([c[w] for w in own])
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((ids, n, t, tf), schema)], schema=schema)
        trim_memory()

    return run


def _search_rows(queries: list[tuple[int, dict[int, int]]], k: int):
    """Postings (t, doc, id, impact) of one shard, sorted by term and falling impact -> the
    shard's best ``k`` documents of each query."""
    schema = pa.schema([("q", pa.int32()), ("id", pa.int64()), ("doc", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        t, doc, ids, impact = (pa.concat_arrays([p.column(i) for p in parts]) for i in range(4))
        del parts
        t, impact = t.to_numpy(), impact.to_numpy()
        rows, first, local = np.unique(doc.to_numpy(), return_index=True, return_inverse=True)
        ids = ids.take(pa.array(first))
        none = ids.is_null().to_numpy(zero_copy_only=False)
        order = np.empty(len(rows), np.int64)
        order[np.lexsort((rows, ids.fill_null(0).to_numpy(), none))] = np.arange(len(rows))
        edge = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
        span = {int(t[a]): slice(a, b) for a, b in zip(edge, np.append(edge[1:], len(t)))}
        local = local.astype(np.int32)
        qs, docs, scores = [], [], []
        for q, weights in queries:
            lists = [(local[span[x]], impact[span[x]] * m) for x, m in weights.items() if x in span]
            for d, s in nra(lists, order, k) if lists else ():
                qs.append(q)
                docs.append(d)
                scores.append(s)
        at = pa.array(docs, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(qs, pa.int32()), ids.take(at), pa.array(rows).take(at), pa.array(scores, pa.int64())], schema=schema)
        trim_memory()

    return run


def _blocks(items: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple]]:
    """The items as lists of (id, term counts), about ``block_bytes`` of text in each."""
    d = items.select(col(items, item_col).alias("id"), col(items, text_col).alias("text"))
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // block_bytes) or 1
    d = d.withColumn("b", F.pmod(F.xxhash64("id", "text"), F.lit(n))) if n > 1 else d.withColumn("b", F.lit(0))
    for b in range(n):
        yield [(r["id"], term_counts(r["text"])) for r in d.where(F.col("b") == b).select("id", "text").collect()]


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", k: int = TOP, shard: int = SHARD, block_bytes: int = QUERY_BYTES) -> DataFrame:
    """Rows (item, rank, id, score): the ``k`` documents of each item with the highest
    scores above 0."""
    d = docs.select(col(docs, id_col).cast("long").alias("id"), col(docs, text_col).alias("text"))
    id_type = items.schema[item_col].dataType
    out = docs.sparkSession.createDataFrame([], f"item {id_type.simpleString()}, rank int, id long, score long")
    for block in _blocks(items, item_col, item_text_col, block_bytes):
        names = {w: i for i, w in enumerate(sorted({w for _, c in block for w in c}))}
        if names:
            out = out.unionByName(_search_block(d, block, names, id_type, k, shard))
    return out


def _search_block(d: DataFrame, block: list[tuple], names: dict[bytes, int], id_type, k: int, shard: int) -> DataFrame:
    spark = d.sparkSession
    counts = d.mapInArrow(_count_rows(names), "id long, n long, t array<int>, tf array<long>")
    counts = stored(counts.withColumn("doc", F.monotonically_increasing_id()), "nra-counts")
    total = counts.agg(F.count("*").alias("N"), F.sum("n").alias("L"), F.sum(F.size("t")).alias("p")).first()
    n_docs, length, n_postings = total["N"], total["L"] or 1, total["p"] or 0
    each = counts.select("doc", "id", "n", F.explode(F.arrays_zip("t", "tf")).alias("x")) \
        .select("doc", "id", "n", "x.t", "x.tf")
    weights = each.groupBy("t").agg(F.count("*").alias("df")).select("t", F.floor(
        1000 * F.ln(F.lit(2 * n_docs + 2).cast("double") / (2 * F.col("df") + 1))).cast("long").alias("w"))
    m = F.lit(100 - 25) + F.expr(f"(25 * n * {n_docs}L) div {length}L")
    impact = F.col("w") * F.expr("(1000000000L * tf) div (1000 * tf + 12 * m)")
    postings = each.join(F.broadcast(weights), "t").withColumn("m", m).select("t", "doc", "id", impact.alias("impact"))
    queries = [(i, {names[w]: c for w, c in counts_of.items()}) for i, (_, counts_of) in enumerate(block)]
    found = postings.repartition(max(1, -(-n_postings // shard)), "doc") \
        .sortWithinPartitions("t", F.desc("impact"), "doc") \
        .mapInArrow(_search_rows(queries, k), "q int, id long, doc long, score long")
    best = W.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id"), "doc")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    item = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(block)], f"q int, item {id_type.simpleString()}")
    return ranked.join(F.broadcast(item), "q").select("item", "rank", "id", "score")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
                        lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w
  FROM documents),
b AS (
  SELECT row_number() OVER () AS bid, item_id,
         list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
                        lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w
  FROM benchmark),
q AS (SELECT bid, item_id, t, count(*) AS m FROM (SELECT bid, item_id, unnest(w) AS t FROM b) GROUP BY bid, item_id, t),
s AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
p AS (
  SELECT rid, doc_id, n, t, count(*) AS tf FROM (SELECT rid, doc_id, len(w) AS n, unnest(w) AS t FROM d)
  WHERE t IN (SELECT t FROM q) GROUP BY rid, doc_id, n, t),
wt AS (
  SELECT t, CAST(floor(1000 * ln((2 * any_value(s.n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY t),
f AS (
  SELECT bid, item_id, rid, doc_id,
         sum(m * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * p.n * s.n) // s.l)))) AS score
  FROM q JOIN p USING (t) JOIN wt USING (t), s GROUP BY bid, item_id, rid, doc_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY bid ORDER BY score DESC, doc_id NULLS LAST, rid) AS rank
  FROM f WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 20
"""


@query("op12_ranked_lexical_search", SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    r = search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return r.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")
