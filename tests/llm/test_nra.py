"""Ranked lexical search by NRA against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import SF001, empty, odd, spark  # noqa: F401
from pyspark.sql import functions as F

from tessera.llm import nra as n

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return [w.translate(FOLD) for w in TERM.findall(text or "")]


def brute(docs, items, k=n.TOP):
    words = [split(t) for _, t in docs]
    big_n = sum(map(bool, words))
    length = sum(map(len, words))
    counts = [Counter(w) for w in words]
    df = Counter(t for c in counts for t in c)
    out = []
    for item, text in items:
        want = Counter(split(text))
        rows = []
        for (i, _), c, w in zip(docs, counts, words):
            if w:
                m = 75 + 25 * len(w) * big_n // length
                s = sum(q * math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                        for t, q in want.items() if t in c)
                if s > 0:
                    rows.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(rows)[:k])]
    return sorted(out, key=repr)


def found(docs, items, **kw):
    return sorted(((r.item, r["rank"], r.id, r.score) for r in n.search(docs, items, **kw).collect()), key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_nra_equals_full_scores(seed):
    r = np.random.default_rng(seed)
    n_docs, k = 500, 7
    full = np.zeros(n_docs, np.int64)
    lists = []
    for _ in range(r.integers(1, 8)):
        docs = r.permutation(n_docs)[:r.integers(1, n_docs)]
        impacts = np.sort(r.integers(0, r.choice([2, 30, 100000]), len(docs)))[::-1].astype(np.int64)
        full[docs] += impacts
        lists.append((docs.astype(np.int32), impacts))
    order = r.permutation(n_docs)
    want = sorted((d for d in range(n_docs) if full[d] > 0), key=lambda d: (-full[d], order[d]))[:k]
    for block in (1, 3, 1000):
        assert n.nra(lists, order, k, block) == [(d, int(full[d])) for d in want]


def test_reading_stops_early():
    """Two long lists whose heads settle everything are not read to their ends."""
    reads = []

    class Spy(np.ndarray):
        def __getitem__(self, i):
            if isinstance(i, slice) and i.start is not None:
                reads.append(i.stop)
            return np.asarray(super().__getitem__(i))

    m = 100_000
    docs = np.arange(m, dtype=np.int32)
    impacts = np.concatenate([np.full(30, 10**6), np.full(m - 30, 1)]).astype(np.int64)
    lists = [(docs.view(Spy), impacts.view(Spy)), (docs.view(Spy), impacts.view(Spy))]
    assert n.nra(lists, np.arange(m), 20) == [(i, 2 * 10**6) for i in range(20)]
    assert max(reads) < m // 10


@pytest.mark.parametrize("shard", [50, 10**6])
def test_equals_brute_force(spark, shard):  # noqa: F811
    r = random.Random(shard)
    vocab = ["a", "b", "Cc", "dé", "e5", "日本", "x", "rare", "q"]
    docs = [(i if i % 17 else None, " ".join(r.choices(vocab, k=r.choice([0, 1, 3, 20, 200])))) for i in range(300)]
    docs += docs[:40] + [(5, None), (None, ""), (7, "only#%symbols? ;")]
    items = [(i, " ".join(r.choices(vocab + ["absent", "X", "CC"], k=r.randint(1, 12)))) for i in range(12)]
    items += [(None, "a a b"), (3, "rare"), (3, "rare"), (99, None), (98, ""), (97, "absent")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert found(d, q, shard=shard) == want
    assert found(d, q, shard=shard, block_bytes=30) == want


def test_odd_texts_and_empty_tables(spark, odd):  # noqa: F811
    q = spark.createDataFrame([("i", "ONE word xx", 1)], "item_id string, text string, id int")
    o = odd.withColumn("t", F.create_map(F.lit(1), F.lit(1)))
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(o, q) == brute(rows, [("i", "ONE word xx")])
    assert found(empty(o), q) == found(o, empty(q)) == []


def test_real_tables(spark):  # noqa: F811
    d, q = spark.read.parquet(f"{SF001}/documents.parquet"), spark.read.parquet(f"{SF001}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in d.collect()], [(r.item_id, r.text) for r in q.collect()])
    assert found(d, q, shard=3000) == want
