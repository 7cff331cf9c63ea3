"""Suffix-array dedup against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import docs, empty, odd, spark  # noqa: F401
from pyspark.sql import functions as F

from tessera.llm import suffix_dedup as sd
from tessera.llm.lyndon_sort import suffix_arrays


def brute(texts, length):
    """(bytes, removed, spans, kept) of each text, by counting all windows."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int(np.sum(gone[:-1] & ~np.concatenate(([False], gone[:-2])))) if len(d) else 0
        out.append((len(d), int(gone.sum()), spans, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def run(spark, texts, **kw):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    rows = sd.remove_repeats(df, **kw).orderBy("doc_id").collect()
    assert len(rows) == len(texts)
    return [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows]


def passages(seed, n=60, kinds=5, size=900):
    """Texts with shared passages, near copies, inner repeats and runs."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 6)))
    prose = lambda k: " ".join(word() for _ in range(k))
    shared = [prose(r.randint(20, 200)) for _ in range(kinds)]
    out = []
    for _ in range(n):
        parts = [r.choice([prose(r.randint(1, 60)), r.choice(shared), "ab" * r.randint(1, 80), "x" * r.randint(1, 150)])
                 for _ in range(r.randint(1, 5))]
        out.append(" ".join(parts)[:size * 3])
    near = list(shared[0] * 3)
    for _ in range(25):
        copy = near[:]
        copy[r.randrange(len(copy))] = "#"
        out.append("".join(copy))
    return out + out[:5] + [None, "", "short"]


def test_suffix_arrays_equal_sorted_suffixes():
    r = random.Random(3)
    strings = [np.array(s, int) for s in ([], [5], [0] * 7, [0, 1] * 9, [1, 0] * 9, list(range(9)), list(range(9))[::-1])]
    strings += [np.array([r.randrange(k) for _ in range(r.randint(0, 60))], int) for k in (1, 2, 3, 200) for _ in range(100)]
    for s, sa in zip(strings, suffix_arrays(strings, batch_symbols=500)):
        t = s.tolist()
        assert sa.tolist() == sorted(range(len(t)), key=lambda i: t[i:])


@pytest.mark.parametrize("length,hot,chunk", [(40, 5000, 1 << 20), (40, 3, 1 << 20), (64, 5000, 100), (9, 10, 333), (200, 2, 4000)])
def test_equals_brute_force(spark, length, hot, chunk):  # noqa: F811
    texts = passages(length)
    assert run(spark, texts, length=length, hot=hot, chunk=chunk) == brute(texts, length)


def test_windows_of_one_anchor_never_equal_within_a_segment():
    text = (b"ab" * 300 + b"abc" * 200 + b"z" * 500) * 2
    tool = sd.Anchors(50)
    _, at, first, last, _ = tool.chunk(text, np.array([0]), np.array([len(text)]))
    assert int((last - first + 1).sum()) == len(text) - 49  # each window once
    assert ((first <= at) & (at - last >= 0)).all()
    for a, b in zip(first.tolist(), last.tolist()):
        w = [text[i:i + 50] for i in range(a, b + 1)]
        assert len(set(w)) == len(w)


def test_odd_texts_and_clashing_columns(spark, odd):  # noqa: F811
    more = odd.withColumn("n_bytes", F.lit("mine")).withColumn("found_key", F.create_map(F.lit("a"), F.lit(1)))
    r = sd.remove_repeats(more, digest=True)
    assert r.columns[:len(more.columns)] == more.columns
    rows = r.collect()
    want = brute([x.text for x in rows], sd.LENGTH)
    names = r.columns[len(more.columns):]
    for row, w in zip(rows, want):
        got = tuple(row[c] for c in names)
        assert got[:3] == w[:3] and bytes(got[3]) == hashlib.sha256(w[3]).digest()
    assert sd.remove_repeats(empty(odd)).count() == 0


def test_long_run_is_linear(spark):  # noqa: F811
    texts = ["a" * 3_000_000, "b" * 399 + "c", "xy" * 250_000]
    assert [x[1] for x in run(spark, texts)] == [3_000_000, 0, 500_000]


def test_hot_passage_between_different_texts(spark):  # noqa: F811
    r = random.Random(9)
    noise = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    hot = noise(130)
    texts = [noise(150) + hot + noise(150) for _ in range(80)]
    assert run(spark, texts, length=100, hot=10) == run(spark, texts, length=100) == brute(texts, 100)


def test_real_documents(spark, docs):  # noqa: F811
    texts = [x.text for x in docs.orderBy("doc_id").collect()]
    assert run(spark, texts) == brute(texts, sd.LENGTH)
