"""Conversation prefix trie against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from llm_fixtures import SF001, SF01, empty, spark  # noqa: F401
from pyspark.sql import functions as F

from tessera.llm import prefix_trie as pt


def brute(rows):
    """Nodes of the rebuilt conversations of rows (conv, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            k = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, k, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    members = defaultdict(set)
    ends = defaultdict(list)
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        path = tuple(own.get(base, [])[:h] + mine[h:])
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
        ends[path].append(c)
    words = {p: len(re.findall("[^\x20\x09-\x0d]+", p[-1][1])) if p else 0 for p in members}
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(members[p]) - 1) * words[p]
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -10**9, len(m), kids.get(p, 0), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
                  for p, m in members.items())


def result(conv, **kw):
    rows = pt.nodes(pt.paths(pt.rebuilt(pt.turns(conv))), **kw).collect()
    return sorted((r.conv, r.depth, r.up_conv if r.up_conv is not None else -10**9, r.n, r.n_children, r.n_leaves, r.saved, r.ends)
                  for r in rows)


SCHEMA = "conv_id long, turn long, role string, text string"


def chat(seed, n=120, texts=6):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-50, 400), n):
        for t in range(r.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, t, r.choice(["user", "bot", None]), r.choice(["", None, "a b", "c\td\x0be", "é x"][:texts])))
    return rows


def test_fattest():
    for a in range(40):
        for b in range(a + 1, 80):
            f = pt.fattest(a, b)
            assert a < f <= b and all((x & -x) < (f & -f) for x in range(a + 1, b + 1) if x != f)


def test_trie_holds_every_prefix_and_locates_exits():
    r = random.Random(5)
    seqs = [tuple(r.choice("ab") for _ in range(r.choice([0, 1, 2, 3, 7, 30]))) for _ in range(400)] + [("a",) * 300, ("a",) * 299 + ("b",)]

    def path(i, s):
        keys, k = [], pt.ROOT
        for x in s:
            k = hashlib.md5(k + x.encode()).digest()
            keys.append(k)
        return pt.Path(i, b"".join(keys), [1] * len(s))

    t = pt.ZFastTrie()
    items = [path(i, s) for i, s in enumerate(seqs)]
    for i in range(0, len(items), 90):
        t.insert(items[i:i + 90])
    got = {row[0]: row for row in t.expand()}
    want = defaultdict(list)
    for p in items:
        for d in range(p.size + 1):
            want[p.key(d)].append(p.conv)
    assert {k: (v[3], v[4]) for k, v in got.items()} == {k: (min(v), len(v)) for k, v in want.items()}
    for s in [tuple(r.choice("abc") for _ in range(r.randint(0, 40))) for _ in range(300)]:
        p = path(-1, s)
        n, shared = t.locate(p)
        assert shared == max(d for d in range(p.size + 1) if p.key(d) in want)
        assert (n.above < shared <= n.depth) or n.depth == shared == 0


@pytest.mark.parametrize("seed,kw", [(1, {}), (2, {"batch_size": 1}), (3, {"batch_size": 7, "max_turns": 20})])
def test_equals_brute_force(spark, seed, kw):  # noqa: F811
    rows = chat(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert result(df, **kw) == brute(rows)


def test_odd_rows(spark):  # noqa: F811
    rows = [(20, None, None, None), (20, 1, "u", "a"), (20, 1, "u", "a"), (21, 5, "u", "z " * 5000), (None, 1, "u", "lost"),
            (22, 2, "v", "b"), (22, 1, None, "\x00 x"), (-7, 0, "u", "neg"), (0, 0, "u", "zero")] + [(39, i, "u", "t") for i in range(400)]
    rows += [(c, 0, "u", "same") for c in range(600, 700)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("x")).withColumn("conv", F.create_map(F.lit(1), F.lit(2)))
    assert result(df) == brute(rows)
    assert result(empty(df)) == []


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_real_conversations(spark, sf):  # noqa: F811
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    assert result(df) == brute(rows)
