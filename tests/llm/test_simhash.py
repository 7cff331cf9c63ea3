import itertools

import xxhash
from pyspark.sql import functions as F

from llm_fixtures import ODD, empty, rows_of, docs, odd, spark  # noqa: F401  (fixtures)
from tessera.llm import simhash as S


def brute_print(text, k=3):
    w = [x for x in (text or "").encode().lower().replace(b"\x0b", b" ").replace(b"\x0c", b" ").split()]
    if not w:
        return 0
    sh = [b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(prints, radius):
    """prints: [(id, fp)] -> smallest id reachable, by brute force."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, (_, a)), (j, (_, b)) in itertools.combinations(enumerate(prints), 2):
        if (a ^ b).bit_count() <= radius:
            root[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            best[find(i)] = min(best.get(find(i), d), d)
    return [best.get(find(i)) for i in range(len(prints))]


def test_fingerprint():
    for t in ODD + ["a b c d e f a b c d", "A  B\tC"]:
        assert S.fingerprint(t) == brute_print(t)
    assert S.fingerprint("a\x1cb") == xxhash.xxh64_intdigest(b"a\x1cb", 42)


def test_groups_match_brute_force(spark, docs):
    d = docs.select("doc_id", "text").union(spark.createDataFrame([(i + 10_000, t) for i, t in enumerate(ODD)], docs.select("doc_id", "text").schema))
    want = [(i, S.fingerprint(t)) for i, t in d.collect()]
    got = {r["id"]: (r.fp & (2**64 - 1), r.component) for r in S.groups(d).collect()}
    for (i, fp), c in zip(want, brute_groups(want, 2)):
        assert got[i] == (fp, c)


def test_links_and_components_on_chains(spark):
    for radius in (1, 2, 3):
        step = (1 << radius) - 1
        fps, x = [0], 0
        for i in range(10):
            x ^= step << (radius * i)
            fps.append(x)
        fps += [(1 << 63) | 5, (1 << 63) | 4, 0x0F0F << 40]
        df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
        got = {(r.a & (2**64 - 1), r.b & (2**64 - 1)) for r in S.links(df.union(df), radius).collect()}
        assert {frozenset(p) for p in got} == {frozenset(p) for p in itertools.combinations(fps, 2) if 1 <= (p[0] ^ p[1]).bit_count() <= radius}
        assert len(got) == len({frozenset(p) for p in got})
        cc = S.components(S.links(df, radius)).collect()
        assert len({r.root for r in cc if (r.node & (2**64 - 1)) in fps[:11]}) == 1


def test_deduplicate(spark, odd):
    got = S.deduplicate(odd)
    assert got.columns == odd.columns
    fps = [(i, S.fingerprint(r.text)) for i, r in enumerate(odd.collect())]
    assert got.count() == len(set(brute_groups(fps, 2)))
    assert got.where("text is null").count() == 1  # null, empty and blank texts are one group
    same = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "z")], "doc_id long, text string")
    assert rows_of(S.deduplicate(same), "doc_id", "text") == [(1, "a b c d e f"), (None, "z")]


def test_empty(spark, odd):
    assert S.groups(empty(odd)).count() == 0
    assert S.deduplicate(empty(odd)).count() == 0
    assert S.links(spark.createDataFrame([], "fp long")).count() == 0


def test_hex():
    assert S.masks(1)[0] == 0 and len(set(S.masks(1))) == 65 and len(set(S.masks(2))) == 2081


def test_hot_copies(spark):
    d = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same text for all")
                                 .otherwise(F.concat(F.lit("text number "), F.col("id"), F.lit(" has "), F.col("id") * 7)).alias("text"))
    g = S.groups(d)
    assert g.count() == 3000
    assert g.where("id % 3 = 0").select("component").distinct().count() == 1
