import collections
import math
import random
import re

from pyspark.sql import functions as F

from llm_fixtures import ODD, SF001, empty, rows_of, docs, odd, spark  # noqa: F401  (fixtures)
from tessera.llm import quality as Q


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    n = len(w)
    wins = collections.Counter(tuple(w[i:i + 8]) for i in range(n - 7))
    cover = set()
    for i in range(n - 7):
        if wins[tuple(w[i:i + 8])] > 1:
            cover.update(range(i, i + 8))
    seen, dup = set(), 0
    for x in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover)


def got(c):
    return [tuple(int(c[k][i]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for i in range(len(c["n_words"]))]


def test_counts_match_brute_force(docs):
    random.seed(3)
    texts = [t or "" for t in ODD] + [" ".join(random.choices("abc", k=random.randint(0, 60))) for _ in range(300)] + \
        ["l 1\nl 1\n\n\n l 1\nl 1", "# * $ % & | < >", " ".join("abcdefgh" * 2), " ".join("abcdefgh" + "x" + "abcdefgh")]
    texts += [r.text for r in docs.limit(60).collect()]
    assert got(Q.count_block(texts)) == [brute(t) for t in texts]
    for t in texts[:30]:
        assert got(Q.count_block([t])) == [brute(t)]
    for k in (1, 3, 5, 8):  # any window length
        ws = [t.encode().split() for t in texts]
        reps = Q.repeated_words(ws, k)[0]
        for x, r in zip(ws, reps):
            c = collections.Counter(tuple(x[i:i + k]) for i in range(len(x) - k + 1))
            assert r == len({j for i in range(len(x) - k + 1) if c[tuple(x[i:i + k])] > 1 for j in range(i, i + k)})


def test_binomial_tail():
    for n, k, p in ((10, 0, 0.01), (50, 3, 0.1), (5, 5, 0.3), (1, 0, 0.5)):
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(Q.binomial_tail(n, k, p) - want) < 1e-12


def corpus(spark, n=4000):
    """Good texts have few symbols, bad texts many; a stratum with few labels; odd ones."""
    df = spark.range(n).select(F.col("id").alias("doc_id"), (F.col("id") % 7 == 0).alias("bad"))
    good = F.concat_ws(" ", *[F.concat(F.lit(f"w{i}x"), F.col("doc_id")) for i in range(30)])
    text = F.when(F.col("bad"), F.concat_ws("# ", *[F.concat(F.lit(f"w{i}"), F.col("doc_id")) for i in range(30)])).otherwise(good)
    lang = F.when(F.col("doc_id") < 60, "few").when(F.col("doc_id") % 2 == 0, "a")
    return df.select("doc_id", text.alias("text"), lang.alias("lang"), "bad", F.lit(1).alias("counts"), F.lit(1).alias("stratum"))


def test_cutoffs_reject_bad_and_keep_good(spark):
    d = corpus(spark)
    labels = d.select("doc_id", F.when(F.col("bad"), 0).otherwise(1).alias("quality"))
    j = Q.judge(d, labels).join(d.withColumnRenamed("doc_id", "id").select("id", "bad"), "id")
    assert j.where("not bad and not kept").count() == 0
    assert j.where("bad and kept and stratum <> '=few'").count() == 0  # null languages are a stratum of their own
    assert j.where("stratum = '=few' and not kept").count() == 0  # too few labels prove nothing
    kept = Q.keep(d, labels)
    assert kept.columns == d.columns
    assert rows_of(kept.select("doc_id"), "doc_id") == rows_of(j.where("kept").select(F.col("id").alias("doc_id")), "doc_id")


def test_noise_labels_give_no_cutoffs(spark):
    d = corpus(spark)
    labels = d.select("doc_id", F.lit(1).alias("quality"))  # bad-looking texts labelled good must stay
    assert Q.judge(d, labels).where("not kept").count() <= 0.01 * 4000


def test_odd_rows_and_empty_tables(spark, odd):
    labels = spark.createDataFrame([(0, 1), (0, 0), (None, 1), (99, None)], "doc_id long, quality int")
    j = Q.judge(odd, labels)
    assert j.count() == odd.count()
    assert {r.kept for r in j.where("counts.n_words < 20").collect()} == {False}
    assert j.where("counts.n_words = 9000 and failed").count() == 1
    assert Q.judge(empty(odd), labels).count() == 0
    assert Q.judge(odd, empty(labels)).count() == odd.count()
    assert Q.keep(odd, empty(labels)).columns == odd.columns


def test_query(spark):
    r = Q.op7(spark, SF001)
    texts = {x.doc_id: x.text for x in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    n = 0
    for x in r.collect():
        b = brute(texts[x.doc_id])
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == b
        assert x.base_failed == (b[0] < 20 or 100 * b[4] > 30 * b[0]) and not (x.base_failed and x.kept)
        n += 1
    assert n == len(texts)


def test_copies_count_once_and_stay_in_one_holdout(spark):
    """A good text that is rejected, copied often, counts as one rejection; copies never are in both holdouts."""
    d = corpus(spark)
    copies = d.where("not bad").limit(1).crossJoin(spark.range(300).select(F.col("id").alias("n"))) \
        .select((F.col("n") + 10_000).alias("doc_id"), "text", "lang", "bad", "counts", "stratum")
    more = d.unionByName(copies)
    labels = more.select("doc_id", F.when(F.col("bad"), 0).otherwise(1).alias("quality"))
    one = {r.stratum: (r.level, list(r.cuts)) for r in Q.fit(Q.features(d), labels).collect()}
    two = {r.stratum: (r.level, list(r.cuts)) for r in Q.fit(Q.features(more), labels).collect()}
    assert one == two and one


def test_real_labels_give_cutoffs_that_hold(spark):
    sf = "/root/testdata/sf0.1"
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    j = Q.judge(d, labels)
    cut = j.join(labels, F.col("id") == F.col("doc_id")).where("not failed").groupBy("stratum", "quality") \
        .agg(F.count("*").alias("n"), F.sum((~F.col("kept")).cast("int")).alias("out")).collect()
    for r in cut:
        if r.quality == 1:
            assert r.out <= Q.RISK * r.n
    assert sum(r.out for r in cut if r.quality == 0) > 0
    assert {r.stratum for r in cut if r.quality == 0 and r.out} == {r.stratum for r in cut}
