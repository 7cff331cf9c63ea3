"""Text operators against brute-force Python on small inputs."""

import re
from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import text as tx

from conftest import lines_df


def java_split(s, pat):
    if s == "":
        return [""]
    parts = re.split(pat, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


LINES = ["", "---", "--x--", "don't stop", "don’t stop", "été", "A a, A", "The cat; the DOG."]


def test_word_count(spark):
    got = {r["word"]: r["count"] for r in tx.word_count(lines_df(spark, LINES)).collect()}
    want = Counter(w for line in LINES for w in java_split(line.lower(), r"[^A-Za-z0-9_]+"))
    assert got == dict(want)
    got = {r["word"] for r in tx.word_count(lines_df(spark, LINES), drop_empty=True).collect()}
    assert "" not in got and "dog" in got


def test_crawl(spark):
    df = spark.createDataFrame([("file:/data/corpus/a.txt", "  one\n  two \n\nthree  ")], "path string, text string")
    r = tx.crawl(df, base="corpus/").first()
    assert r["id"] == "a.txt" and r["text"] == "one two three"
    r = tx.crawl(df, base="absent/").first()
    assert r["id"] == "file:/data/corpus/a.txt"


DOCS = [("d1", "the cat and the hat"), ("d2", "the cat"), ("d3", "a hat, a cat's hat"),
        ("d10", "the the the cat"), ("d4", "zebra")]


def brute_index(docs, stop=()):
    post = Counter()
    for d, t in docs:
        for w in java_split(t.lower().strip(), r"[^A-Za-z0-9_']"):
            if w not in stop:
                post[(w, d)] += 1
    by_word = {}
    for (w, d), n in post.items():
        by_word.setdefault(w, []).append((d, n))
    ranked = {}
    for w, lst in by_word.items():
        lst.sort(key=lambda x: (-x[1], x[0]))
        for i, (d, n) in enumerate(lst, 1):
            ranked[(w, d)] = (i, n)
    return post, ranked


def test_inverted_index_ranks(spark):
    # a hot word spread over many documents
    docs = DOCS + [(f"x{i:03d}", "hot " * (1 + i % 3) + "cold") for i in range(120)]
    df = spark.createDataFrame(docs, "doc string, text string")
    post, ranked = brute_index(docs)
    got_post = {(r["word"], r["doc"]): r["n"] for r in tx.postings(tx.index_tokens(df)).collect()}
    assert got_post == dict(post)
    rk = tx.rank_postings(tx.postings(tx.index_tokens(df)))
    got = {(r["word"], r["doc"]): (r["rank"], r["n"]) for r in rk.collect()}
    assert got == ranked
    lines = {(r["word"], r["part"]): r["postings"] for r in tx.postings_lines(rk, 50).collect()}
    assert len([k for k in lines if k[0] == "hot"]) == 3
    assert lines[("cat", 0)] == "(d1,1), (d10,1), (d2,1)"
    assert lines[("the", 0)] == "(d10,3), (d1,2), (d2,1)"


def test_ranks_of_words_with_over_a_million_postings(spark):
    """Default session settings (AQE coalescing on): no row is lost, and the ranks
    are those of a window."""
    n = 2_500_000
    post = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("word"),
        F.col("id").cast("string").alias("doc"), (F.xxhash64("id") % 5 + 5).alias("n"))
    post = post.union(spark.createDataFrame([(f"w{i}", str(i), 1) for i in range(50)], post.schema))
    ranked = tx.rank_postings(post)
    by_word = Window.partitionBy("word").orderBy(F.desc("n"), "doc")
    want = post.select("word", F.row_number().over(by_word).cast("long").alias("rank"), "doc", "n")
    total = lambda d: tuple(d.agg(F.count("*"), F.sum(F.xxhash64(*d.columns).cast("decimal(38,0)"))).first())
    assert total(ranked.select("word", "rank", "doc", "n")) == total(want)
    assert ranked.count() == n + 50


def test_stop_words(spark):
    df = spark.createDataFrame(DOCS, "doc string, text string")
    post = tx.postings(tx.index_tokens(df))
    stop = {r["word"] for r in tx.frequent_words(post, tx.documents_with_tokens(df), 0.5).collect()}
    # "the" in d1, d2, d10 and "cat" in d1, d2, d3, d10: at least 2.5 of 5 documents
    assert stop == {"the", "cat", "", "'", "_"}
    kept = {r["word"] for r in tx.remove_words(post, tx.stop_words_frame(spark, stop)).collect()}
    assert not kept & stop and "hat" in kept
    listed = tx.stop_words_frame(spark, ["a", "the", "a"])
    assert sorted(r["word"] for r in listed.collect()) == ["a", "the"]


def test_crawl_files_keeps_rows_of_one_id_apart(spark, tmp_path):
    from tessera.plans.q_text import crawl_files
    rows = [(1, "one"), (1, "two"), (1, "two"), (2, "three")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.id, r.text) for r in crawl_files(spark, str(tmp_path)).collect())
    assert got == [(str(i), t) for i, t in sorted(rows)]


def test_lines_of_more_than_a_thousand_postings(spark):
    post = spark.range(2500).select(F.lit("w").alias("word"), F.format_string("d%04d", "id").alias("doc"),
                                    (F.col("id") % 7 + 1).alias("n"))
    lines = {r["part"]: r["postings"] for r in tx.postings_lines(tx.rank_postings(post)).collect()}
    want = [f"(d{i:04d},{n})" for n, i in sorted(((i % 7 + 1, i) for i in range(2500)), key=lambda x: (-x[0], x[1]))]
    assert sorted(lines) == [0, 1, 2]
    assert ", ".join(lines[p] for p in (0, 1, 2)) == ", ".join(want)
    assert [lines[p].count("(") for p in (0, 1, 2)] == [1000, 1000, 500]


def test_only_texts_move_and_ranked_postings_stay(spark, monkeypatch):
    """Plans for a corpus over the size up to which scans are spread, nothing broadcast unasked."""
    from tessera.operators.joins import dealt_by_document
    from tessera.plans.q_text import _postings
    from tessera.sources import tables
    from conftest import SF001
    monkeypatch.setattr(tables, "SPREAD_BYTES", 0)
    docs = spark.createDataFrame([(i, "x" * 1000) for i in range(64)], "d long, t string")
    assert dealt_by_document(docs, "d", "t", 2000).rdd.getNumPartitions() == 32
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
        post = _postings(spark, SF001)
        moved = [x for x in plan(post).split("\n") if "Exchange" in x]
        assert len(moved) == 1 and "doc_id" in moved[0]
        assert "SortMergeJoin" not in plan(tx.rank_postings(post)).split("BroadcastExchange")[0]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
