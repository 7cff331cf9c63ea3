import hashlib
import re

from pyspark.sql import functions as F

from llm_fixtures import ODD, SF001, empty, rows_of, docs, odd, spark  # noqa: F401  (fixtures)
from tessera.llm import decontam as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(texts, items, window=13, share=20):
    wins = {}
    for item, t in items:
        w = words(t)
        n = min(len(w), window)
        for i in range(len(w) - n + 1) if n else []:
            wins.setdefault(tuple(w[i:i + n]), set()).add(item)
    lens = {len(k) for k in wins}
    out = []
    for t in texts:
        w, hit, found = words(t), set(), set()
        for n in lens:
            for i in range(len(w) - n + 1):
                k = tuple(w[i:i + n])
                if k in wins:
                    hit.update(range(i, i + n))
                    found |= wins[k]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((len(w), len(hit), ids, len(hit) > 0 and share * len(hit) >= len(w)))
    return out


def scan_rows(spark, texts, items, **kw):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, h string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.scan(docs, bench, **kw).orderBy("id").collect()
    return [(r.n_words, r.n_hit, r["items"], r.contaminated) for r in got]


def test_scan_matches_brute_force(spark):
    passage = "The quick, brown fox jumps over the lazy dog and runs away from 12 angry élan cats at noon"
    texts = ODD + [passage, "before " * 5 + passage.upper() + " after", "x " * 600 + passage, passage + " " + passage,
                   "short item", "a Short-ITEM b short item", "one two", "fox jumps over the lazy dog"]
    items = [(1, passage), (2, passage + " and more words to say"), (3, "short item"), (4, None), (5, "..."), (None, "one"), (7, "é")]
    assert scan_rows(spark, texts, items) == brute(texts, items)
    # the shuffled way beyond the broadcast bound gives the same
    assert scan_rows(spark, texts, items, max_broadcast_bytes=0) == brute(texts, items)


def test_large_benchmark_repeated_rows_and_null_ids(spark):
    rows = [(None, "short item here"), (None, "short item here"), (7, "short item here"), (7, "short item here"), (7, None), (None, None),
            (8, "no match at all"), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, "short item"), (2, "item here"), (2, "item here")], "item_id long, text string")
    both = [sorted((r.id is None, r.id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated, str(r.spans))
                   for r in D.scan(docs, bench, max_broadcast_bytes=b).collect()) for b in (1 << 20, 0)]
    assert both[0] == both[1] and len(both[0]) == len(rows)
    assert sum(r[5] for r in both[0]) == 4


def test_large_benchmark_shuffles_hashes_not_words(spark, docs):
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet")
    grams = D.benchmark_windows(bench).select("h", "gram").distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = D._probe_shuffled(D._keyed(docs, "doc_id", "text"), grams, [13])._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")
    # what leaves the scan of the documents' windows: no array of words
    sent = [re.search(r"Project \[(.*)\]", x)[1].split(", ") for x in plan.splitlines() if "xxhash64(slice(words" in x]
    assert sent and not any(re.fullmatch(r"(words|found|text)#\d+", c) for cols in sent for c in cols)


def test_empty_tables(spark, odd):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert D.scan(empty(odd), bench).count() == 0
    assert D.scan(odd, bench, max_broadcast_bytes=0).count() == odd.count()
    got = D.scan(odd, empty(bench))
    assert got.count() == odd.count() and got.where("n_hit > 0 or contaminated").count() == 0
    assert D.decontaminate(odd, empty(bench)).count() == odd.count()


def test_decontaminate_keeps_columns_and_clean_rows(spark, odd):
    bench = spark.createDataFrame([(1, "other words")], "item_id long, text string")
    got = D.decontaminate(odd, bench)
    assert got.columns == odd.columns
    assert rows_of(got, *odd.columns) == rows_of(odd.where("text is null or text <> 'other words'"), *odd.columns)


def test_remove_spans(spark):
    docs = spark.createDataFrame([(1, "Keep this, bad old  words! and that"), (2, "bad old words"), (3, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "bad OLD words")], "item_id long, text string")
    got = dict(rows_of(D.decontaminate(docs, bench, remove="spans"), "doc_id", "text"))
    assert got == {1: "Keep this, and that", 2: "", 3: "clean"}


def test_query_matches_sql(spark):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({D.SQL}) ORDER BY doc_id").fetchall()
    assert [tuple(r) for r in D.op5(spark, SF001).select(cols).orderBy("doc_id").collect()] == want


def test_no_python_in_plan(spark, odd):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    plan = D.decontaminate(odd, bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert hashlib.sha256(b"").hexdigest() == D.scan(odd, bench).select(F.sha2(F.array_join("items", ","), 256)).first()[0]
