"""Dense ids, sketches, distinct counts and listed files."""

import os

from pyspark.sql import functions as F

from tessera.operators import ml
from tessera.operators import relational as rel
from tessera.operators.ids import dense_ids, encode, encode_ratings
from tessera.sources.files import read_listed_files, write_whole_files


def test_dense_ids(spark):
    codes = [f"c{(i * 7919) % 503}" for i in range(2000)] + [None, "", "é", "c1"]
    df = spark.createDataFrame([(c,) for c in codes], "c string").repartition(7)
    want = {c: i for i, c in enumerate(sorted({c for c in codes if c is not None}, key=lambda c: c.encode()))}
    ids = dense_ids(df, "c")
    assert {r.c: r.id for r in ids.collect()} == want
    got = encode(df, ids, "c", "c", "no").collect()
    assert len(got) == len(codes) and all(r.no == want.get(r.c) for r in got)
    assert dense_ids(df.where("1 = 0"), "c").count() == 0


def test_encoded_ratings_fit_als(spark):
    big = 1 << 40
    rows = [(big + u * 999_999, f"m{m}", float((u + m) % 5)) for u in range(9) for m in range(6)]
    r, users, items = encode_ratings(spark.createDataFrame(rows, "userId long, movieId string, rating double"))
    assert r.schema["user_no"].dataType.simpleString() == "int"
    assert sorted(x.id for x in users.collect()) == list(range(9)) and items.count() == 6
    model = ml.fit_als(r, "user_no", "item_no", rank=2, max_iter=2)
    assert model.transform(r).where("isnan(prediction)").count() == 0


def test_distinct_counts_make_no_row_copies(spark):
    df = spark.createDataFrame([(i % 5, f"x{i % 11}", None if i % 2 else i) for i in range(100)], "a int, b string, c int")
    d = ml.distinct_counts(df, ["a", "b", "c"])
    assert d.first().asDict() == {"num_rows": 100, "a": 5, "b": 11, "c": 50}
    assert "Expand" not in d._jdf.queryExecution().executedPlan().toString()
    assert ml.distinct_counts(df.where("1 = 0"), ["a", "c"]).first().asDict() == {"num_rows": 0, "a": 0, "c": 0}


def test_sketches_unite(spark):
    df = spark.range(20000).select((F.col("id") % 12).alias("month"), (F.col("id") % 5000).cast("string").alias("v"))
    s = rel.monthly_sketches(df, ["month"], "v")
    assert s.count() == 12
    u = rel.unite_sketches(s, []).first()
    assert u["count"] == 20000 and abs(u.estimate - 5000) < 400


def test_listed_files(spark, tmp):
    texts = ["plain", "", None, "two\r\nlines\n", "é 日本 😀", "x" * 100_000]
    df = spark.createDataFrame([(i % 3, t) for i, t in enumerate(texts)], "id long, text string").repartition(2)
    paths = write_whole_files(df, os.path.join(tmp, "files"), "id", "text", folders=2)
    assert paths.count() == len(texts) and len(os.listdir(os.path.join(tmp, "files"))) <= 2
    got = sorted((int(r.path.rsplit("=", 1)[1].split("@")[0]), r.text) for r in read_listed_files(paths, 3).collect())
    assert got == sorted((i % 3, t or "") for i, t in enumerate(texts))
