import collections
import zlib

from pyspark.sql import functions as F

from llm_fixtures import SF001, empty, rows_of, docs, odd, spark  # noqa: F401  (fixtures)
from tessera.llm import sharding as H
from tessera.session import shared_dir


def place(spark, df, **kw):
    return H.with_slots(H.scatter_shuffle(df, shared_dir(spark, "t-shards"), **kw))


def test_rows_survive_and_slots_are_gapless(spark, odd):
    many = odd.union(spark.range(3000).select("id", F.lit("hot text"), F.lit(0), F.lit("s")).toDF(*odd.columns))
    got = place(spark, many, shards=5, bucket_bytes=4096)
    assert rows_of(got.select("row.*"), *odd.columns) == rows_of(many, *odd.columns)
    slots = collections.defaultdict(list)
    for r in got.collect():
        slots[r.shard].append(r.slot)
    assert sorted(slots) == [0, 1, 2, 3, 4]
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    assert got.select("bucket").distinct().count() > 1


def test_key_law(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    a = {r.row.doc_id: (r.shard, r.grown_shard) for r in place(spark, df, shards=7).collect()}
    b = {r.row.doc_id: r.shard for r in place(spark, df, shards=8).collect()}
    assert all(g == b[i] and g in (s, 7) for i, (s, g) in a.items())
    sizes = collections.Counter(s for s, _ in a.values())
    assert len(sizes) == 7 and max(sizes.values()) < 1.3 * min(sizes.values())


def test_one_id_with_a_third_of_all_rows_spreads_over_buckets(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("doc_id"), F.lit("same text").alias("text"))
    got = place(spark, df, shards=2, bucket_bytes=4000)
    hot = [r["count"] for r in got.where("row.doc_id = 0").groupBy("bucket").count().collect()]
    assert len(hot) > 5 and max(hot) < 2 * min(hot)


def test_order_is_shuffled_and_repeatable(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    one = {r.row.doc_id: (r.shard, r.slot) for r in place(spark, df).collect()}
    assert one == {r.row.doc_id: (r.shard, r.slot) for r in place(spark, df).collect()}
    other = {r.row.doc_id: (r.shard, r.slot) for r in place(spark, df, seed=1).collect()}
    assert one != other
    first = sorted((s, i) for i, (h, s) in one.items() if h == one[0][0])
    assert [i for _, i in first] != sorted(i for _, i in first)


def test_empty(spark, odd):
    assert place(spark, empty(odd)).count() == 0


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = H.op9(spark, SF001).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        raw = (docs[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)


def test_columns_of_any_type(spark, tmp_path):
    d = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"),
                                F.create_map(F.lit("k"), F.col("id")).alias("draw"),
                                F.array(F.struct(F.create_map(F.lit(1), F.lit(2)).alias("m"))).alias("place"))
    w = H.with_slots(H.scatter_shuffle(d, str(tmp_path / "any"), shards=3, bucket_bytes=500))
    rows = w.select("shard", "slot", "row.doc_id", "row.draw", F.col("bucket")).collect()
    assert sorted(r.doc_id for r in rows) == list(range(200)) and all(r.draw == {"k": r.doc_id} for r in rows)
    assert max(r.bucket for r in rows) > 0
    for s in range(3):
        own = [r.slot for r in rows if r.shard == s]
        assert sorted(own) == list(range(len(own)))
