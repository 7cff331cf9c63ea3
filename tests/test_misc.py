"""Sinks, orderings, ids, session operations, model scoring of given rows."""

import os

import pytest
from pyspark.sql import functions as F

from tessera.functions import order_by_date, order_by_times
from tessera.operators import graph as gr
from tessera.operators import ml, sinks
from tessera.sources import parsers as P

from conftest import lines_df
from test_parsers import FLIGHTS


def test_sinks(spark, tmp):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "w string, n long")
    out = os.path.join(tmp, "wc")
    sinks.write_tuples(df, out)
    sinks.write_tuples(df, out)           # overwrite replaces the earlier output
    assert sorted(r["value"] for r in spark.read.text(out).collect()) == ["(a,1)", "(b,2)"]
    seen = []
    sinks.preview(df, 1, out=seen.append, msg="words")
    assert seen[0] == "words (2 rows)" and len(seen) == 2
    assert len(sinks.head(df, 1)) == 1
    back = sinks.parquet_roundtrip(df, os.path.join(tmp, "p"), 1, ["w"])
    assert [tuple(r) for r in back.collect()] == [("a", 1)]


def test_orderings(spark):
    good, _ = P.parse_flights(lines_df(spark, FLIGHTS))
    days = [r["date"]["dayOfMonth"] for r in order_by_date(good).collect()]
    assert days == sorted(days)
    dep = [r["times"]["depTime"] for r in order_by_times(good).collect()]
    assert dep == sorted(dep)


def test_code_id(spark):
    df = spark.createDataFrame([("SEA",), ("LAX",), ("SEA",)], "c string")
    ids = [r[0] for r in df.select(gr.code_id("c")).collect()]
    assert ids[0] == ids[2] and ids[0] != ids[1]


def test_session_operations(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    agg = df.groupBy("k").count()
    agg.cache()
    assert agg.count() == 7
    agg.unpersist()
    assert agg.coalesce(2).rdd.getNumPartitions() <= 2
    df.createOrReplaceTempView("nums")
    assert spark.sql("SELECT COUNT(*) FROM nums WHERE k = 0").first()[0] == 15
    agg.explain(extended=True)


def test_score_given_rows(spark):
    rows = [(u, m, 5.0 if m % 2 == 0 else 1.0) for u in range(30) for m in range(30)]
    r = spark.createDataFrame(rows, "userId int, movieId int, rating double")
    model = ml.fit_als(r, rank=5, max_iter=10, seed=3)
    p = ml.score_pairs(spark, model, [(26, 10), (26, 15), (26, 20), (26, 25)])
    got = {row["movieId"]: row["prediction"] for row in p.collect()}
    assert got[10] > got[15] and got[20] > got[25]
    train = spark.createDataFrame([("good great", 4.0), ("bad awful", 0.0)], "text string, label double")
    nb, labels = ml.fit_nb_hashed(train, num_features=1 << 8)
    sentences = spark.createDataFrame([("great good day",), ("awful bad day",)], "text string")
    assert [x["prediction"] for x in ml.predict_nb_hashed(nb, labels, sentences).collect()] == [4.0, 0.0]


def test_write_by_date(spark, tmp):
    good, _ = P.parse_flights(lines_df(spark, FLIGHTS))
    out = os.path.join(tmp, "etl")
    sinks.write_by_date(good, out)
    assert sorted(os.listdir(os.path.join(out, "depYear=2008", "depMonth=01"))) == [
        "depDay=03", "depDay=04", "depDay=05"]
    back = sinks.read_by_date(spark, out)
    assert dict(back.dtypes)["depMonth"] == "string" and back.count() == 3


def test_hot_date_is_split(spark, tmp):
    from tessera import streaming as st
    rows = [(i, 100 + i, "AS", i, "SEA", "LAX", "2008", "01", "03") for i in range(40)]
    rows += [(1, 2, "AS", 1, "SEA", "PDX", "2008", "01", "04")]
    df = spark.createDataFrame(rows, sinks.ETL_SCHEMA)
    out = os.path.join(tmp, "etl")
    st.write_etl_batch(df, out, batch_id=7, rows_per_file=10)
    hot = os.path.join(out, "batch=7", "depYear=2008", "depMonth=01", "depDay=03")
    cold = os.path.join(out, "batch=7", "depYear=2008", "depMonth=01", "depDay=04")
    hot_files = [f for f in os.listdir(hot) if f.startswith("part-")]
    assert 2 <= len(hot_files) <= 4          # 40 rows at 10 per file, salted by place
    assert len([f for f in os.listdir(cold) if f.startswith("part-")]) == 1
    assert sinks.read_by_date(spark, out).count() == 41
    st.write_etl_batch(df, out, batch_id=7, rows_per_file=10)   # a replay replaces its batch
    assert sinks.read_by_date(spark, out).count() == 41


def test_intermediates_are_deleted_with_their_block(spark, tmp):
    from tessera import intermediates, shared_dir
    from tessera.operators import text as tx
    post = spark.createDataFrame([("a", "1", 2), ("a", "2", 5), ("b", "1", 1)], "word string, doc string, n long")
    there = lambda path: os.path.isdir(path.removeprefix("file:"))
    before = shared_dir(spark, "outside")
    spark.range(3).write.parquet(before)
    with intermediates(spark) as outer:
        kept = shared_dir(spark, "kept", keep=True)
        spark.range(3).write.parquet(kept)
        with intermediates(spark) as made:
            tx.rank_postings(post).write.parquet(tmp + "/out")
            assert len(made) == 1 and there(made[0])
        assert not there(made[0]) and outer == []
    with pytest.raises(ZeroDivisionError), intermediates(spark) as made:
        tx.rank_postings(post)
        1 / 0
    assert len(made) == 1 and not there(made[0])
    assert there(before) and there(kept)   # made outside, and kept
    got = spark.read.parquet(tmp + "/out").where("rank = 1").select("word", "doc").collect()
    assert sorted(map(tuple, got)) == [("a", "2"), ("b", "1")]


def test_broadcast_only_under_bound(spark):
    from tessera.operators.joins import broadcast_if_small, bytes_at_most
    small = spark.range(10)
    big = spark.range(1000)
    assert bytes_at_most(small, 1000) and not bytes_at_most(big, 1000)
    wide = spark.range(1).select(F.expr("repeat('x', 5000)").alias("s"))
    assert not bytes_at_most(wide, 1000)                  # one row may be too large
    nested = wide.select(F.array("s").alias("a"), F.struct("s").alias("b"), F.lit(None).cast("string").alias("c"), F.lit(1.5).alias("d.e"))
    assert not bytes_at_most(nested, 9000) and bytes_at_most(nested, 11000)
    assert bytes_at_most(small.where("id < 0"), 0)
    fact = spark.range(5000).withColumnRenamed("id", "k")
    p1 = fact.join(broadcast_if_small(small.withColumnRenamed("id", "k"), 1000), "k")
    p2 = fact.join(broadcast_if_small(big.withColumnRenamed("id", "k"), 1000), "k")
    hint = lambda df: "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()
    assert hint(p1) and not hint(p2)
    assert p1.count() == 10 and p2.count() == 1000


def test_cluster_conf():
    from tessera.session import cluster_conf
    c = cluster_conf(100 * 2**40, executors=1000, cores_per_executor=8)
    assert c["spark.sql.shuffle.partitions"] == "163840"            # 20 TB / 128 MB
    assert int(c["spark.sql.files.maxPartitionBytes"]) == 256 * 2**20
    small = cluster_conf(1e9, executors=2, cores_per_executor=4)
    assert small["spark.sql.shuffle.partitions"] == "24"              # 3 tasks per core


def test_cube_grouping_id_tells_null_keys_from_subtotals(spark):
    from tessera.operators import relational as rel
    df = spark.createDataFrame([("SEA", None, 10), ("SEA", "LAX", 20), (None, "LAX", 30)],
                               "origin string, dest string, distance int")
    plain = rel.cube_avg(df, ["origin", "dest"])
    assert "grouping_id" not in plain.columns and "avg(distance)" in plain.columns
    rows = rel.cube_avg(df, ["origin", "dest"], with_grouping_id=True).collect()
    # (SEA, null) appears twice: the real null dest (gid 0) and SEA's subtotal (gid 1)
    sea_null = sorted((r["grouping_id"], r["avg(distance)"]) for r in rows
                      if r["origin"] == "SEA" and r["dest"] is None)
    assert sea_null == [(0, 10.0), (1, 15.0)]
    total = [r for r in rows if r["grouping_id"] == 3]
    assert len(total) == 1 and total[0]["avg(distance)"] == 20.0
    agg = rel.cube_agg(df, ["origin"], F.count("*").alias("n"), with_grouping_id=True)
    assert {(r["origin"], r["grouping_id"], r["n"]) for r in agg.collect()} == {
        ("SEA", 0, 2), (None, 0, 1), (None, 1, 3)}


def test_partition_pruning_on_etl_layout(spark, tmp):
    good, _ = P.parse_flights(lines_df(spark, FLIGHTS))
    out = os.path.join(tmp, "etl-prune")
    sinks.write_by_date(good, out)
    day = sinks.read_by_date(spark, out).where((F.col("depMonth") == "01") & (F.col("depDay") == "03"))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(depMonth" in plan and "depDay" in plan.split("PartitionFilters")[1]
    assert [r["flightNum"] for r in day.collect()] == [335]


def test_bucketed_join_has_no_exchange(spark, tmp):
    from tessera.operators.joins import write_bucketed
    from tessera.sources.tables import read_table
    from conftest import SF001
    li = read_table(spark, SF001, "lineitem").select("l_orderkey", "l_quantity")
    o = read_table(spark, SF001, "orders").select("o_orderkey", "o_custkey")
    bl = write_bucketed(li, "li_bucketed", "l_orderkey", 8, os.path.join(tmp, "li"))
    bo = write_bucketed(o, "o_bucketed", "o_orderkey", 8, os.path.join(tmp, "o"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        j = bl.join(bo, bl["l_orderkey"] == bo["o_orderkey"])
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == li.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "32m")
        spark.sql("DROP TABLE IF EXISTS li_bucketed")
        spark.sql("DROP TABLE IF EXISTS o_bucketed")


def test_exact_average_keeps_all_digits_or_fails(spark):
    import pytest
    from tessera.functions import exact_avg, exact_sum
    df = spark.createDataFrame([(47.12345678,), (0.004,), (0.004,), (None,)], "x double")
    got = df.agg(exact_avg("x", 8), exact_sum("x", 8)).first()
    assert abs(got[0] - 47.13145678 / 3) < 1e-12 and abs(got[1] - 47.13145678) < 1e-12
    with pytest.raises(Exception, match="does not fit"):
        df.agg(exact_avg("x", 2)).collect()
    big = spark.createDataFrame([(1e17,), (2.5,)], "x double")
    assert big.agg(exact_sum("x", 2)).first()[0] == 1e17 + 2.5
    with pytest.raises(Exception, match="does not fit"):
        spark.createDataFrame([(float("nan"),)], "x double").agg(exact_sum("x", 2)).collect()
