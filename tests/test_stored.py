"""Tables stored for joins: plans without exchanges, pruned months, hot keys."""

import os
import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.operators.joins import buckets_for, store_for_joins
from tessera.plans.q_stored import stored_tables

from conftest import SF001


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    return lambda: [spark.conf.set(k, v) if v is not None else spark.conf.unset(k) for k, v in old.items()]


def test_no_flight_is_moved(spark):
    q = E.queries()
    stored_tables(spark, SF001)
    back = no_broadcast(spark)
    try:
        assert "Exchange" not in plan(q["stored_order_flights"](spark, SF001))
        p = plan(q["stored_route_names"](spark, SF001))
        # between the scan of the flights and the first exchange above it there is an aggregate
        lines = p.split("\n")
        scan = next(i for i, x in enumerate(lines) if "FileScan" in x and "stored_flights" in x)
        above = lines[:scan][::-1]
        agg = next(i for i, x in enumerate(above) if "HashAggregate" in x)
        move = next(i for i, x in enumerate(above) if "Exchange" in x)
        assert agg < move and re.search("partial_count", above[agg])
    finally:
        back()


def test_a_month_reads_its_folder(spark):
    p = plan(E.queries()["stored_month_routes"](spark, SF001))
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", p).group(1)
    assert "year" in filters and "month" in filters and "1996" in filters
    assert "ReadSchema: struct<distance:int,origin:string,dest:string>" in p


def test_stored_once(spark):
    a, b = stored_tables(spark, SF001), stored_tables(spark, SF001)
    assert [x.inputFiles() for x in a] == [x.inputFiles() for x in b]


def test_line_items_move_once_before_their_fields_are_made(spark):
    from tessera.plans.q_stored import dealt_flights
    from tessera.session import shuffles_of
    from tessera.sources.tables import Tables
    back, old = no_broadcast(spark), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")    # more than the buckets
    try:
        t = Tables(spark, SF001)
        rows = dealt_flights(t, 16, 7).repartition(16, "l_orderkey")
        with shuffles_of(spark, 16):
            dealt = sorted(map(str, rows.collect()))
        p = plan(rows).split("== Initial Plan ==")[0]
        moves = [x for x in p.split("\n") if "Exchange" in x and "l_orderkey" in x]
        assert len(moves) == 1 and "REPARTITION_BY_NUM" in moves[0]     # not again for the buckets
        below = p[p.index(moves[0]):]
        assert "named_struct" not in below.split("FileScan")[0]
        assert not [x for x in p.split("\n") if "Exchange hashpartitioning(l_suppkey" in x]
        assert dealt == sorted(map(str, dealt_flights(t, 16, 10**9).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        back()


def test_hot_keys_and_nulls(spark, tmp):
    df = spark.range(300).select(F.when(F.col("id") < 100, 7).when(F.col("id") < 200, F.col("id")).alias("k"),
                                 F.col("id").alias("v"))
    other = spark.createDataFrame([(7, "x"), (150, "y"), (None, "z")], "k2 long, w string")
    want = 100 + 1
    back = no_broadcast(spark)
    try:
        o = store_for_joins(other, "sj_other", "k2", 4, os.path.join(tmp, "o"))
        for name, cap, exchanges in (("sj_b", 100, False), ("sj_p", 99, True)):
            t = store_for_joins(df, name, "k", 4, os.path.join(tmp, name), max_key_rows=cap)
            j = t.join(o, t["k"] == o["k2"])
            assert ("Exchange" in plan(j)) == exchanges
            assert t.count() == 300 and t.where("k is null").count() == 100 and j.count() == want
        e = store_for_joins(df.limit(0), "sj_e", "k", 4, os.path.join(tmp, "e"))
        assert e.count() == 0 and e.columns == ["k", "v"]
    finally:
        back()
        for name in ("sj_other", "sj_b", "sj_p", "sj_e"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_buckets_grow_with_the_rows():
    assert [buckets_for(n) for n in (0, 10**6, 161 * 10**6, 6 * 10**11)] == [8, 8, 16, 32768]
