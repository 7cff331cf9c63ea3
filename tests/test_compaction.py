"""Compaction of ETL batches: rows, file counts, replay, and what readers see."""

import os
from collections import Counter

from pyspark.sql import functions as F

from tessera import streaming as st
from tessera.operators import catalog, compaction as cp, sinks
from tessera.operators.sinks import DATE_COLS, ETL_COLUMNS

ROW = ("depTime int, arrTime int, uniqueCarrier string, flightNum int, origin string, dest string, "
       "depYear string, depMonth string, depDay string")


def batch(day, n, at):
    return [(at + i, None if i % 5 == 0 else i, "AA", 7, "SEA", "LAX", "2008", "01", day) for i in range(n)]


def etl(spark, out, name, batches):
    st.create_etl_table(spark, name, out)
    for b, rows in enumerate(batches):
        st.write_etl_batch(spark.createDataFrame(rows, ROW), out, b, table=name)


def shown(spark, view):
    return Counter(tuple(r) for r in spark.table(view).select(*ETL_COLUMNS, *DATE_COLS).collect())


def files(root):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".csv"))


def test_generations_and_later_batches(spark, tmp):
    batches = [batch("01", 40, 0) + batch("02", 5, 100), batch("01", 30, 200) + batch("03", 4, 300), batch("03", 6, 400)]
    want = [Counter(sum(batches[:k], [])) for k in (1, 2, 3)]
    src, out = os.path.join(tmp, "etl"), os.path.join(tmp, "compacted")
    etl(spark, src, "cp_a", batches)
    try:
        assert cp.compacted_upto(spark, "cp_a_all") is None
        assert cp.compact(spark, "cp_a", "cp_a_all", out, 0)
        assert cp.compacted_upto(spark, "cp_a_all") == 0
        assert shown(spark, "cp_a_all") == want[2]              # the batches after it are there as well
        assert shown(spark, cp.generation_table("cp_a_all", 0)) == want[0]
        first = files(os.path.join(out, "upto=0"))
        assert cp.compact(spark, "cp_a", "cp_a_all", out, 1)
        assert shown(spark, "cp_a_all") == want[2] and shown(spark, cp.generation_table("cp_a_all", 1)) == want[1]
        # the date without new rows stays where it is, the others are one file each
        assert not any("depDay=02" in f for f in files(os.path.join(out, "upto=1")))
        assert len(files(os.path.join(out, "upto=1"))) == 2 and files(os.path.join(out, "upto=0")) == first
        assert not cp.compact(spark, "cp_a", "cp_a_all", out, 1)  # published: not made again
        assert cp.compact(spark, "cp_a", "cp_a_all", out, 2) and shown(spark, "cp_a_all") == want[2]
        assert cp.retire(spark, "cp_a", "cp_a_all") == 5 and catalog.show_partitions(spark, "cp_a").count() == 0
        assert shown(spark, "cp_a_all") == want[2]
    finally:
        spark.sql("DROP VIEW IF EXISTS cp_a_all")


def test_a_job_that_dies_before_the_view_is_replaced(spark, tmp):
    batches = [batch("01", 9, 0), batch("01", 8, 50), batch("02", 3, 70)]
    want = Counter(sum(batches, []))
    src, out = os.path.join(tmp, "etl"), os.path.join(tmp, "compacted")
    etl(spark, src, "cp_b", batches)
    try:
        cp.compact(spark, "cp_b", "cp_b_all", out, 0)
        cp.write_generation(spark, "cp_b", "cp_b_all", out, 1)  # written, not published
        assert cp.compacted_upto(spark, "cp_b_all") == 0 and shown(spark, "cp_b_all") == want
        assert cp.compact(spark, "cp_b", "cp_b_all", out, 1)    # run again: overwritten, each row once
        assert shown(spark, "cp_b_all") == want and len(files(os.path.join(out, "upto=1"))) == 1
    finally:
        spark.sql("DROP VIEW IF EXISTS cp_b_all")


def test_a_hot_date_is_cut_into_bounded_files(spark, tmp):
    rows = batch("01", 2000, 0) + batch("02", 10, 5000)
    src, out = os.path.join(tmp, "etl"), os.path.join(tmp, "compacted")
    etl(spark, src, "cp_c", [rows[::2], rows[1::2]])
    try:
        cp.compact(spark, "cp_c", "cp_c_all", out, 1, rows_per_file=250)
        assert shown(spark, "cp_c_all") == Counter(rows)
        names = files(out)
        hot = [f for f in names if "depDay=01" in f]
        assert 2 <= len(hot) <= 8 and len(names) == len(hot) + 1
        sizes = spark.table("cp_c_all").groupBy(F.input_file_name()).count().collect()
        assert max(r["count"] for r in sizes) < 2000
    finally:
        spark.sql("DROP VIEW IF EXISTS cp_c_all")


def test_empty_batches(spark, tmp):
    src, out = os.path.join(tmp, "etl"), os.path.join(tmp, "compacted")
    etl(spark, src, "cp_d", [[], batch("01", 3, 0)])
    try:
        assert cp.compact(spark, "cp_d", "cp_d_all", out, 0) and sum(shown(spark, "cp_d_all").values()) == 3
        assert cp.compact(spark, "cp_d", "cp_d_all", out, 1) and sum(shown(spark, "cp_d_all").values()) == 3
    finally:
        spark.sql("DROP VIEW IF EXISTS cp_d_all")


def test_nulls_survive(spark, tmp):
    row = [(None, None, None, None, None, None, "2008", "01", "01")]
    src, out = os.path.join(tmp, "etl"), os.path.join(tmp, "compacted")
    etl(spark, src, "cp_e", [row, row])
    try:
        cp.compact(spark, "cp_e", "cp_e_all", out, 1)
        assert shown(spark, "cp_e_all") == Counter(row * 2)
        assert sinks.DATE_COLS == DATE_COLS
    finally:
        spark.sql("DROP VIEW IF EXISTS cp_e_all")
